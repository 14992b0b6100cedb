import math

from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.helpers import clashing, column, odd

from tidewatch.llm import licenses


def brute(text, least=licenses.LEAST):
    """The best header of a text, and the words in headers."""
    weights = licenses.Weights(licenses.TEMPLATES)
    hits = []
    for line in (text or "").split("\n"):
        counts = licenses.terms(line)
        norm = math.sqrt(sum((n * weights.idf.get(t, weights.unknown)) ** 2 for t, n in counts.items()))
        if norm:
            scores = [
                (round(sum(n * weights.idf[t] * v[t] for t, n in counts.items() if t in v) / norm, 9), name)
                for name, v in weights.vectors.items()
            ]
            if max(scores)[0] >= least:
                hits.append((*max(scores), sum(counts.values())))
    return hits


def test_own_licenses_match_brute_force(spark):
    got = dict(column(licenses.op2_licenses(spark, SF), "doc_id", "own_license"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d["doc_id"]: max(((s, n) for s, n, _ in brute(d["text"])), default=(0, None))[1] for d in docs}
    assert got == want and len(set(want.values())) > 3


def test_directories_pass_licenses_down(spark):
    rows = [
        (1, "Released under the MIT License.", "a/LICENSE"),
        (2, "code without a notice", "a/b/c/x.py"),
        (3, "Licensed under the Apache License, Version 2.0.", "a/b/NOTICE"),
        (4, "other code", "a/y.py"),
        (5, "prose " * 30 + "\nAll rights reserved.", "q/z.py"),
        (6, "nothing here", "q/w.py"),
        (7, "nothing above", "top.py"),
        (8, None, "a/b/empty"),
        (9, "nowhere", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    out = licenses.licensed(docs, F.col("path"))
    got = {r["doc_id"]: (r["own_license"], r["inherited_license"], r["inherited_from"]) for r in out.collect()}
    assert got == {
        1: ("MIT", None, None),
        2: (None, "Apache-2.0", "a/b"),
        3: ("Apache-2.0", None, None),
        4: (None, "MIT", "a"),
        5: ("Proprietary", None, None),
        6: (None, None, None),  # a header alone does not speak for its directory
        7: (None, None, None),
        8: (None, "Apache-2.0", "a/b"),
        9: (None, None, None),
    }


def test_the_line_filter_loses_nothing(spark):
    weights = licenses.Weights(licenses.TEMPLATES)
    lines = [t for t in licenses.TEMPLATES.values()] + [
        "Released under the MIT License", "mit mit mit mit released license", "x" * 50, "", "the the the of",
        "* Licensed under CC BY-NC 4.0. (c)", "ALL RIGHTS RESERVED", "This work is under the GNU General Public License",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i long, t string")
    kept = docs.select("i", F.size(licenses.candidate_lines(F.col("t"), weights, 0.8)).alias("n"))
    passed = {r["i"] for r in kept.collect() if r["n"]}
    assert {i for i, t in enumerate(lines) if brute(t)} <= passed


def test_odd_rows(spark):
    docs = clashing(odd(spark)).withColumn("path", F.concat_ws("/", "source", "doc_id"))
    out = licenses.licensed(docs, F.col("path"))
    assert out.count() == 10 and out.filter("license IS NOT NULL").count() == 0
    assert licenses.licensed(docs.limit(0), F.col("path")).count() == 0
