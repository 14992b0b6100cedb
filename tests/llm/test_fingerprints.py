import hashlib
import re

import duckdb
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.helpers import clashing, documents, odd

from tidewatch.llm import fingerprints as fp
from tools.check_oracles import tidy


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(text):
    sections = [m[0] for m in re.finditer(fp.SECTION, text)]
    return [[sha("p" + m[0])[:32] for m in re.finditer(fp.PARAGRAPH, s)] for s in sections]


def root(text):
    return sha("".join(sha("s" + "".join(leaves))[:32] for leaves in tree(text)))


def likeness(a, b):
    x, y = ({leaf for s in tree(t) for leaf in s} for t in (a, b))
    if a == b:
        return 1.0
    return min(2 * len(x & y), len(x) + len(y) - 1) / max(len(x) + len(y), 1)


def brute(rows):
    ordered = sorted(
        ((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    out = []
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append(
            (i, len(text), sha(edited), root(text), root(edited), likeness(text, edited), likeness(text, following))
        )
    return sorted(out, key=repr)


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_matches_brute_force_on_odd_rows(spark):
    docs = odd(spark)
    got = sorted((tuple(r[n] for n in NAMES) for r in fp.fingerprinted(clashing(docs)).collect()), key=repr)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = fp.op4_fingerprints(spark, SF).toPandas()
    assert tidy(got).equals(tidy(con.sql(fp.OP4_SQL).df()))
    assert (got["near_edited"] > got["near_next"]).mean() > 0.8


def test_one_row_and_no_row(spark):
    one = fp.fingerprinted(documents(spark, [(7, "Abc. Def.\nGhi")])).first()
    assert one["edited_sha256"] == sha("Abc. De" + "Abc. D") and one["near_next"] == 1.0
    assert fp.fingerprinted(documents(spark, [])).count() == 0


def test_edits_are_located(spark):
    rows = [("One. Two.\nThree. Four.\nFive.", "One. Two.\nThree. 4.\nFive."), ("a", "a"), ("", "b\nc"), (None, None)]
    pairs = spark.createDataFrame(rows, "a string, b string")
    got = [
        [tuple(x) for x in r[0]]
        for r in pairs.select(fp.edits(fp.tree(F.col("a")), fp.tree(F.col("b")))).collect()
    ]
    assert got == [[(1, 1)], [], [(0, 0), (1, 0)], []]
