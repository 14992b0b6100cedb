import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.helpers import clashing, documents, odd

from tidewatch.llm import spelling
from tidewatch.llm.spelling import Letters, last_forms, letter_codes, near, op13_spelling, search, spelling_groups, variants


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    holes = {}
    for w in counts:
        for i in range(len(w)):
            for hole in (w[:i] + "*" + w[i + 1 :], w[:i] + w[i + 1 :]):
                holes.setdefault(hole, set()).add(w)
        holes.setdefault(w, set()).add(w)
    others = {w: set() for w in counts}
    for met in holes.values():
        for a in met:
            others[a] |= {b for b in met if a != b and one_apart(a, b)}
    best = {w: min(s, key=lambda v: (-counts[v], v)) for w, s in others.items() if s}
    form = {w: v for w, v in best.items() if counts[v] >= 2 * counts[w]}
    rows = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(others[w]), counts.get(form.get(w))))
    return rows


def found(df):
    rows = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def words(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op13_spelling(spark, SF)) == plain_variants(plain_words(rows))


def test_bitsets_against_brute_force():
    draw = random.Random(1)
    for letters in ("ab", "abcß"):
        vocabulary = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(1, 8))) for _ in range(150)})
        codes = {c: i for i, c in enumerate(letters)}
        for m in range(1, 9):
            index = Letters(vocabulary, codes)
            asked = [w for w in vocabulary if len(w) == m]
            start = index.bits(np.ones((len(asked), len(vocabulary)), bool))
            sizes = np.full(len(asked), m)
            for drop in (None, 0, m // 2):
                bits = near(index, letter_codes(asked, sizes, codes), start, drop)
                marks = np.unpackbits(bits.view(np.uint8), axis=1, count=len(vocabulary), bitorder="little")
                for query, row in zip(asked, marks, strict=True):
                    want = {w for w in vocabulary if one_apart(query, w) and (drop is None or w[:drop] != query[:drop])}
                    assert {w for w, there in zip(vocabulary, row, strict=True) if there} == want


@pytest.mark.parametrize("block, unit", [(2048, 1024), (7, 30)])
def test_random_vocabularies(spark, monkeypatch, block, unit):
    """Also with shards that are cut into blocks."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "UNIT", unit)
    draw = random.Random(block)
    counts = {"".join(draw.choice("abé") for _ in range(draw.randint(5, 9))): draw.choice([3, 3, 6, 7, 20, 50]) for _ in range(400)}
    counts |= {w: 3 for w in ("aaaaa", "zzzzzz", "x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149, "y" + "x" * 300)}
    assert found(variants(words(spark, counts))) == plain_variants(counts)


def test_a_hot_shard_is_cut_and_dealt(spark, monkeypatch):
    """Blocks get tasks of their own: an exchange on the unit follows the cut."""
    monkeypatch.setattr(spelling, "BLOCK", 8)
    draw = random.Random(9)
    counts = {"common" + "".join(draw.choice("abcd") for _ in range(6)): 3 for _ in range(200)}
    rows = spelling.units(words(spark, counts)).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    assert rows.agg(F.max("n")).first()[0] <= 400 / 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(unit" in plan
    assert found(variants(words(spark, counts))) == plain_variants(counts)


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "bbbbc": 96, "bbbbbb": 90}
    assert found(variants(words(spark, counts))) == plain_variants(counts)
    chain = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(40)], "word string, form string")
    assert {r["root"] for r in last_forms(chain).collect()} == {"w040"}


def test_units_without_questions_or_answers():
    import pandas as pd

    unit = pd.DataFrame({"unit": "u", "m": 5, "last": False, "half": "ab", "word": ["abcde", "abcdf"], "n": 3})
    assert len(search(unit.assign(role=1))) == 0 and len(search(unit.assign(role=2))) == 0
    assert search(unit.assign(role=3))["best"].tolist() == ["abcdf", "abcde"]


def test_odd_rows(spark):
    docs = clashing(odd(spark)).withColumn("word", F.lit("?"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spelling_groups(docs)) == plain_variants(plain_words(rows))
    empty = spelling_groups(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_letters_and_damage(spark):
    text = "GRÖSSE größe Größe ÷×÷×÷× don't ÿÿÿÿÿ naïve123naïve naïve straße"
    rows = [(i, text) for i in range(300)]
    assert found(spelling_groups(documents(spark, rows))) == plain_variants(plain_words(rows))
