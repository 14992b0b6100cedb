import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import WORD, clashing, column, documents, odd

from tidewatch.llm import mixing

SF = "/root/testdata/sf0.01"


def brute_targets(sizes, weights=(3, 1, 2), share=1.5):
    """Source to target, by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        if not free:
            return {s: 2.0 * sizes[s] for s in order}
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def test_query_follows_its_contract(spark):
    out = mixing.op9_mixing(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken, longest = {}, {}, {}
    for r in out:
        d = docs[r["doc_id"]]
        assert r["size"] == len(WORD.findall(d["text"]))
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[d["source"]] = sizes.get(d["source"], 0) + r["size"]
        taken[d["source"]] = taken.get(d["source"], 0) + r["taken"]
        longest[d["source"]] = max(longest.get(d["source"], 0), r["size"])
    want = brute_targets(sizes)
    for r in out:
        source = docs[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[source] and abs(r["target"] - want[source]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) < 0.02 * want[s]
    again = mixing.op9_mixing(spark, SF).collect()
    assert sorted(again) == sorted(out)


def test_targets_stop_and_reshare(spark):
    rows = [("a", 10), ("b", 500), ("c", 90), (None, 400), ("d", 0)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, size long"))
    want = brute_targets(dict(rows))
    assert {r["source"]: round(r["target"], 6) for r in got.collect()} == {s: round(t, 6) for s, t in want.items()}
    only = mixing.targets(spark.createDataFrame([("a", 0)], "source string, size long")).first()
    assert only["target"] == 0.0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    p, size = rng.random(500), rng.integers(1, 3000, 500).astype(float)
    flown = mixing.fly(p, size, rng)
    left = ((flown > 0) & (flown < 1)).sum()
    assert left <= 2
    assert abs(flown.sum() - p.sum()) < 1e-6 and abs(flown @ size - p @ size) < 1e-3
    landed = mixing.land(mixing.fly(p, size, rng, 12), size)
    assert set(np.unique(landed)) <= {0.0, 1.0} and abs(landed @ size - p @ size) < 200
    same = mixing.fly(np.full(9, 1 / 3), np.ones(9), rng)
    assert abs(same.sum() - 3) < 1e-9


def test_flight_keeps_probabilities():
    p, size = np.array([0.2, 0.5, 0.8, 0.4, 0.6]), np.array([3.0, 1.0, 4.0, 1.0, 5.0])
    mean = np.mean([mixing.fly(p, size, np.random.default_rng(i)) for i in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def test_odd_rows(spark):
    docs = clashing(odd(spark))
    out = mixing.mixed(docs).collect()
    assert len(out) == 10
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    copies = {}
    for r in out:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    seen = dict(rows.groupBy("doc_id").agg(F.count(F.lit(1))).collect())
    assert seen == {k: n for k, n in copies.items() if n}
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixed_rows(docs.limit(0)).count() == 0


def test_ids_stay_exact_beside_null(spark):
    big = (1 << 60) + 1
    rows = [(None, "a b c"), (None, None), *[(big + i, "w " * (1 + i % 7)) for i in range(40)]]
    out = mixing.mixed(documents(spark, rows), share=0.7).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted(
        (i is None, i or 0) for i, _ in rows
    )
    assert abs(sum(r["taken"] for r in out) - out[0]["target"]) <= 2


def test_many_blocks_of_one_source(spark):
    rows = [(i, "w " * (1 + i * 7919 % 90), "hot" if i % 3 else "b") for i in range(1500)]
    out = mixing.mixed(documents(spark, rows), share=0.7).collect()
    for s in ("hot", "b"):
        mine = [r for r in out if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 2
    assert len({r["doc_id"] for r in out}) == 1500
    assert column(mixing.mixed(documents(spark, rows), share=0.7), "doc_id", "taken") == sorted(
        [(r["doc_id"], r["taken"]) for r in out], key=repr
    )
