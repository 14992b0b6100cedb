import random

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.helpers import WORD, clashing, column, odd

from tidewatch.llm import simhash as sh


def brute_bits(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """``(id, bits)`` rows to the least id reachable."""
    bits = np.array([b for _, b in rows], dtype=np.uint64)
    ids = [i for i, _ in rows]
    label = list(range(len(rows)))
    changed = True
    near = [np.flatnonzero(np.bitwise_count(bits ^ b) <= 3) for b in bits]
    while changed:
        changed = False
        for i, n in enumerate(near):
            best = min((label[j] for j in n), key=lambda k: ids[k])
            if ids[best] < ids[label[i]]:
                label[i], changed = best, True
    return {i: ids[k] for i, k in zip(ids, label, strict=True)}


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d["doc_id"]: brute_bits(d["text"]) for d in docs}
    groups = brute_groups(list(want.items()))
    got = sh.op5_simhash(spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        i: (f"{b:016x}", groups[i]) for i, b in want.items()
    }


def test_links_of_close_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(sh, "SHARD", 20)  # shards are cut into blocks
    rng = random.Random(4)
    base = rng.getrandbits(64)
    prints = {0, (1 << 64) - 1}
    for _ in range(150):
        prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
        prints.add(rng.getrandbits(64))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = sh.links(spark.createDataFrame(signed, "bits long"), "bits").collect()
    whole = sorted(p & (1 << 64) - 1 for p in prints)
    joined = {p: p for p in whole}

    def find(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for r in links:
        a, b = find(r["a"] & (1 << 64) - 1), find(r["b"] & (1 << 64) - 1)
        joined[max(a, b)] = min(a, b)
    assert {p: find(p) for p in whole} == brute_groups([(p, p) for p in whole])


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64))
    queries = rng.integers(0, 1 << 12, 60, dtype=np.uint64)
    found = {(int(n), int(q)) for n, near in sh.Tree(prints).within(queries, 3) for q in near}
    far = np.bitwise_count(prints[:, None] ^ queries[None, :])
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(far <= 3)), strict=True))


def test_odd_rows(spark):
    docs = odd(spark)
    got = column(sh.near_duplicates(clashing(docs)), "doc_id", "fingerprint", "component_id")
    rows = [r.asDict() for r in docs.collect()]
    assert len(got) == len(rows)
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, "0" * 16, 1) for i in (1, 2, 3)]
    assert {g[2] for g in got if g[0] in (4, 5)} == {4}
    assert sh.near_duplicates(docs.limit(0)).count() == 0


def test_hash_is_the_engines_own(spark):
    words = ["one two three", "é", ""]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()
    assert [r[0] & (1 << 64) - 1 for r in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_blocks_of_a_hot_shard_get_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(sh, "SHARD", 8)
    held = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keyed = spark.range(200).selectExpr("id bits", "id div 1000 t", "id div 2000 k")
        met = sh.dealt_shards(keyed, "bits")
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(t#" in plan and ", high#" in plan and ", low#" in plan.split("hashpartitioning(t#")[1]
        tasks = met.select(F.spark_partition_id().alias("p"), F.size("tree").alias("n")).collect()
        assert len({r["p"] for r in tasks}) == 4 and len(tasks) == 25 * 26 // 2
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)


def test_one_row_of_each_group_is_a_defined_one(spark):
    docs = clashing(odd(spark))
    more = docs.withColumn("lang", F.lit("aa")).unionByName(docs).withColumn("list", F.array(F.lit(1)))
    kept = sh.one_of_each(more.repartition(5)).collect()
    named = [r for r in kept if r["doc_id"] is not None]
    prints = [(r["doc_id"], brute_bits(r["text"])) for r in docs.collect() if r["doc_id"] is not None]
    assert sorted(r["doc_id"] for r in named) == sorted(set(brute_groups(prints).values()))
    assert {r["lang"] for r in named} == {"aa"} and len(kept) - len(named) == 2
    assert kept[0].__fields__ == more.columns
