import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF

from tidewatch.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    """``vec_id`` to its links and the least id reachable."""
    out, ok = {}, []
    for i, v, label in rows:
        good = label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)
        out[i] = (0, i)
        if good:
            ok.append((i, np.float32(v).astype(float), label))
    near = {
        i: [
            j for j, w, m in ok
            if j != i and label == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least
        ]
        for i, v, label in ok
    }
    name = {i: i for i in near}
    while True:
        new = {i: min([name[i], *(name[j] for j in near[i])]) for i in near}
        if new == name:
            break
        name = new
    return out | {i: (len(near[i]), name[i]) for i in near}


def result(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert result(nb.op7_neighbours(spark, SF)) == brute(rows)


def test_saturated_lists_are_enlarged(spark, monkeypatch):
    monkeypatch.setattr(nb, "GROUP", 16)  # components of several blocks
    rng = np.random.default_rng(5)
    center = rng.normal(size=16)
    crowd = [center + 0.03 * rng.normal(size=16) for _ in range(70)]
    others = [rng.normal(size=16) for _ in range(60)]
    vectors = crowd + others + crowd[:5]
    rows = [(i, [float(x) for x in np.float32(v)], i % 2 if i >= 70 else 0) for i, v in enumerate(vectors)]
    got = result(nb.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows)
    assert max(n for n, _ in want.values()) > 2 * nb.LIST
    assert got == want


def test_a_tight_group_of_many_parts_is_one(spark):
    rng = np.random.default_rng(8)
    center = rng.normal(size=16)
    rows = [(i, [float(x) for x in np.float32(center + 1e-4 * rng.normal(size=16))], 0) for i in range(1000)]
    assert len({tuple(v) for _, v, _ in rows}) == 1000 > 3 * nb.GROUP
    unit = np.array([v for _, v, _ in rows]) / np.linalg.norm([v for _, v, _ in rows], axis=1, keepdims=True)
    assert (unit @ unit.T).min() >= nb.LEAST
    assert result(nb.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == {i: (999, 0) for i in range(1000)}


def test_full_lists_do_not_split_components(spark):
    rng = np.random.default_rng(9)
    rows, center = [], 0.123 * np.eye(16)
    for k in range(6):  # tight groups of more than LIST members, 0.985 alike with each other
        middle = np.eye(16)[15] + center[k]
        rows += [(12 * k + i, [float(x) for x in np.float32(middle + 0.001 * rng.normal(size=16))], 0) for i in range(12)]
    want = brute(rows)
    assert set(want.values()) == {(71, 0)}
    assert result(nb.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == want


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1),
        (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], 2),
        (10, [1.0, 0.0, 0.0], 1), (11, [3e38, 0.0], 1), (12, [], 1), (13, [1.0, 0.0], 1),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", n string, id int")
    got = result(nb.near_duplicates(docs))
    want = {i: (0, i) for i in range(1, 14)} | {i: (3, 1) for i in (1, 2, 11, 13)}
    assert got == want
    assert nb.near_duplicates(docs.limit(0)).count() == 0
    assert result(nb.near_duplicates(docs.filter("vec_id in (3, 4)"))) == {3: (0, 3), 4: (0, 4)}


def test_audit_counts_links(spark):
    rows = [(i, [1.0, 0.001 * i], 0) for i in range(20)]
    found = nb.classes(spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "cast(label AS string) AS label", "embedding AS v"))
    none = spark.createDataFrame([], "id long, links long")
    assert nb.audited(found, none, 0.98) == (0, pytest.approx(20 * 19))


@pytest.mark.parametrize("odd_length", [False, True])
def test_a_short_search_ends_in_comparing_all(spark, monkeypatch, odd_length):
    monkeypatch.setattr(nb, "seeded", lambda *a: spark.createDataFrame([], "a long, b long, s double"))
    monkeypatch.setattr(nb, "RETRIES", 1)
    monkeypatch.setattr(nb, "GROUP", 16)  # labels of several blocks
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in np.float32(centers[i % 5] + 0.03 * rng.normal(size=8))], i % 2) for i in range(100)]
    rows += [(100, rows[0][1], 0), (101, [1.0, 2.0], 0)][: 1 + odd_length]
    want = brute(rows)
    assert len({c for _, c in want.values()}) >= 10 and max(n for n, _ in want.values()) >= 8
    assert result(nb.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == want


def test_blocks_of_a_large_component_get_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(nb, "GROUP", 8)
    held = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        members = spark.range(200).selectExpr("id", "array(1.0D, id / 100) v", "1L n", "id div 1000 component")
        met = nb._held_together(members, 0.98)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(component" in plan and any(
            "low#" in x and "high#" in x for x in plan.split("\n") if "Exchange hashpartitioning(component" in x
        )
        dealt = members.withColumnRenamed("component", "t")
        salted = nb._dealt_out(dealt, ["t"], 1).withColumn("bar", F.lit(-1.0))
        tasks = nb._gathered(salted, ["t", "salt"], "bar").select(F.spark_partition_id().alias("p"))
        assert len({r["p"] for r in tasks.collect()}) == 4
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
