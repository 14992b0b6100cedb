import zlib

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import clashing, odd

from tidewatch.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.op3_quality(spark, SF).join(labels, "doc_id", "left").collect()
    assert len(out) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    test = [r for r in out if r["held_out"] and r["quality"] is not None]
    assert np.mean([r["predicted"] == r["quality"] for r in test]) > 0.95


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = quality.train(docs, labels, rows=150), quality.train(docs, turned, rows=150)
    assert np.array_equal(a.threshold, b.threshold) and np.array_equal(a.value, b.value)


def test_traversal_is_a_walk_down_each_tree():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x, y, trees=20, depth=3)
    inner = model.feature.shape[1]
    for row, got in zip(x[:50], model.score(x[:50]), strict=True):
        total = model.prior
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < inner:
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += value[node - inner]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-12
    assert np.mean((model.score(x) >= 0.5) == y) > 0.95


def test_nothing_to_learn_from(spark):
    docs = clashing(odd(spark))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["s"] for r in docs.select(quality.score(F.col("text"), quality.train(docs, none)).alias("s")).collect()} == {0.5}
    assert quality.accepted(docs, none).columns == docs.columns
    assert quality.accepted(docs.limit(0), none).count() == 0
    one = quality.fit(np.zeros((5, len(quality.FEATURES))), np.ones(5))
    assert one.score(quality.matrix([None, "", "text"])).min() > 0.5
    conflict = spark.createDataFrame([(4, 1), (4, 0), (4, None), (None, 1)], "doc_id long, quality int")
    assert quality.sample(docs, conflict).count() <= 1
