"""Streams give what the batch operators give."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift, train
from tidewatch.operators.features import FeatureSpec, add_features
from tidewatch.operators.monitor import log_entries
from tidewatch.sources import logs
from tidewatch.streaming import drift as drift_stream
from tidewatch.streaming import features as feature_stream
from tidewatch.streaming import ingest as ingest_stream
from tidewatch.streaming import monitor as monitor_stream
from tidewatch.streaming import score as score_stream
from tests.conftest import rows_of

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
SPEC = FeatureSpec("value", ("ts", "event_id"), keys=("event_type",))


def folders(tmp_path, *names):
    return [str(tmp_path / n) for n in names]


def test_ingest_writes_each_file_once(spark, events, tmp_path):
    landed, out, log, checkpoint = folders(tmp_path, "landed", "out", "log", "cp")
    plain = events.drop("props")
    for part in ("value < 30", "value >= 30"):
        plain.filter(part).write.mode("append").parquet(landed)
        for _ in range(2):  # the second run finds nothing new
            stream = ingest_stream.read_stream(spark, landed, SCHEMA, "parquet")
            ingest_stream.start_ingest(
                stream, out, log, checkpoint, "events", ranges={"value": (0.0, 30.0)}
            ).awaitTermination()
    assert rows_of(spark.read.parquet(out).drop("batch")) == rows_of(plain)
    found = spark.read.parquet(log).orderBy("batch").collect()
    assert [r["warning_count"] for r in found] == [0, 1]
    assert sum(r["row_count"] for r in found) == 1000


@pytest.mark.parametrize("cuts", [[0.5], [0.1, 0.11, 0.9]])
def test_features_equal_batch(spark, events, tmp_path, cuts):
    landed, out, checkpoint = folders(tmp_path, "landed", "out", "cp")
    plain = events.drop("props")
    start, span = dt.datetime(2024, 1, 1), dt.timedelta(days=30)
    edges = [start + c * span for c in (0.0, *cuts, 1.1)]
    stream = feature_stream.FeatureStream(SPEC, out, dt.timedelta(0))
    for low, high in zip(edges, edges[1:]):
        part = plain.filter(F.col("ts").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")))
        part.repartition(3).write.mode("append").parquet(landed)
        source = ingest_stream.read_stream(spark, landed, SCHEMA, "parquet")
        stream.start(source, checkpoint).awaitTermination()
    stream.finish(spark, checkpoint, source.schema)  # watermarks count in milliseconds
    columns = [F.round(c, 6).alias(c) for c in SPEC.feature_columns]
    found = feature_stream.read_features(spark, stream)
    assert feature_stream.read_late(spark, stream).count() == 0
    assert rows_of(found.select("event_id", *columns)) == rows_of(add_features(plain, SPEC).select("event_id", *columns))


def test_late_rows_are_set_aside(spark, tmp_path):
    landed, out, checkpoint = folders(tmp_path, "landed", "out", "cp")
    at = dt.datetime(2024, 1, 1)
    row = lambda i, hours, v: (i, None if hours is None else at + dt.timedelta(hours=hours), 0, "k", v)
    spec = FeatureSpec(target="value", order_by=("ts", "event_id"), keys=("event_type",), lags=(1,), windows=(3,))
    stream = feature_stream.FeatureStream(spec, out, dt.timedelta(hours=1))
    arrivals = (
        [row(1, 1, 1.0), row(2, 3, 2.0)],
        [row(3, 2, 9.0), row(4, 4, 3.0), row(8, None, 0.0)],  # 3 is at the watermark
        [row(5, 3.5, 4.0), row(6, 1, 5.0)],  # 5 came before 4 is final
    )
    for rows in arrivals:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landed)
        source = ingest_stream.read_stream(spark, landed, SCHEMA, "parquet")
        stream.start(source, checkpoint).awaitTermination()
    final = lambda: feature_stream.read_features(spark, stream).collect()
    assert {r["event_id"] for r in final()} == {1, 2}
    stream.finish(spark, checkpoint, source.schema)
    found = {r["event_id"]: (r["value_lag_1"], r["value_roll_mean_3"]) for r in final()}
    assert found == {1: (None, 1.0), 2: (1.0, 1.5), 5: (2.0, 7 / 3), 4: (4.0, 3.0)}
    late = feature_stream.read_late(spark, stream).collect()
    assert sorted(r["event_id"] for r in late) == [3, 6, 8]


def test_untouched_keys_write_no_state(spark, tmp_path):
    """What a batch stores follows the keys that it brings rows for."""
    landed, out, checkpoint = folders(tmp_path, "landed", "out", "cp")
    at = dt.datetime(2024, 1, 1)
    row = lambda i, hours, key: (i, at + dt.timedelta(hours=hours), 0, key, float(i))
    spec = FeatureSpec(target="value", order_by=("ts", "event_id"), keys=("event_type",), lags=(1,), windows=(3,))
    stream = feature_stream.FeatureStream(spec, out, dt.timedelta(days=9))
    written = []
    for rows in ([row(i, i % 40, f"k{i % 200}") for i in range(400)], [row(1000, 41, "k7"), row(1001, 41, "new")]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        query = stream.start(ingest_stream.read_stream(spark, landed, SCHEMA, "parquet"), checkpoint)
        query.awaitTermination()
        states = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
        written.append(sum(s.customMetrics["rocksdbPutCount"] for s in states))
    assert 0 < written[1] <= 20 < 400 <= written[0]
    stream.finish(spark, checkpoint, spark.createDataFrame([], SCHEMA).schema)
    rows = spark.read.schema(SCHEMA).parquet(landed)
    columns = [F.round(c, 6).alias(c) for c in spec.feature_columns]
    found = feature_stream.read_features(spark, stream)
    assert rows_of(found.select("event_id", *columns)) == rows_of(add_features(rows, spec).select("event_id", *columns))


@pytest.mark.parametrize("current", [True, False])
def test_numbers_of_one_series_equal_the_batch_operator(spark, current):
    values = [1.0, None, 4.0, 2.5, None, None, None, 8.0, 3.0]
    spec = FeatureSpec("v", ("i",), lags=(1, 2, 20), windows=(1, 2, 3, 12), include_current=current, hour_of_day=False)
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double")
    want = add_features(df, spec).orderBy("i").toPandas()
    numbers = np.array([np.nan if v is None else v for v in values])
    found = feature_stream.window_numbers(numbers, ~np.isnan(numbers), spec)
    for name, column in found.items():
        np.testing.assert_allclose(column, want[name].to_numpy(float), err_msg=name)


def test_monitoring_of_closed_windows_equals_batch(spark, events, tmp_path):
    landed, out, checkpoint = folders(tmp_path, "landed", "out", "cp")
    entries = log_entries(
        events, F.col("ts"), F.lit(1), F.col("value"), F.create_map(F.lit("v"), F.col("value")),
        F.struct(F.col("value").alias("std"), F.col("value").alias("min"), F.col("value").alias("max")), F.lit(50.0),
    )
    logs.append_log(entries, landed)
    stream = logs.stream_log(spark, landed)
    stats = monitor_stream.windowed_stats(stream, "1 day", "1 hour")
    monitor_stream.start_append(stats, out, checkpoint).awaitTermination()
    last = dt.datetime(2024, 1, 30)
    batch = monitor_stream.windowed_stats(entries, "1 day", "1 hour").filter(F.col("window_end") <= F.lit(last).cast("timestamp_ntz"))
    assert rows_of(spark.read.parquet(out)) == rows_of(batch)
    per_feature = monitor_stream.windowed_feature_stats(entries, "1 day", "1 hour")
    assert per_feature.filter("feature = 'v'").count() == 30


def test_drift_of_closed_windows_whatever_the_batches(spark, events, tmp_path):
    """A day like the baseline, one that moved, one of few rows; the last stays open."""
    landed, base = folders(tmp_path, "landed", "base")
    drift.Baseline.of(events, ["value"]).save(base)
    entries = log_entries(events, F.col("ts"), F.lit(1), F.col("value"), F.create_map(F.lit("value"), F.col("value")))

    def day(rows, n, shift):
        at = F.timestamp_add("MINUTE", F.col("value").cast("long") % 600, F.lit(f"2024-03-0{n}").cast("timestamp_ntz"))
        moved = F.create_map(F.lit("value"), F.col("prediction") + shift)
        return rows.withColumn("value", F.col("prediction")).withColumn("timestamp", at).withColumn("input_features", moved).drop("value")

    nan = F.create_map(F.lit("value"), F.lit(float("nan")))
    days = [day(entries, 1, 0), day(entries, 2, 50), day(entries.limit(4), 3, 0), day(entries, 4, 0).withColumn("input_features", nan), day(entries, 6, 9)]
    for part in days:
        for half in ("prediction < 30", "prediction >= 30"):
            part.filter(half).coalesce(1).write.mode("append").parquet(landed)
    found = []
    for files in (1, 100):
        out, checkpoint = folders(tmp_path, f"out{files}", f"cp{files}")
        stream = spark.readStream.schema(entries.schema).option("maxFilesPerTrigger", files).parquet(landed)
        drift_stream.start_drift(stream, drift.Baseline.load(spark, base), ["value", "absent"], out, checkpoint).awaitTermination()
        found.append(rows_of(spark.read.parquet(out).drop("batch")))
    assert found[0] == found[1]
    rows = spark.read.parquet(out).orderBy("window_start").collect()
    assert [(r["window_start"].day, r["status"], r["feature"], r["drift_detected"]) for r in rows] == [
        (1, "checked", "value", False), (2, "checked", "value", True), (3, "insufficient_data", None, None)
    ]
    batch = drift.drift_from_log(drift.Baseline.load(spark, base), days[1], ["value"]).first()
    assert all(rows[1][c] == batch[c] for c in ("ks_statistic", "p_value", "current_mean", "alert"))


def test_stream_scoring_equals_batch(spark, events, tmp_path):
    landed, log, checkpoint = folders(tmp_path, "landed", "log", "cp")
    rows = events.select("ts", "value", F.col("user_id").cast("double").alias("u"), F.col("event_id").cast("double").alias("e"))
    model = train.fit_forest(rows, ["u", "e"], "value", {"numTrees": 3, "maxDepth": 3})
    rows.write.parquet(landed)
    stream = ingest_stream.read_stream(spark, landed, rows.schema, "parquet")
    score_stream.start_scoring(
        score_stream.scored_entries(stream, model, ["u", "e"], "ts", 4, "value"), log, checkpoint
    ).awaitTermination()
    batch = score_stream.scored_entries(rows, model, ["u", "e"], "ts", 4, "value")
    assert sorted(map(repr, logs.read_log(spark, log).drop("log_date").collect())) == sorted(map(repr, batch.collect()))


def test_waiting_rows_are_written_once():
    """Rows that come to an hour later do not write those before them again."""
    from types import SimpleNamespace

    import pandas as pd
    from pyspark.sql import types as T

    from tidewatch.operators.features import FeatureSpec
    from tidewatch.streaming import features as stream

    held, written, made, timers = {}, [], [], []

    def update(key, value):
        held[key] = value
        written.append(stream._unpacked(value[0]).num_rows)

    waiting = SimpleNamespace(getValue=held.get, updateValue=update, keys=lambda: list(held), removeKey=held.pop)
    number = SimpleNamespace(exists=lambda: bool(made), get=lambda: made[-1], update=made.append)
    handle = SimpleNamespace(
        getMapState=lambda *_: waiting, getValueState=lambda *_: number, listTimers=lambda: timers, registerTimer=timers.append
    )
    schema = T.StructType([T.StructField("value", T.DoubleType()), T.StructField(stream._MICROS, T.LongType())])
    series = stream._Series(FeatureSpec(target="value", order_by=(stream._MICROS,)), schema, ["value", "late"])
    series.init(handle)
    clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    for turn in range(10):
        rows = pd.DataFrame({"value": [1.0] * 20, stream._MICROS: range(1, 21), "key": "a"})
        assert not list(series.handleInputRows(("a",), iter([rows]), clock))
    assert sum(written) == 200 == sum(stream._unpacked(v[0]).num_rows for v in held.values())
