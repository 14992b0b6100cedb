"""Prediction and request logs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import monitor
from tidewatch.sources import logs

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        (START + dt.timedelta(hours=i), i, i / 7, None if i % 2 else float(i), float(i % 5)) for i in range(60)
    ]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v int, p double, y double, x double")
    names = F.when(F.col("v") == 0, F.create_map(F.lit("x"), F.col("x"))).otherwise(
        F.create_map(F.lit("x"), F.col("x"), F.lit("late"), F.col("p"))
    )
    spread = F.struct(F.col("x").alias("std"), F.col("p").alias("min"), F.col("p").alias("max"))
    return monitor.log_entries(df, F.col("t"), F.col("v"), F.col("p"), names, spread, F.col("y"))


def test_derived_fields(log):
    rows = log.orderBy("timestamp").limit(3).collect()
    assert [r["prediction"] for r in rows] == [0.0, 0.1429, 0.2857]
    assert [r["error"] for r in rows] == [0.0, None, 1.7143]


def test_log_round_trip(spark, log, tmp_path):
    path = str(tmp_path / "log")
    logs.append_log(log.filter("model_version < 30"), path)
    logs.append_log(log.filter("model_version >= 30"), path)
    read = logs.read_log(spark, path)
    assert sorted(map(repr, read.drop("log_date").collect())) == sorted(map(repr, log.collect()))
    newest = [r["model_version"] for r in logs.read_log(spark, path, limit=3).collect()]
    assert newest == [59, 58, 57]
    assert logs.read_log(spark, path, limit=0).count() == 60
    assert logs.read_log(spark, str(tmp_path / "absent")).count() == 0


def test_period_is_strict_and_falls_back(log):
    as_of = START + dt.timedelta(hours=59)
    assert monitor.in_period(log, 1, as_of).count() == 24
    assert monitor.in_period(log, 1, as_of + dt.timedelta(days=9)).count() == 60


def test_period_ignores_the_session_zone(spark, log):
    as_of = START + dt.timedelta(hours=59)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert monitor.in_period(log, 1, as_of).count() == 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_prediction_stats(log):
    p = np.round(np.arange(60) / 7, 4)
    row = monitor.prediction_stats(log).first()
    assert row["count"] == 60
    assert row["std"] == pytest.approx(np.std(p), abs=1e-4)
    assert row["median"] == pytest.approx(np.median(p), abs=1e-4)


def test_feature_stats_cover_keys_absent_from_the_first_row(log):
    rows = {r["feature"]: r for r in monitor.feature_stats(log).collect()}
    assert set(rows) == {"x", "late"}
    assert rows["x"]["mean"] == 2.0 and rows["x"]["std"] == pytest.approx(np.sqrt(2), abs=1e-4)


def test_report(spark, log):
    report = monitor.monitoring_report(log, 1, START + dt.timedelta(hours=59))
    values = {(r["section"], r["name"], r["measure"]): r["value"] for r in report.collect()}
    assert values["prediction", "", "count"] == 24
    assert values["error", "", "with_actual"] == 12
    assert values["confidence", "", "max_std"] == 4.0
    assert ("feature", "late", "mean") in values
    empty = monitor.monitoring_report(log.limit(0)).collect()
    assert [r["name"] for r in empty] == ["no_data"]


def test_requests(spark):
    rows = [
        (START + dt.timedelta(seconds=i), "/predict" if i % 2 == 0 else "/health", 500 if i % 10 == 0 else 200, float(i))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, path string, status int, duration_ms double")
    assert tuple(monitor.request_totals(df).first()) == (3000, 300, 0.1)
    last = [r[3] for r in rows if r[1] == "/predict"][-1000:]
    expected = (1000, round(sum(last) / 1000, 2), last[500], last[950], last[990], last[-1])
    assert tuple(monitor.latency_stats(df).first()) == expected
    assert monitor.latency_stats(df, "/absent").count() == 0
    assert monitor.request_totals(df.limit(0)).first()["error_rate"] == 0


def test_recent_and_summary(log):
    recent = monitor.recent_predictions(log, 2).collect()
    assert [r["model"] for r in recent] == ["v59", "v58"]
    assert monitor.prediction_timeline(log, 5).count() == 5
    row = monitor.feature_summary(log, "x", last=5).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (5, 2.0, 0.0, 4.0)
    plan = monitor.recent_predictions(log)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_histogram(log):
    values = log.select(F.col("input_features.x").alias("x"))
    assert [tuple(r) for r in monitor.value_histogram(values, "x").collect()] == [(float(i), 12) for i in range(5)]
