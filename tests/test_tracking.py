"""Registry, runs and fingerprints."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import registry as reg
from tidewatch.operators.registry import ModelRegistry
from tidewatch.operators.runs import (
    RunLog,
    best_run,
    compare_runs,
    fingerprint,
    list_runs,
    metric_over_runs,
    run_history,
)

METRICS = {"mae": 1.5, "rmse": 2.0, "r2": 0.9}


@pytest.fixture
def registry(spark, tmp_path):
    return ModelRegistry(spark, str(tmp_path / "registry"))


def test_versions_count_up_and_first_is_production(registry):
    assert registry.production_version() is None
    assert [registry.register(f"m{i}", METRICS) for i in range(3)] == [1, 2, 3]
    assert registry.production_version() == 1
    flags = {r["version"]: r["is_production"] for r in registry.models().collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_promotion(registry):
    registry.register("m1", METRICS)
    registry.register("m2", METRICS)
    registry.promote(2)
    flags = {r["version"]: r["is_production"] for r in registry.models().collect()}
    assert flags == {1: False, 2: True}
    registry.promote(1)
    assert registry.info().first()["version"] == 1
    with pytest.raises(ValueError):
        registry.promote(9)
    assert registry.production_version() == 1


def test_info(registry):
    registry.register("path/m1", METRICS, {"rows": 5})
    row = registry.info(1).first()
    assert row["model_path"] == "path/m1" and row["metrics"]["mae"] == 1.5
    assert row["training_info"] == {"rows": "5"}
    with pytest.raises(ValueError):
        registry.info(2)


def test_compare(registry):
    registry.register("m1", METRICS)
    registry.register("m2", {"mae": 1.0, "rmse": 1.5, "extra": 3.0})
    diff = {r["metric"]: r["diff"] for r in registry.compare(1, 2).collect()}
    assert diff == {"mae": -0.5, "rmse": -0.5}
    with pytest.raises(ValueError):
        registry.compare(1, 7)


def test_best_versions(registry):
    registry.register("m1", {"mae": 2.0, "rmse": 2.0, "r2": 0.5})
    registry.register("m2", {"mae": 1.0, "rmse": 2.0, "r2": 0.5})
    registry.register("m3", {"mae": 3.0, "r2": 0.5})
    best = {r["metric"]: (r["value"], r["version"]) for r in reg.best_versions(registry.events()).collect()}
    assert best == {"mae": (1.0, 2), "rmse": (0.0, 3), "r2": (0.5, 1)}


def test_promotion_of_unknown_version_in_the_events_is_ignored(spark):
    now = dt.datetime(2024, 1, 1)
    rows = [(now, 1, "register", 1, "m", {"mae": 1.0}, None), (now, 2, "promote", 5, None, None, None)]
    assert reg.production_version(spark.createDataFrame(rows, reg.REGISTRY_EVENTS)) == 1


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    log = RunLog(spark, str(tmp_path_factory.mktemp("runs") / "log"))
    at = dt.datetime(2024, 1, 1, 8, 30, 15, 123456)
    day = dt.timedelta(days=1)
    log.append("run_1", "training", 1.234, {"depth": None, "trees": 50}, {"mae": 2.0}, at=at)
    log.append("run_2", "training", 2, {"trees": 100, "grid": [1, 2]}, {"mae": 1.0, "r2": 0.9},
               {"model_version": "2"}, git_commit="abc", at=at + day)
    log.append("run_3", "other", 3, at=at + 2 * day)
    return log.runs()


def test_list_runs(runs):
    assert [r["run_id"] for r in list_runs(runs).collect()] == ["run_3", "run_2", "run_1"]
    assert [r["run_id"] for r in list_runs(runs, "training").collect()] == ["run_2", "run_1"]


def test_parameters_are_text(runs):
    params = {r["run_id"]: r["params"] for r in runs.collect()}
    assert params["run_1"] == {"depth": "None", "trees": "50"}
    assert params["run_2"] == {"trees": "100", "grid": "[1, 2]"}


def test_best_run(runs):
    assert best_run(runs).first()["run_id"] == "run_2"
    assert best_run(runs, "mae", lower_is_better=False).first()["run_id"] == "run_1"
    assert best_run(runs, "absent").count() == 0


def test_compare_runs(spark, runs):
    ids = spark.createDataFrame([("run_1",), ("run_2",), ("run_9",)], "run_id string")
    table = compare_runs(runs, ids)
    assert table.columns == ["run_id", "timestamp", "duration_s", "git_commit", "metric_mae", "metric_r2",
                             "param_depth", "param_grid", "param_trees"]
    rows = {r["run_id"]: r for r in table.collect()}
    assert rows["run_1"]["timestamp"] == "2024-01-01T08:30:15" and rows["run_1"]["metric_r2"] is None
    assert rows["run_1"]["git_commit"] == "N/A" and rows["run_1"]["duration_s"] == 1.23
    assert compare_runs(runs, ids.limit(0)).count() == 0


def test_history_and_series(runs):
    rows = {r["run_id"]: r for r in run_history(runs).collect()}
    assert rows["run_3"]["mae"] == "N/A" and rows["run_2"]["model_version"] == "2"
    assert [r["run_id"] for r in metric_over_runs(runs).collect()] == ["run_1", "run_2"]


def test_missing_log_is_empty(spark, tmp_path):
    assert RunLog(spark, str(tmp_path / "absent")).runs().count() == 0


def test_fingerprint_depends_on_rows_only(spark):
    df = spark.createDataFrame([(i, f"n{i}" if i % 3 else None) for i in range(50)], "i long, s string")
    first = fingerprint(df).first()
    assert first == fingerprint(df.repartition(7).orderBy(F.rand(1))).first()
    assert first["row_count"] == 50 and first["column_count"] == 2 and len(first["data_hash"]) == 12
    assert first["data_hash"] != fingerprint(df.filter("i > 0")).first()["data_hash"]
    assert first["data_hash"] != fingerprint(df.fillna("")).first()["data_hash"]
