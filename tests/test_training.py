"""Splits, metrics, forests and importance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import evaluate, importance, score, train
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def linear(spark):
    """y depends strongly on a, weakly on b and not on c."""
    rng = np.random.default_rng(7)
    a, b, c = rng.normal(size=(3, 400))
    y = 5 * a + b + 0.1 * rng.normal(size=400)
    rows = [(i, *map(float, v)) for i, v in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "i long, a double, b double, c double, y double")


@pytest.fixture(scope="module")
def model(linear):
    return train.fit_forest(linear, ["a", "b", "c"], "y", {"numTrees": 5, "maxDepth": 5})


def test_temporal_split(spark):
    df = spark.range(100).withColumnRenamed("id", "a")
    first, rest = evaluate.temporal_split(df, ["a"], 0.2)
    assert [r["a"] for r in first.orderBy("a").collect()] == list(range(80))
    assert [r["a"] for r in rest.orderBy("a").collect()] == list(range(80, 100))


@pytest.mark.parametrize("size, train_rows", [(0.0, 10), (1.0, 0), (0.9, int(10 * (1 - 0.9)))])
def test_temporal_split_limits(spark, size, train_rows):
    first, rest = evaluate.temporal_split(spark.range(10), ["id"], size)
    assert (first.count(), rest.count()) == (train_rows, 10 - train_rows)


def test_expanding_folds(spark):
    df = spark.range(23)
    folds = [
        (sorted(r["id"] for r in a.collect()), sorted(r["id"] for r in b.collect()))
        for a, b in evaluate.expanding_folds(df, ["id"], 5)
    ]
    starts = [8, 11, 14, 17, 20]
    assert folds == [(list(range(s)), list(range(s, s + 3))) for s in starts]
    with pytest.raises(ValueError):
        evaluate.fold_bounds(4, 5)


def test_metrics(spark):
    def of(*pairs):
        df = spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "y double, p double")
        return tuple(evaluate.regression_metrics(df, "y", "p").first())

    assert of((1, 1), (2, 2), (3, 3)) == (0.0, 0.0, 1.0)
    assert of((1, 2), (2, 2), (3, 2)) == (0.6667, 0.8165, 0.0)
    assert of((2, 2), (2, 2)) == (0.0, 0.0, 1.0)
    assert of((2, 1), (2, 2))[2] == 0.0


def test_cross_validation_picks_the_better_combination(linear):
    grid = {"numTrees": [3], "maxDepth": [1, 6]}
    results = train.cross_validate(linear, ["a", "b", "c"], "y", ["i"], grid, folds=2)
    assert results.count() == 4
    best = train.best_combination(results).first()
    assert best["params"] == {"numTrees": "3", "maxDepth": "6"}
    assert best["folds"] == 2 and best["cv_score"] < 0


def test_spread_agrees_with_the_forest(linear, model):
    plain = score.score(linear, model, ["a", "b", "c"]).select("i", F.round("prediction", 9))
    spread = score.score_with_spread(linear, model, ["a", "b", "c"])
    assert rows_of(spread.select("i", F.round("prediction", 9))) == rows_of(plain)
    for r in spread.limit(20).collect():
        c = r["confidence"]
        assert c["min"] - 0.01 <= r["prediction"] <= c["max"] + 0.01 and c["std"] >= 0


def test_importances_find_the_strong_feature(linear, model):
    builtin = {r["feature"]: r["importance"] for r in
               importance.builtin_importance(linear, model, ["a", "b", "c"]).collect()}
    assert sum(builtin.values()) == pytest.approx(1, abs=1e-5)
    permuted = importance.permutation_importance(linear, model, ["a", "b", "c"], "y", ["i"], repeats=3)
    means = {r["feature"]: r["perm_mean"] for r in permuted.collect()}
    for found in (builtin, means):
        assert found["a"] > found["b"] > found["c"]
    again = importance.permutation_importance(linear, model, ["a", "b", "c"], "y", ["i"], repeats=3)
    assert rows_of(again) == rows_of(permuted)


@pytest.mark.parametrize("n", [1, 2, 7, 100, 99991])
def test_permutations_are_bijections(n):
    for a, b in importance._bijections(n, 3, seed=1):
        if n <= 100:
            assert sorted((a * i + b) % n for i in range(n)) == list(range(n))
        assert a * (n - 1) + b < 2**63


def test_combined_ranking(spark):
    features = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "ordinal int, feature string")
    perm = spark.createDataFrame([("y", 9.0), ("x", 5.0), ("z", 1.0)], "feature string, score double")
    builtin = spark.createDataFrame([("x", 0.7), ("z", 0.3)], "feature string, score double")
    both = {r["feature"]: (r["avg_rank"], r["position"])
            for r in importance.combined_ranking(features, perm, builtin).collect()}
    assert both == {"x": (0.5, 1), "y": (1.5, 2), "z": (1.5, 3)}
    alone = {r["feature"]: r["position"] for r in importance.combined_ranking(features, perm).collect()}
    assert alone == {"y": 1, "x": 2, "z": 3}


def test_queries_search_the_whole_grid(spark, monkeypatch):
    from tests.conftest import SF
    from tidewatch import presets
    from tidewatch.workload import stored, trained

    asked = []

    def search(df, features, target, order_by, grid=presets.PARAM_GRID, *more, **named):
        asked.append(grid)
        return spark.createDataFrame([(0, {}, 0, 1.0)], train.CV_RESULTS)

    monkeypatch.setattr(train, "cross_validate", search)
    assert trained.tr_cv_best(spark, SF).count() == 1
    assert asked == [presets.PARAM_GRID]
    assert stored.JOB_PLAN.grid == presets.PARAM_GRID and len(train.combinations(stored.JOB_PLAN.grid)) == 108


def test_scoring_job_scores_with_a_forest_from_the_whole_search(spark, monkeypatch):
    """Its trees differ; the tree of one split is a query of its own."""
    from tests.conftest import SF
    from tidewatch import presets
    from tidewatch.workload import stored

    asked = []

    def search(df, features, target, order_by, grid, folds, seed):
        asked.append((grid, folds, len(features)))
        params = {"numTrees": 3, "maxDepth": 4}
        return train.fit_forest(df, features, target, params, seed, order_by), params, -1.0

    monkeypatch.setattr(train, "tune", search)
    for report in ("_store_profile", "_store_importance"):
        monkeypatch.setattr(stored.jobs, report, lambda *_: None)
    found = stored.job_score(spark, SF).toPandas()
    assert asked == [(presets.PARAM_GRID, presets.CV_FOLDS, len(stored.JOB_SPEC.feature_columns))]
    # All but the first 24 rows of the five types, which lack lags.
    assert len(found) == 1000 - 5 * 24 and (found["std"] > 0).mean() > 0.9 and found["prediction"].nunique() > 10
    assert stored.QUERIES["job_score_stump"] is stored.job_score_stump and "job_score_stump" in stored.ORACLE
