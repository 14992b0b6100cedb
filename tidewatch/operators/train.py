"""Random-forest training with expanding-window model selection."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.operators import forest
from tidewatch.operators.evaluate import fold_blocks
from tidewatch.operators.forest import Forest
from tidewatch.plans.staging import scratch

CV_RESULTS = "combination int, params map<string,string>, fold int, mae double"


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    params: Mapping[str, Any] | None = None,
    seed: int = presets.SEED,
    order_by: Sequence[str] = (),
) -> Forest:
    """Forest over all features per split, as regression forests commonly use.

    ``order_by`` names the rows, so that each is drawn for the same trees whatever its values.
    """
    with scratch(df.sparkSession):
        return forest.fit(df, features, target, params, seed, _key(order_by) if order_by else None)


def _key(order_by: Sequence[str]):
    return F.xxhash64(*[F.col(f"`{c}`") for c in order_by])


def combinations(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Every parameter combination, last parameter fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: Sequence[str],
    grid: Mapping[str, Sequence[Any]] = presets.PARAM_GRID,
    folds: int = presets.CV_FOLDS,
    seed: int = presets.SEED,
) -> DataFrame:
    """Mean absolute error of every (combination, fold).

    Each fold trains on the rows before its test block only. Trees are grown once per fold and
    leaf size; depths, split sizes and tree counts are cuts of them.
    """
    spark = df.sparkSession
    asked = combinations(grid)
    alike: dict[tuple, list[int]] = {}
    for c, params in enumerate(asked):
        want = forest.Params.of(params)
        alike.setdefault((want.bootstrap, want.maxBins), []).append(c)
    found = {}
    with scratch(spark):
        blocks = fold_blocks(df.select(*dict.fromkeys([*order_by, *features, target])), order_by, folds)
        for some in alike.values():
            errors = forest.validation_errors(
                blocks, features, target, [asked[c] for c in some], folds, seed, _key(order_by)
            )
            found |= {(some[c], k): mae for (c, k), mae in errors.items()}
    rows = [(c, {n: str(v) for n, v in asked[c].items()}, k, mae) for (c, k), mae in sorted(found.items())]
    return spark.createDataFrame(rows, CV_RESULTS)


def best_combination(results: DataFrame) -> DataFrame:
    """Combination with the lowest mean error over folds; the first one on ties."""
    means = results.groupBy("combination").agg(
        F.first("params").alias("params"),
        F.avg("mae").alias("mean_mae"),
        F.count(F.lit(1)).alias("folds"),
    )
    return means.orderBy("mean_mae", "combination").limit(1).select(
        "combination", "params", "folds", F.round(-F.col("mean_mae"), 4).alias("cv_score")
    )


def tune(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order_by: Sequence[str],
    grid: Mapping[str, Sequence[Any]] = presets.PARAM_GRID,
    folds: int = presets.CV_FOLDS,
    seed: int = presets.SEED,
) -> tuple[Forest, dict[str, Any], float]:
    """Best model refitted on all rows, its parameters, and its cross-validation score."""
    results = cross_validate(df, features, target, order_by, grid, folds, seed)
    best = best_combination(results).first()
    params = combinations(grid)[best["combination"]]
    return fit_forest(df, features, target, params, seed, order_by), params, best["cv_score"]
