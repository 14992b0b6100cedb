"""Merged states against the profile of all versions at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import profile
from tidewatch.operators.profile_state import ProfileState
from tests.conftest import SF, rows_of

EXACT = ["column", "count", "mean", "std", "min", "max", "skewness", "kurtosis", "zeros", "negatives"]


def test_ten_versions_equal_their_union(spark, tmp_path):
    state = ProfileState(spark, str(tmp_path / "state"))
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    for v in range(10):
        state.add(lines.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(10)) == v), f"v{v}")
    state.add(lines.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(10)) == 3), "v3")  # filed again
    assert state.states().count() == 10 * len(lines.columns)
    whole = profile.numeric_stats(lines)
    assert rows_of(state.numeric_stats().select(*EXACT)) == rows_of(whole.select(*EXACT))
    missing = {r["column"]: r["missing"] for r in state.missing().collect()}
    assert missing == {c: lines.filter(F.col(c).isNull()).count() for c in lines.columns}
    near = {r["column"]: r["p50"] for r in state.numeric_stats().collect()}
    for column, value in near.items():
        values = np.sort([r[0] for r in lines.select(column).dropna().collect()])
        low, high = np.searchsorted(values, value, "left"), np.searchsorted(values, value, "right")
        assert low - 0.02 * len(values) <= len(values) / 2 <= high + 0.02 * len(values)


def test_columns_that_come_and_go(spark, tmp_path):
    state = ProfileState(spark, str(tmp_path / "state"))
    assert state.states().count() == 0
    state.add(spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b")], "x double, s string"), "1")
    state.add(spark.createDataFrame([(5.0, 1e9), (9.0, 1e9 + 2)], "x double, y double"), "2")
    state.add(spark.createDataFrame([], "x double, y double"), "3")
    missing = {r["column"]: (r["missing"], r["percent"]) for r in state.missing().collect()}
    assert missing == {"x": (2, 40.0), "s": (3, 60.0), "y": (3, 60.0)}
    found = {r["column"]: r for r in state.numeric_stats().collect()}
    assert set(found) == {"x", "y"} and found["x"]["count"] == 3 and found["x"]["mean"] == 5.0
    assert found["y"]["std"] == pytest.approx(1.4142, abs=1e-4) and found["y"]["mean"] == 1e9 + 1


def test_text_only(spark, tmp_path):
    state = ProfileState(spark, str(tmp_path / "state"))
    state.add(spark.createDataFrame([("a",)], "s string"), "1")
    assert state.numeric_stats().count() == 0 and state.missing().first()["missing"] == 0
