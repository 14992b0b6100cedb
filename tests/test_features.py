"""Feature model."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.operators.features import FeatureModel, FeatureSpec, add_features, fit_medians, impute
from tests.conftest import rows_of

NUMERIC = tuple(c for c in presets.WEATHER_COLUMNS if c != presets.WEATHER_TARGET)
SPEC = FeatureSpec(target=presets.WEATHER_TARGET, order_by=("time",), numeric=NUMERIC)


@pytest.fixture(scope="module")
def fitted(weather):
    return FeatureModel(SPEC).fit(weather)


def test_feature_columns(fitted):
    assert len(fitted.feature_columns) == 28
    assert "temperature_2m" not in fitted.feature_columns
    for name in ("temperature_2m_lag_24", "temperature_2m_roll_std_12", "hour_sin", "hour_cos"):
        assert name in fitted.feature_columns


def test_transform_equals_pandas(weather, fitted):
    pdf = weather.orderBy("time").toPandas().set_index("time")
    t = pdf["temperature_2m"]
    for n in presets.LAGS:
        pdf[f"temperature_2m_lag_{n}"] = t.shift(n)
    for n in presets.ROLLING_WINDOWS:
        pdf[f"temperature_2m_roll_mean_{n}"] = t.rolling(n, min_periods=1).mean()
        pdf[f"temperature_2m_roll_std_{n}"] = t.rolling(n, min_periods=1).std().fillna(0)
    pdf["hour_sin"] = np.sin(2 * math.pi * pdf.index.hour / 24)
    pdf["hour_cos"] = np.cos(2 * math.pi * pdf.index.hour / 24)
    pdf = pdf.dropna()
    x = pdf[fitted.feature_columns]
    std = x.std(ddof=0)
    expected = (x - x.mean()) / std.where(std > 0, 1.0)
    found = fitted.transform(weather).orderBy("time").toPandas()
    assert len(found) == 200 - 24
    np.testing.assert_allclose(found[fitted.feature_columns], expected, atol=1e-8)
    np.testing.assert_allclose(found["temperature_2m"], pdf["temperature_2m"])
    assert (found["snowfall"] == 0).all()


def test_unfitted_model_refuses(spark, weather, tmp_path):
    model = FeatureModel(SPEC)
    with pytest.raises(RuntimeError):
        model.transform(weather)
    with pytest.raises(RuntimeError):
        model.save(spark, str(tmp_path))


def test_same_columns_with_and_without_target(weather, fitted):
    with_target = fitted.transform(weather)
    without = fitted.transform(weather, include_target=False)
    assert [c for c in with_target.columns if c != "temperature_2m"] == without.columns


def test_save_and_load_round_trip(spark, weather, fitted, tmp_path):
    fitted.save(spark, str(tmp_path / "state"))
    loaded = FeatureModel.load(spark, str(tmp_path / "state"))
    assert loaded.spec == fitted.spec and loaded.feature_columns == fitted.feature_columns
    assert rows_of(loaded.transform(weather)) == rows_of(fitted.transform(weather))
    with pytest.raises(FileNotFoundError):
        FeatureModel.load(spark, str(tmp_path / "absent"))


def test_fit_transform_equals_fit_then_transform(weather, fitted):
    assert rows_of(FeatureModel(SPEC).fit_transform(weather)) == rows_of(fitted.transform(weather))


def test_medians_fill_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (8.0,)], "v double")
    medians = fit_medians(df, ["v", "absent"])
    assert medians == {"v": 3.0}
    assert sorted(r["v"] for r in impute(df, medians).collect()) == [1.0, 3.0, 3.0, 3.0, 8.0]


def test_rows_missing_any_feature_are_dropped(weather):
    holes = weather.withColumn("rain", F.lit(None).cast("double"))
    with pytest.raises(ValueError):
        FeatureModel(SPEC).fit(holes)


def test_previous_rows_only(spark):
    spec = FeatureSpec("v", ("i",), lags=(), windows=(2,), hour_of_day=False, include_current=False)
    df = spark.createDataFrame([(i, float(i * i)) for i in range(4)], "i long, v double")
    rows = add_features(df, spec).orderBy("i").collect()
    assert [r["v_roll_mean_2"] for r in rows] == [None, 0.0, 0.5, 2.5]


def test_series_do_not_mix(spark):
    spec = FeatureSpec("v", ("i",), keys=("k",), lags=(1,), windows=(3,), hour_of_day=False)
    df = spark.createDataFrame(
        [(k, i, float(10 * (k == "b") + i)) for k in "ab" for i in range(5)], "k string, i long, v double"
    )
    pdf = add_features(df, spec, hot_rows=2, block_rows=3).toPandas().sort_values(["k", "i"])
    expected = pdf.groupby("k")["v"].shift(1)
    pd.testing.assert_series_equal(pdf["v_lag_1"], expected, check_names=False)
