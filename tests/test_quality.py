"""Validation and profiles."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.operators import profile, validate


def messages(df, severity, **rules):
    return [r["message"] for r in validate.findings(df, **rules).collect() if r["severity"] == severity]


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_valid_table(spark):
    df = frame(spark, "temperature_2m double, relative_humidity_2m double, pressure_msl double",
               (15.0, 60.0, 1013.0), (16.0, 61.0, 1014.0), (17.0, 62.0, 1012.0))
    rules = {"required": ["temperature_2m", "relative_humidity_2m"]}
    verdict = validate.verdict(df, **rules).first()
    assert verdict["is_valid"] and verdict["error_count"] == 0 and verdict["row_count"] == 3
    validate.require_valid(df, **rules)


def test_missing_column_is_an_error(spark):
    df = frame(spark, "temperature_2m double", (15.0,))
    rules = {"required": ["temperature_2m", "pressure_msl"]}
    assert messages(df, "error", **rules) == ["Missing required columns: pressure_msl"]
    with pytest.raises(validate.ValidationError, match="pressure_msl"):
        validate.require_valid(df, **rules)


def test_empty_table_reports_nothing_else(spark):
    df = spark.createDataFrame([], "a double, b double")
    found = validate.findings(df, required=["c"], ranges={"a": (0, 1)}).collect()
    assert [r["message"] for r in found] == ["DataFrame is empty"]
    assert not validate.verdict(df, required=["c"]).first()["is_valid"]


def test_nulls_and_nan_warn_and_full_columns_fail(spark):
    nan = float("nan")
    df = frame(spark, "col_a double, col_b double, col_c double",
               (1.0, 1.0, None), (None, 2.0, nan), (nan, 3.0, None), (None, 4.0, None), (5.0, 5.0, nan))
    warnings = messages(df, "warning")
    assert warnings == [
        "Column 'col_a' has 60.0% nulls (threshold: 10.0%)",
        "Column 'col_c' has 100.0% nulls (threshold: 10.0%)",
    ]
    assert messages(df, "error") == ["Column 'col_c' is entirely null"]
    report = {r["column"]: tuple(r)[1:] for r in validate.null_report(df).collect()}
    assert report == {"col_a": (3, 0.6), "col_b": (0, 0.0), "col_c": (5, 1.0)}


def test_null_threshold_is_strict(spark):
    df = frame(spark, "a double", *[(1.0,)] * 9, (None,))
    assert messages(df, "warning") == []


def test_range_break_warns_but_stays_valid(spark):
    df = frame(spark, "temperature_2m double, name string", (15.0, "x"), (100.0, "y"))
    ranges = {"temperature_2m": (-60, 60), "name": (0, 1), "absent": (0, 1)}
    assert len(messages(df, "warning", ranges=ranges)) == 1
    assert validate.verdict(df, ranges=ranges).first()["is_valid"]
    assert messages(df, "warning", ranges={"temperature_2m": (15, 100)}) == []


def test_weather_preset(spark):
    df = frame(spark, ", ".join(f"{c} double" for c in [*presets.WEATHER_REQUIRED, "precipitation"]),
               (15.0, 60.0, 1013.0, 10.0, 0.0), (16.0, 65.0, 1012.0, 12.0, 0.5))
    verdict = validate.verdict(df, presets.WEATHER_REQUIRED, ranges=presets.WEATHER_RANGES).first()
    assert verdict["is_valid"] and verdict["warning_count"] == 0


def test_scoring_requests(spark, weather):
    requests = weather.withColumn("hour", F.when(F.hour("time") > 0, F.hour("time"))).limit(30)
    checked = validate.check_rows(requests)
    assert checked.filter(~F.col("accepted")).count() == 0
    assert checked.filter("hour IS NULL").count() == 0
    broken = requests.select(*[
        F.lit(400.0).alias(c) if c == "wind_direction_10m" else
        F.lit(None).cast("double").alias(c) if c == "rain" else F.col(c) for c in requests.columns
    ])
    row = validate.check_rows(broken).first()
    assert row["reasons"] == ["rain: missing", "wind_direction_10m: above 360"]
    assert not row["accepted"]


def test_numeric_stats_equal_pandas(spark, weather):
    df = weather.withColumn("rain", F.when(F.col("rain") < 0.4, F.col("rain")))
    pdf = df.toPandas().drop(columns="time")
    rows = {r["column"]: r for r in profile.numeric_stats(df).collect()}
    assert list(pdf.columns) == sorted(rows, key=list(pdf.columns).index)
    for c in pdf.columns:
        s, r = pdf[c].dropna(), rows[c]
        assert r["count"] == len(s)
        for name, value in (("mean", s.mean()), ("std", s.std()), ("p25", s.quantile(0.25)),
                            ("p50", s.median()), ("p75", s.quantile(0.75)), ("skewness", s.skew()),
                            ("kurtosis", s.kurtosis()), ("min", s.min()), ("max", s.max())):
            assert r[name] == pytest.approx(value, abs=6e-5), (c, name)
        assert (r["zeros"], r["negatives"]) == (int((s == 0).sum()), int((s < 0).sum()))


def test_moments_of_few_values(spark):
    df = frame(spark, "a double, b double", (1.0, None), (2.0, None), (4.0, None))
    (row,) = profile.numeric_stats(df).collect()
    assert row["column"] == "a" and row["kurtosis"] is None
    assert row["skewness"] == pytest.approx(pd.Series([1.0, 2.0, 4.0]).skew(), abs=1e-4)


def test_outliers(spark):
    df = frame(spark, "v double", *[(float(i),) for i in range(10)], (100.0,), (None,))
    (row,) = profile.outliers(df).collect()
    assert (row["outliers"], row["percent"]) == (1, 9.09)
    assert (row["lower_bound"], row["upper_bound"]) == (-5.0, 15.0)


def test_correlations_are_pairwise_complete(spark, weather):
    df = weather.withColumn("rain", F.when(F.col("rain") < 0.4, F.col("rain")))
    expected = df.toPandas().drop(columns="time").corr()
    found = profile.correlation_matrix(df).collect()
    assert len(found) == 13 * 13
    for r in found:
        value = expected.loc[r["column_a"], r["column_b"]]
        if pd.isna(value):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(value, abs=6e-5)
    top = profile.top_pairs(profile.correlations(df), 3).collect()
    sizes = [abs(r["correlation"]) for r in top]
    assert len(top) == 3 and sizes == sorted(sizes, reverse=True)
    assert profile.correlations(df.select("rain")).count() == 0


def test_missing_counts_cells(spark):
    df = frame(spark, "a double, b string", (1.0, None), (float("nan"), "x"), (3.0, "y"))
    rows = {(r["scope"], r["column"]): (r["missing"], r["cells"], r["percent"])
            for r in profile.missing(df).collect()}
    assert rows == {("column", "a"): (1, 3, 33.33), ("column", "b"): (1, 3, 33.33),
                    ("total", ""): (2, 6, 33.33)}
    empty = profile.missing(spark.createDataFrame([], df.schema)).filter("scope = 'total'").first()
    assert empty["percent"] == 0


@pytest.mark.parametrize(
    "offsets, frequency, gaps",
    [
        (range(0, 48), "h", 0),
        (range(0, 480, 24), "D", 19),
        (range(0, 20, 2), "2h", 0),
        ([0, 1, 2, 5, 6, 20], "irregular", 2),
        ([0, 0, 2, 2, 4], "irregular", 0),
        ([0, 9], None, 1),
    ],
)
def test_temporal(spark, offsets, frequency, gaps):
    start = dt.datetime(2023, 12, 31, 21, 30)
    df = frame(spark, "t timestamp_ntz", *[(start + dt.timedelta(hours=h),) for h in offsets])
    row = profile.temporal(df, "t").first()
    assert (row["frequency"], row["gaps"]) == (frequency, gaps)
    assert row["start"] == start
    assert row["duration_days"] == (max(offsets) // 24)


@pytest.mark.parametrize("era_slots", [1, 3, 10_000])
@pytest.mark.parametrize("hours", [[-1.5, 1.5], [-40, -37.9, 0, 2, 4.5, 90, 300.25], [5]])
def test_gaps_across_slots_and_eras(spark, monkeypatch, era_slots, hours):
    monkeypatch.setattr(profile, "_ERA_SLOTS", era_slots)
    epoch = dt.datetime(1970, 1, 1)
    df = frame(spark, "k int, t timestamp_ntz", *[(k, epoch + dt.timedelta(hours=h)) for h in hours for k in (1, 2)])
    expected = sum(b - a > 2 for a, b in zip(hours, hours[1:]))
    assert profile.gaps(df, "t").first()["gaps"] == expected
    assert [r["gaps"] for r in profile.gaps(df, "t", ["k"]).collect()] == [expected] * 2


def test_report_has_every_section(spark, weather):
    report = profile.report(weather, "time")
    sections = {r["section"] for r in report.select("section").distinct().collect()}
    assert sections == {"shape", "missing", "numeric", "outliers", "top_pairs", "temporal"}
    frequency = report.filter("section = 'temporal' AND measure = 'frequency'").first()
    assert frequency["text"] == "h"


@pytest.mark.parametrize(
    "freq", ["MS", "ME", "QS-OCT", "QS-NOV", "QE-DEC", "YS-JAN", "YS-APR", "YE-JUN", "W-MON", "W-SUN", "2W-TUE", "B", "2MS", "D", "3D", "h", "15min", "2YS-JAN"],
)
def test_frequencies_are_named_as_pandas_names_them(spark, freq):
    import pandas as pd

    times = pd.date_range("2021-01-05 06:00", periods=12, freq=freq)
    df = spark.createDataFrame([(t.to_pydatetime(),) for t in times], "t timestamp_ntz")
    inferred = pd.infer_freq(times)
    found = profile.temporal(df.repartition(3), "t").first()["frequency"]
    # The quarters that begin in January are also those that begin in October.
    assert found == inferred or (inferred[:2] == found[:2] and inferred[:1] == "Q")


@pytest.mark.parametrize("days", [["2024-01-01", "2024-02-01", "2024-02-01"], ["2024-01-31", "2024-02-28", "2024-03-31"], ["2024-01-01", "2024-02-01", "2024-04-01"]])
def test_broken_calendars_are_irregular(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("cast(d as timestamp_ntz) t")
    assert profile.temporal(df, "t").first()["frequency"] == "irregular"


def test_correlations_take_one_pass_without_copies_of_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) * [1, 1e-3, 5, 0] + [0, 1e6, -3, 7.1]
    x[:, 2] += 3 * x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double")
    found = profile.correlation_matrix(df.repartition(5))
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in found.collect()}
    want = pd.DataFrame(x, columns=list("abcd")).corr()
    assert len(got) == 16
    for (a, b), r in got.items():
        assert r is None if "d" in (a, b) else r == pytest.approx(want.loc[a, b], abs=6e-5)
