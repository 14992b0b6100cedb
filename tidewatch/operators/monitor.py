"""Prediction-log and request-log analytics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import clock, position_percentile
from tidewatch.functions.columns import clean
from tidewatch.plans.selection import exact_quantiles

PREDICTION_LOG = (
    "timestamp timestamp_ntz, model_version int, prediction double, "
    "input_features map<string,double>, confidence struct<std:double,min:double,max:double>, "
    "actual double, error double"
)
DATED_LOG = PREDICTION_LOG + ", log_date date"
LATENCY_WINDOW = 1000


def log_entries(
    df: DataFrame,
    timestamp: Column,
    model_version: Column,
    prediction: Column,
    input_features: Column,
    confidence: Column | None = None,
    actual: Column | None = None,
) -> DataFrame:
    """Prediction-log rows with the derived fields: 4-decimal prediction and error."""
    truth = F.lit(None).cast("double") if actual is None else actual.cast("double")
    spread = F.lit(None) if confidence is None else confidence
    return df.select(
        timestamp.cast("timestamp_ntz").alias("timestamp"),
        model_version.cast("int").alias("model_version"),
        F.round(prediction, 4).alias("prediction"),
        input_features.cast("map<string,double>").alias("input_features"),
        spread.cast("struct<std:double,min:double,max:double>").alias("confidence"),
        truth.alias("actual"),
        F.round(F.abs(truth - prediction), 4).alias("error"),
    )


def last_rows(log: DataFrame, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` entries, newest first; a top-k, not a sort."""
    return log.orderBy(F.col("timestamp").desc(), *[F.col(c).desc() for c in ties]).limit(n)


def in_period(log: DataFrame, days: float, as_of: datetime) -> DataFrame:
    """Entries less than ``days`` old, or the whole log when there are none.

    A log filed by day is also filtered on the day, so that older days are not read.
    """
    cutoff = as_of - timedelta(seconds=days * 86_400)
    recent = log.filter(F.col("timestamp") > clock(cutoff))
    if "log_date" in log.columns:
        recent = recent.filter(F.col("log_date") >= F.lit(cutoff.date()))
    return log if recent.isEmpty() else recent


def known(column: str) -> Column:
    """A number of the log with NaN read as NULL."""
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def _rounded(median: float | None) -> Column:
    """Rounded as the decimal number that it stands for: the mean of two logged values may lie
    halfway, where its binary form falls to either side."""
    value = F.lit(median).cast("double")
    return F.coalesce(F.round(value.try_cast("decimal(38,12)"), 4).cast("double"), F.round(value, 4))


def prediction_stats(log: DataFrame) -> DataFrame:
    """Count, mean, population std, min, max and exact median (4 decimals)."""
    median = exact_quantiles(log, ["prediction"], [0.5])["prediction", 0.5]
    return log.agg(
        F.count(known("prediction")).alias("count"),
        F.round(F.avg(known("prediction")), 4).alias("mean"),
        F.round(F.stddev_pop(known("prediction")), 4).alias("std"),
        F.round(F.min(known("prediction")), 4).alias("min"),
        F.round(F.max(known("prediction")), 4).alias("max"),
        _rounded(median).alias("median"),
    )


def feature_stats(log: DataFrame) -> DataFrame:
    """Mean, population std (4 decimals), min and max (2 decimals) per input feature."""
    values = log.select(F.explode("input_features").alias("feature", "value"))
    return values.filter("value IS NOT NULL AND NOT isnan(value)").groupBy("feature").agg(
        F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev_pop("value"), 4).alias("std"),
        F.round(F.min("value"), 2).alias("min"),
        F.round(F.max("value"), 2).alias("max"),
    )


def confidence_stats(log: DataFrame) -> DataFrame:
    """Mean and maximum of the spread between trees."""
    return log.agg(
        F.round(F.avg(known("confidence.std")), 4).alias("mean_std"),
        F.round(F.max(known("confidence.std")), 4).alias("max_std"),
    )


def error_stats(log: DataFrame) -> DataFrame:
    """Count, mean and maximum error over the rows with a known outcome."""
    return log.agg(
        F.count(known("error")).alias("count"),
        F.round(F.avg(known("error")), 4).alias("mean_error"),
        F.round(F.max(known("error")), 4).alias("max_error"),
    )


def monitoring_report(log: DataFrame, days: float = 1, as_of: datetime | None = None) -> DataFrame:
    """Report rows (section, name, measure, value).

    An empty log gives the single row of section "status" named "no_data".
    """
    if log.isEmpty():
        return log.sparkSession.range(1).select(
            F.lit("status").alias("section"),
            F.lit("no_data").alias("name"),
            F.lit("count").alias("measure"),
            F.lit(0.0).alias("value"),
        )
    recent = in_period(log, days, as_of or datetime.now())

    def rows(frame: DataFrame, section: str, name: Column, measures: Sequence[str]) -> DataFrame:
        entries = [
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in measures
        ]
        return frame.select(
            F.lit(section).alias("section"), name.alias("name"), F.inline(F.array(*entries))
        )

    median = exact_quantiles(recent, ["prediction"], [0.5])["prediction", 0.5]
    one_row = recent.agg(
        F.count(known("prediction")).alias("count"),
        F.round(F.avg(known("prediction")), 4).alias("mean"),
        F.round(F.stddev_pop(known("prediction")), 4).alias("std"),
        F.round(F.min(known("prediction")), 4).alias("min"),
        F.round(F.max(known("prediction")), 4).alias("max"),
        _rounded(median).alias("median"),
        F.round(F.avg(known("confidence.std")), 4).alias("mean_std"),
        F.round(F.max(known("confidence.std")), 4).alias("max_std"),
        F.count(known("error")).alias("with_actual"),
        F.round(F.avg(known("error")), 4).alias("mean_error"),
        F.round(F.max(known("error")), 4).alias("max_error"),
    )
    sections = [
        ("prediction", ["count", "mean", "std", "min", "max", "median"]),
        ("confidence", ["mean_std", "max_std"]),
        ("error", ["with_actual", "mean_error", "max_error"]),
    ]
    entries = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit("").alias("name"),
            F.lit(m).alias("measure"),
            F.col(m).cast("double").alias("value"),
        )
        for section, measures in sections
        for m in measures
    ]
    totals = one_row.select(F.inline(F.array(*entries)))
    inputs = rows(feature_stats(recent), "feature", F.col("feature"), ["mean", "std", "min", "max"])
    return totals.unionByName(inputs).filter("value IS NOT NULL")


def request_totals(requests: DataFrame) -> DataFrame:
    """Requests, errors (status 400 and above) and error rate (4 decimals)."""
    total, errors = F.count(F.lit(1)), F.count_if(F.col("status") >= 400)
    return requests.agg(
        total.alias("total_requests"),
        errors.alias("total_errors"),
        F.round(errors / F.greatest(total, F.lit(1)), 4).alias("error_rate"),
    )


def latency_stats(
    requests: DataFrame,
    path: str = "/predict",
    last: int = LATENCY_WINDOW,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Latency of the ``last`` requests to ``path``; percentiles by position."""
    newest = (
        requests.filter(F.col("path") == path)
        .orderBy(F.col("ts").desc(), *[F.col(c).desc() for c in ties])
        .limit(last)
    )
    # The array holds at most ``last`` values.
    return (
        newest.agg(
            F.count("duration_ms").alias("count"),
            F.round(F.avg("duration_ms"), 2).alias("avg_ms"),
            F.sort_array(F.collect_list("duration_ms")).alias("_sorted"),
            F.round(F.max("duration_ms"), 2).alias("max_ms"),
        )
        .filter("count > 0")
        .select(
            "count",
            "avg_ms",
            F.round(position_percentile(F.col("_sorted"), 0.5), 2).alias("p50_ms"),
            F.round(position_percentile(F.col("_sorted"), 0.95), 2).alias("p95_ms"),
            F.round(position_percentile(F.col("_sorted"), 0.99), 2).alias("p99_ms"),
            "max_ms",
        )
    )


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """Exact count of each distinct value but NULL and NaN, in value order."""
    counts = df.filter(clean(df, column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def feature_summary(log: DataFrame, feature: str, last: int = 500, ties: Sequence[str] = ()) -> DataFrame:
    """Mean, population std, min and max of one input feature in the last entries."""
    value = F.try_element_at("input_features", F.lit(feature))
    newest = last_rows(log, last, ties).select(value.alias("value"))
    newest = newest.filter("value IS NOT NULL AND NOT isnan(value)")
    return newest.agg(
        F.count("value").alias("count"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev_pop("value"), 4).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def feature_values(log: DataFrame, feature: str, last: int = 500, ties: Sequence[str] = ()) -> DataFrame:
    """Histogram of one input feature over the last entries: count of each value."""
    value = F.try_element_at("input_features", F.lit(feature))
    return value_histogram(last_rows(log, last, ties).select(value.alias("value")), "value")


def last_summary(log: DataFrame, last: int = 100, ties: Sequence[str] = ()) -> DataFrame:
    """Total, mean, min and max (2 decimals) of the last predictions."""
    value = known("prediction")
    return last_rows(log, last, ties).agg(
        F.count(value).alias("total"),
        F.round(F.avg(value), 2).alias("mean"),
        F.round(F.min(value), 2).alias("min"),
        F.round(F.max(value), 2).alias("max"),
    )


def prediction_timeline(log: DataFrame, last: int = 100, ties: Sequence[str] = ()) -> DataFrame:
    """Timestamp and prediction of the last entries."""
    return last_rows(log, last, ties).select("timestamp", "prediction")


def recent_predictions(log: DataFrame, last: int = 20, ties: Sequence[str] = ()) -> DataFrame:
    """The newest predictions with their model version and spread."""
    return last_rows(log, last, ties).select(
        "timestamp",
        F.round("prediction", 2).alias("prediction"),
        F.concat(F.lit("v"), F.coalesce(F.col("model_version").cast("string"), F.lit("?"))).alias(
            "model"
        ),
        F.coalesce(F.col("confidence.std").cast("string"), F.lit("N/A")).alias("confidence_std"),
    )
