"""Prediction-log and request-log queries; the events serve as both logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.operators import monitor
from tidewatch.plans.staging import fresh_path
from tidewatch.sources import logs
from tidewatch.workload.tables import table

AS_OF = datetime(2024, 1, 31)


def prediction_log(spark, sf_dir):
    """Each event as a prediction; only purchases and signups learn their outcome."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return monitor.log_entries(
        events,
        timestamp=F.col("ts"),
        model_version=F.when(F.col("event_type") == "view", 2).otherwise(1),
        prediction=F.col("value") / 3,
        input_features=F.create_map(
            F.lit("k"), k, F.lit("hour"), F.hour("ts").cast("double"), F.lit("value"), F.col("value")
        ),
        confidence=F.when(
            F.col("event_type") != "error",
            F.struct(
                F.round(F.col("value") / 10, 4).alias("std"),
                F.round(F.col("value") / 4, 2).alias("min"),
                F.round(F.col("value") / 2, 2).alias("max"),
            ),
        ),
        actual=F.when(F.col("event_type").isin("purchase", "signup"), k),
    )


def requests(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type").isin("click", "view", "purchase"), "/predict")
        .otherwise("/health")
        .alias("path"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.col("value").alias("duration_ms"),
    )


def mon_log(spark, sf_dir):
    """Written by day and read back."""
    path = fresh_path(spark, "prediction_log")
    logs.append_log(prediction_log(spark, sf_dir), path)
    log = logs.read_log(spark, path)
    return log.select(
        "timestamp", "model_version", "prediction", F.col("input_features.k").alias("k"),
        F.col("confidence.std").alias("confidence_std"), "actual", "error",
    )


def mon_report(spark, sf_dir):
    return monitor.monitoring_report(prediction_log(spark, sf_dir), days=1, as_of=AS_OF)


def mon_period_fallback(spark, sf_dir):
    """A period without entries falls back to the whole log."""
    log = prediction_log(spark, sf_dir)
    return monitor.prediction_stats(monitor.in_period(log, 1, datetime(2025, 1, 1)))


def mon_features(spark, sf_dir):
    return monitor.feature_stats(prediction_log(spark, sf_dir))


def mon_confidence(spark, sf_dir):
    return monitor.confidence_stats(prediction_log(spark, sf_dir))


def mon_errors(spark, sf_dir):
    return monitor.error_stats(prediction_log(spark, sf_dir))


def mon_requests(spark, sf_dir):
    return monitor.request_totals(requests(spark, sf_dir))


def mon_latency(spark, sf_dir):
    return monitor.latency_stats(requests(spark, sf_dir), ties=["event_id"])


def mon_hist(spark, sf_dir):
    return monitor.value_histogram(table(spark, sf_dir, "events"), "value")


def mon_nan(spark, sf_dir):
    """NaN predictions, spreads and errors count as missing."""
    log, hour = prediction_log(spark, sf_dir), F.hour("timestamp")
    nan = F.lit(float("nan"))
    spread = F.when(hour == 6, nan).otherwise(F.col("confidence.std"))
    broken = log.withColumns(
        {
            "prediction": F.when(hour == 5, nan).otherwise(F.col("prediction")),
            "error": F.when(hour == 7, nan).otherwise(F.col("error")),
            "confidence": F.when(F.col("confidence").isNotNull(), F.col("confidence").withField("std", spread)),
        }
    )
    return monitor.monitoring_report(broken, days=1, as_of=AS_OF)


def mon_feature_hist(spark, sf_dir):
    return monitor.feature_values(prediction_log(spark, sf_dir), "k")


def mon_last_summary(spark, sf_dir):
    return monitor.last_summary(prediction_log(spark, sf_dir))


def mon_summary(spark, sf_dir):
    return monitor.feature_summary(prediction_log(spark, sf_dir), "k")


def mon_recent(spark, sf_dir):
    return monitor.recent_predictions(prediction_log(spark, sf_dir))


def mon_timeline(spark, sf_dir):
    return monitor.prediction_timeline(prediction_log(spark, sf_dir))


LOG_SQL = """
log AS (
  SELECT ts AS "timestamp", CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS model_version,
         value / 3 AS raw, round(value / 3, 4) AS prediction,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, hour(ts)::DOUBLE AS hour, value,
         CASE WHEN event_type <> 'error' THEN round(value / 10, 4) END AS confidence_std,
         CASE WHEN event_type IN ('purchase', 'signup')
              THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS actual,
         round(abs(CASE WHEN event_type IN ('purchase', 'signup')
              THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END - value / 3), 4) AS error
  FROM events)
"""
_REQUESTS_SQL = """
req AS (
  SELECT event_id, ts,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN '/predict' ELSE '/health' END AS path,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS duration_ms
  FROM events)
"""
_STATS = """count(prediction) AS "count", round(avg(prediction), 4) AS mean,
  round(stddev_pop(prediction), 4) AS std, round(min(prediction), 4) AS min,
  round(max(prediction), 4) AS max, round(CAST(median(prediction) AS DECIMAL(38, 12)), 4)::DOUBLE AS median"""


def _features_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, "
        f"round(min({c}), 2) AS min, round(max({c}), 2) AS max FROM {source}"
        for c in ("k", "hour", "value")
    )


_NAN_SQL = """broken AS (
  SELECT "timestamp", k, hour, value, CASE WHEN hour("timestamp") <> 5 THEN prediction END AS prediction,
         CASE WHEN hour("timestamp") <> 6 THEN confidence_std END AS confidence_std,
         CASE WHEN hour("timestamp") <> 7 THEN error END AS error
  FROM log)"""


def _report_sql(source: str = "log", before: str = "") -> str:
    one = [
        ("prediction", m, v)
        for m, v in (
            ("count", "count(prediction)"), ("mean", "round(avg(prediction), 4)"),
            ("std", "round(stddev_pop(prediction), 4)"), ("min", "round(min(prediction), 4)"),
            ("max", "round(max(prediction), 4)"), ("median", "round(CAST(median(prediction) AS DECIMAL(38, 12)), 4)::DOUBLE"),
        )
    ] + [
        ("confidence", "mean_std", "round(avg(confidence_std), 4)"),
        ("confidence", "max_std", "round(max(confidence_std), 4)"),
        ("error", "with_actual", "count(error)"),
        ("error", "mean_error", "round(avg(error), 4)"),
        ("error", "max_error", "round(max(error), 4)"),
    ]
    parts = [
        f"SELECT '{s}' AS section, '' AS name, '{m}' AS measure, ({v})::DOUBLE AS value FROM recent"
        for s, m, v in one
    ]
    parts += [f"SELECT 'feature', feature, '{m}', {m} FROM feats" for m in ("mean", "std", "min", "max")]
    return (
        f"WITH {LOG_SQL}, {before} recent AS (SELECT * FROM {source} WHERE \"timestamp\" > TIMESTAMP '2024-01-30'),\n"
        f"feats AS ({_features_sql('recent')})\n" + "\nUNION ALL\n".join(parts)
    )


QUERIES = {
    "mon_log": mon_log,
    "mon_report": mon_report,
    "mon_period_fallback": mon_period_fallback,
    "mon_features": mon_features,
    "mon_confidence": mon_confidence,
    "mon_errors": mon_errors,
    "mon_requests": mon_requests,
    "mon_latency": mon_latency,
    "mon_hist": mon_hist,
    "mon_nan": mon_nan,
    "mon_feature_hist": mon_feature_hist,
    "mon_last_summary": mon_last_summary,
    "mon_summary": mon_summary,
    "mon_recent": mon_recent,
    "mon_timeline": mon_timeline,
}

ORACLE = {
    "mon_log": f"WITH {LOG_SQL} SELECT \"timestamp\", model_version, prediction, k, confidence_std, actual, error FROM log",
    "mon_report": _report_sql(),
    "mon_nan": _report_sql("broken", _NAN_SQL + ","),
    "mon_feature_hist": f"""WITH {LOG_SQL},
newest AS (SELECT k FROM log ORDER BY "timestamp" DESC LIMIT 500)
SELECT k AS value, count(*) AS "count" FROM newest WHERE k IS NOT NULL GROUP BY k""",
    "mon_last_summary": f"""WITH {LOG_SQL},
newest AS (SELECT prediction FROM log ORDER BY "timestamp" DESC LIMIT 100)
SELECT count(prediction) AS total, round(avg(prediction), 2) AS mean, round(min(prediction), 2) AS min,
       round(max(prediction), 2) AS max FROM newest""",
    "mon_period_fallback": f"WITH {LOG_SQL} SELECT {_STATS} FROM log",
    "mon_features": f"WITH {LOG_SQL} {_features_sql('log')}",
    "mon_confidence": f"""WITH {LOG_SQL}
SELECT round(avg(confidence_std), 4) AS mean_std, round(max(confidence_std), 4) AS max_std FROM log""",
    "mon_errors": f"""WITH {LOG_SQL}
SELECT count(error) AS "count", round(avg(error), 4) AS mean_error, round(max(error), 4) AS max_error FROM log""",
    "mon_requests": f"""WITH {_REQUESTS_SQL}
SELECT count(*) AS total_requests, count(*) FILTER (status >= 400) AS total_errors,
       round(count(*) FILTER (status >= 400) / greatest(count(*), 1), 4) AS error_rate FROM req""",
    "mon_latency": f"""WITH {_REQUESTS_SQL},
newest AS (SELECT duration_ms FROM req WHERE path = '/predict' ORDER BY ts DESC, event_id DESC LIMIT 1000),
a AS (SELECT list_sort(list(duration_ms)) AS v, count(*) AS n, avg(duration_ms) AS m, max(duration_ms) AS top FROM newest)
SELECT n AS "count", round(m, 2) AS avg_ms, round(v[floor(n * 0.5::DOUBLE)::BIGINT + 1], 2) AS p50_ms,
       round(v[floor(n * 0.95::DOUBLE)::BIGINT + 1], 2) AS p95_ms,
       round(v[floor(n * 0.99::DOUBLE)::BIGINT + 1], 2) AS p99_ms, round(top, 2) AS max_ms
FROM a""",
    "mon_hist": "SELECT value, count(*) AS \"count\" FROM events GROUP BY value",
    "mon_summary": f"""WITH {LOG_SQL},
newest AS (SELECT k FROM log ORDER BY "timestamp" DESC LIMIT 500)
SELECT count(k) AS "count", round(avg(k), 4) AS mean, round(stddev_pop(k), 4) AS std, min(k) AS min, max(k) AS max FROM newest""",
    "mon_recent": f"""WITH {LOG_SQL}
SELECT "timestamp", round(prediction, 2) AS prediction, 'v' || model_version AS model,
       coalesce(confidence_std::VARCHAR, 'N/A') AS confidence_std
FROM log ORDER BY "timestamp" DESC LIMIT 20""",
    "mon_timeline": f"""WITH {LOG_SQL}
SELECT "timestamp", prediction FROM log ORDER BY "timestamp" DESC LIMIT 100""",
}
