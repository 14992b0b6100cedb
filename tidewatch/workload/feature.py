"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.operators.features import (
    FeatureModel,
    FeatureSpec,
    add_features,
    fit_medians,
    impute,
)
from tidewatch.plans.staging import fresh_path
from tidewatch.workload.tables import MEASURED_SQL, measured, table

SERIES = FeatureSpec(target="value", order_by=("ts", "event_id"), keys=("event_type",))
ONE_SERIES = FeatureSpec(target="value", order_by=("ts", "event_id"), hour_of_day=False)
WITH_INPUT = FeatureSpec(
    target="value", order_by=("ts", "event_id"), keys=("event_type",), numeric=("k",)
)


def _rounded(df, columns, digits=6):
    return [F.round(c, digits).alias(c) for c in columns]


LARGE_MEAN = 1.7e9


def fe_features(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    out = add_features(events, SERIES)
    return out.select("event_id", "event_type", *_rounded(out, SERIES.feature_columns))


SHORT = FeatureSpec(target="value", order_by=("ts", "event_id"), keys=("event_type",), lags=(1, 2), windows=(3,))


def fe_hot_keys_cut(spark, sf_dir):
    """Every key is hot and its history short, so all are cut by time."""
    events = table(spark, sf_dir, "events")
    out = add_features(events, SHORT, hot_rows=100, block_rows=200)
    return out.select("event_id", "event_type", *_rounded(out, SHORT.feature_columns))


def fe_global_blocked(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    out = add_features(events, ONE_SERIES, block_rows=4096)
    return out.select("event_id", *_rounded(out, ONE_SERIES.feature_columns))


def fe_hot_keys(spark, sf_dir):
    """Same as fe_features, with the busiest keys cut into blocks."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    hot = int(events.count() / 5)
    out = add_features(events, SERIES, hot_rows=hot, block_rows=1024)
    return out.select("event_id", "event_type", *_rounded(out, SERIES.feature_columns))


def fe_impute(spark, sf_dir):
    rows = measured(spark, sf_dir).select("event_id", "k")
    filled = impute(rows, fit_medians(rows, ["k"]))
    return filled.select("event_id", "k")


def fe_scaled(spark, sf_dir):
    model = FeatureModel(WITH_INPUT)
    out = model.fit_transform(measured(spark, sf_dir))
    return out.select("event_id", "value", *_rounded(out, model.feature_columns, 5))


def fe_scaled_large_mean(spark, sf_dir):
    """A small spread around a large mean is still scaled."""
    out = FeatureModel(WITH_INPUT).fit_transform(
        measured(spark, sf_dir).withColumn("k", F.col("k") + F.lit(LARGE_MEAN))
    )
    return out.select("event_id", *_rounded(out, ["k"], 3))


def fe_state(spark, sf_dir):
    path = fresh_path(spark, "state")
    FeatureModel(WITH_INPUT).fit(measured(spark, sf_dir)).save(spark, path)
    state = FeatureModel.load(spark, path).state(spark)
    return state.select(
        "column", "ordinal", "median", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std")
    )


def _window_sql(keys: str) -> str:
    over = f"({keys} ORDER BY ts, event_id"
    parts = [f"lag(value, {n}) OVER {over}) AS value_lag_{n}" for n in presets.LAGS]
    for n in presets.ROLLING_WINDOWS:
        frame = f"{over} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"avg(value) OVER {frame} AS value_roll_mean_{n}")
        parts.append(f"coalesce(stddev_samp(value) OVER {frame}, 0.0) AS value_roll_std_{n}")
    return ",\n  ".join(parts)


_HOUR_SQL = "sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos"


def _round_sql(columns, digits=6) -> str:
    # Adding the case keeps a negative zero from showing.
    return ",\n  ".join(
        f"CASE WHEN round({c}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({c}, {digits}) END AS {c}"
        for c in columns
    )


_KEYED_SQL = f"""
WITH f AS (SELECT event_id, event_type, {_window_sql('PARTITION BY event_type')}, {_HOUR_SQL} FROM events)
SELECT event_id, event_type, {_round_sql(SERIES.feature_columns)} FROM f
"""

COMPLETE_SQL = f"""
{MEASURED_SQL.strip()},
filled AS (
  SELECT event_id, ts, event_type, value,
         coalesce(k, (SELECT median(k) FROM measured)) AS k FROM measured),
built AS (
  SELECT event_id, value, k, {_window_sql('PARTITION BY event_type')}, {_HOUR_SQL} FROM filled),
complete AS (SELECT * FROM built WHERE value_lag_24 IS NOT NULL)
"""


def _scaled_sql() -> str:
    stats, scaled = [], []
    for c in WITH_INPUT.feature_columns:
        stats.append(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}")
        x = f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 5)"
        scaled.append(f"CASE WHEN {x} = 0 THEN 0.0::DOUBLE ELSE {x} END AS {c}")
    return f"""
WITH {COMPLETE_SQL},
stats AS (SELECT {', '.join(stats)} FROM complete)
SELECT event_id, value, {', '.join(scaled)} FROM complete CROSS JOIN stats
"""


def _state_sql() -> str:
    rows = [
        "SELECT 'value' AS \"column\", CAST(NULL AS INTEGER) AS ordinal, "
        "(SELECT median(value) FROM measured) AS median, "
        "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std"
    ]
    for i, c in enumerate(WITH_INPUT.feature_columns):
        median = "(SELECT median(k) FROM measured)" if c == "k" else "CAST(NULL AS DOUBLE)"
        mean = f"CASE WHEN round(avg({c}), 5) = 0 THEN 0.0::DOUBLE ELSE round(avg({c}), 5) END"
        rows.append(f"SELECT '{c}', {i}, {median}, {mean}, round(stddev_pop({c}), 5) FROM complete")
    return f"WITH {COMPLETE_SQL}\n" + "\nUNION ALL\n".join(rows)


QUERIES = {
    "fe_features": fe_features,
    "fe_hot_keys": fe_hot_keys,
    "fe_hot_keys_cut": fe_hot_keys_cut,
    "fe_global_blocked": fe_global_blocked,
    "fe_impute": fe_impute,
    "fe_scaled": fe_scaled,
    "fe_scaled_large_mean": fe_scaled_large_mean,
    "fe_state": fe_state,
}

ORACLE = {
    "fe_features": _KEYED_SQL,
    "fe_hot_keys": _KEYED_SQL,
    "fe_hot_keys_cut": f"""
WITH f AS (
  SELECT event_id, event_type, {_HOUR_SQL},
         lag(value, 1) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2,
         avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value_roll_mean_3,
         coalesce(stddev_samp(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0.0) AS value_roll_std_3
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
SELECT event_id, event_type, {_round_sql(SHORT.feature_columns)} FROM f
""",
    "fe_global_blocked": f"""
WITH f AS (SELECT event_id, {_window_sql('')} FROM events)
SELECT event_id, {_round_sql(ONE_SERIES.feature_columns)} FROM f
""",
    "fe_impute": f"""
WITH {MEASURED_SQL}
SELECT event_id, coalesce(k, (SELECT median(k) FROM measured)) AS k FROM measured
""",
    "fe_scaled": _scaled_sql(),
    "fe_scaled_large_mean": f"""
WITH {COMPLETE_SQL},
stats AS (SELECT avg(k) AS m, stddev_pop(k) AS s FROM complete)
SELECT event_id, CASE WHEN round((k - m) / s, 3) = 0 THEN 0.0::DOUBLE ELSE round((k - m) / s, 3) END AS k
FROM complete CROSS JOIN stats
""",
    "fe_state": _state_sql(),
}
