"""Drift queries: the first half of a table against the second."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import ks_test_p_value
from tidewatch.operators import drift
from tidewatch.operators.monitor import log_entries
from tidewatch.plans.ordering import over_series
from tidewatch.plans.staging import fresh_path
from tidewatch.workload.tables import (
    HALF,
    HALF_SQL,
    MEASURED_SQL,
    SHIP_HALF,
    SHIP_HALF_SQL,
    at,
    measured,
    table,
)

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _halves(spark, sf_dir):
    rows = measured(spark, sf_dir)
    return rows.filter(F.col("ts") < at(HALF)), rows.filter(F.col("ts") >= at(HALF))


def dr_baseline(spark, sf_dir):
    path = fresh_path(spark, "baseline")
    first, _ = _halves(spark, sf_dir)
    drift.Baseline.of(first, ["value", "k"]).save(path)
    saved = drift.Baseline.load(spark, path)
    sample = saved.values.groupBy("feature").agg(
        F.sum("n").alias("sample_rows"), F.count(F.lit(1)).alias("sample_values")
    )
    return saved.stats.join(sample, "feature").select(
        "feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        "min", "max", "count", "sample_rows", "sample_values",
    )


def dr_ks(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_FEATURES, "l_shipdate")
    one = F.lit(1).cast("long")
    first = drift.long_values(lines.filter(F.col("l_shipdate") < at(SHIP_HALF)), LINE_FEATURES)
    rest = drift.long_values(lines.filter(F.col("l_shipdate") >= at(SHIP_HALF)), LINE_FEATURES)
    found = drift.ks_statistics(first.withColumn("n", one), rest.withColumn("n", one))
    return found.select("feature", F.round("d", 6).alias("d"), "n_base", "n_cur")


def _tidy(report):
    return report.select(
        "feature", "ks_statistic", "p_value", "drift_detected",
        F.round("baseline_mean", 4).alias("baseline_mean"), "current_mean",
        F.round("baseline_std", 4).alias("baseline_std"), "current_std", "alert",
    )


def dr_report(spark, sf_dir):
    """Values of the second half, with those of one event type raised so that they drift."""
    first, rest = _halves(spark, sf_dir)
    shifted = rest.withColumn("k", F.when(F.col("event_type") == "click", F.col("k") + 50).otherwise(F.col("k")))
    baseline = drift.Baseline.of(first, ["value", "k"])
    return _tidy(drift.drift_report(baseline, shifted, ["value", "k", "absent"]))


def dr_exact(spark, sf_dir):
    """Views against clicks of every day: small samples, whose p-values are counted."""
    events = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd").alias("feature")
    rows = events.select(day, "value", F.lit(1).cast("long").alias("n"), "event_type")
    found = drift.ks_statistics(rows.filter("event_type = 'view'"), rows.filter("event_type = 'click'"))
    p = ks_test_p_value(F.col("d"), F.col("n_base"), F.col("n_cur"))
    return found.select("feature", F.round("d", 6).alias("d"), "n_base", "n_cur", F.round(p, 6).alias("p_value"))


def dr_concept(spark, sf_dir):
    """Predictions: mean of the user's last six values."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    guessed = over_series(
        events,
        ["user_id"],
        ["ts", "event_id"],
        5,
        lambda w: [F.round(F.avg("value").over(w.rowsBetween(-5, 0)), 6).alias("prediction")],
    )
    return drift.concept_drift(
        guessed.filter(F.col("ts") < at(HALF)), guessed.filter(F.col("ts") >= at(HALF))
    )


def dr_from_log(spark, sf_dir):
    first, rest = _halves(spark, sf_dir)
    log = log_entries(
        rest, F.col("ts"), F.lit(1), F.col("value"), F.create_map(F.lit("k"), F.col("k"))
    )
    return drift.drift_from_log(drift.Baseline.of(first, ["k"]), log, ["k", "absent"]).select(
        "status", "feature", "ks_statistic", "p_value", "drift_detected", "current_mean", "current_std"
    )


def dr_history(spark, sf_dir):
    """A report per day that flags event types whose mean value left 45..55."""
    rows = table(spark, sf_dir, "events").groupBy(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("report_ts"), "event_type"
    )
    reports = rows.agg((~F.avg("value").between(45, 55)).alias("drift_detected"))
    return drift.drift_history(reports)


def ks_sql(feature_values: str) -> str:
    """Distance and p-value from a CTE ``x(feature, value, cur)``."""
    return f"""
x AS ({feature_values}),
c AS (SELECT feature, value, count(*) FILTER (NOT cur) AS nb, count(*) FILTER (cur) AS nc
      FROM x WHERE value IS NOT NULL GROUP BY feature, value),
r AS (SELECT feature, sum(nb) OVER w AS cb, sum(nc) OVER w AS cc,
             sum(nb) OVER (PARTITION BY feature) AS n_base, sum(nc) OVER (PARTITION BY feature) AS n_cur
      FROM c WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
d AS (SELECT feature, max(abs(cb / n_base - cc / n_cur)) AS d,
             CAST(any_value(n_base) AS BIGINT) AS n_base, CAST(any_value(n_cur) AS BIGINT) AS n_cur
      FROM r GROUP BY feature),
e AS (SELECT *, sqrt(n_base::DOUBLE * n_cur / (n_base::DOUBLE + n_cur)) AS en FROM d),
l AS (SELECT *, (en + 0.12 + 0.11 / en) * d AS lam FROM e),
t AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
        2 * list_sum(list_transform(range(1, 101),
          lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))))) END::DOUBLE AS p
      FROM l),
s AS (SELECT feature, avg(value) FILTER (NOT cur) AS bm, avg(value) FILTER (cur) AS cm,
             stddev_pop(value) FILTER (NOT cur) AS bs, stddev_pop(value) FILTER (cur) AS cs
      FROM x GROUP BY feature)"""


_DAILY = """
SELECT strftime(ts, '%Y-%m-%d') AS feature, value, event_type = 'click' AS cur
FROM events WHERE event_type IN ('view', 'click')"""

_SHIFTED = f"""
SELECT 'value' AS feature, value, ts >= {HALF_SQL} AS cur FROM measured
UNION ALL
SELECT 'k', CASE WHEN ts >= {HALF_SQL} AND event_type = 'click' THEN k + 50 ELSE k END, ts >= {HALF_SQL}
FROM measured"""

QUERIES = {
    "dr_baseline": dr_baseline,
    "dr_ks": dr_ks,
    "dr_report": dr_report,
    "dr_concept": dr_concept,
    "dr_exact": dr_exact,
    "dr_from_log": dr_from_log,
    "dr_history": dr_history,
}

ORACLE = {
    # Chances of the pooled orders that stay nearer, one value of the pool at a time.
    "dr_exact": f"""
WITH RECURSIVE {ks_sql(_DAILY)},
g AS (SELECT *, CAST(round(d * n_base * n_cur) AS BIGINT) AS k FROM d WHERE d IS NOT NULL AND n_base > 0 AND n_cur > 0),
walk AS (
  SELECT feature, n_base AS n, n_cur AS m, k, 0::BIGINT AS step, 0::BIGINT AS i, 1.0::DOUBLE AS p FROM g WHERE k > 0
  UNION ALL
  SELECT feature, n, m, k, step + 1, i + u, sum(p * CASE u WHEN 1 THEN n - i ELSE m - (step - i) END / (n + m - step))
  FROM walk CROSS JOIN (VALUES (0), (1)) v(u)
  WHERE step < n + m AND abs((i + u) * m - (step + 1 - i - u) * n) < k AND CASE u WHEN 1 THEN i < n ELSE step - i < m END
  GROUP BY feature, n, m, k, step, i + u)
SELECT feature, round(d, 6) AS d, n_base, n_cur, round(1 - coalesce(p, 0), 6) AS p_value
FROM g LEFT JOIN (SELECT feature, p FROM walk WHERE step = n + m) USING (feature)""",
    "dr_baseline": f"""
WITH {MEASURED_SQL},
x AS (SELECT 'value' AS feature, value AS v FROM measured WHERE ts < {HALF_SQL}
      UNION ALL SELECT 'k', k FROM measured WHERE ts < {HALF_SQL} AND k IS NOT NULL)
SELECT feature, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, min(v) AS min, max(v) AS max,
       count(v) AS "count", count(v) AS sample_rows, count(DISTINCT v) AS sample_values
FROM x GROUP BY feature
""",
    "dr_ks": "WITH "
    + ks_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS value, l_shipdate >= {SHIP_HALF_SQL} AS cur FROM lineitem"
            for c in LINE_FEATURES
        )
    )
    + " SELECT feature, round(d, 6) AS d, n_base, n_cur FROM t",
    "dr_report": f"WITH {MEASURED_SQL}, "
    + ks_sql(_SHIFTED)
    + """
SELECT feature, round(d, 6) AS ks_statistic, round(p, 6) AS p_value, p < 0.05 AS drift_detected,
       round(bm, 4) AS baseline_mean, round(cm, 4) AS current_mean,
       round(bs, 4) AS baseline_std, round(cs, 4) AS current_std,
       CASE WHEN p < 0.05 THEN printf(
         'DRIFT ALERT: ''%s'' — KS=%.4f, p=%.6f (baseline μ=%.2f, current μ=%.2f)', feature, d, p, bm, cm) END AS alert
FROM t JOIN s USING (feature)""",
    "dr_concept": f"""
WITH g AS (SELECT ts, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS prediction FROM events), """
    + ks_sql(f"SELECT 'prediction' AS feature, prediction AS value, ts >= {HALF_SQL} AS cur FROM g")
    + """
SELECT p < 0.05 AS concept_drift_detected, round(d, 6) AS ks_statistic, round(p, 6) AS p_value,
       round(bm, 4) AS baseline_mean, round(cm, 4) AS current_mean,
       round(bs, 4) AS baseline_std, round(cs, 4) AS current_std
FROM t JOIN s USING (feature)""",
    "dr_from_log": f"WITH {MEASURED_SQL}, "
    + ks_sql(f"SELECT 'k' AS feature, k AS value, ts >= {HALF_SQL} AS cur FROM measured")
    + """
SELECT 'checked' AS status, feature, round(d, 6) AS ks_statistic, round(p, 6) AS p_value,
       p < 0.05 AS drift_detected, round(cm, 4) AS current_mean, round(cs, 4) AS current_std
FROM t JOIN s USING (feature)""",
    "dr_history": """
WITH r AS (SELECT date_trunc('day', ts)::TIMESTAMP AS report_ts, event_type,
                  NOT (avg(value) BETWEEN 45 AND 55) AS drift_detected
           FROM events GROUP BY 1, 2)
SELECT report_ts, bool_or(drift_detected) AS drift_detected,
       count(*) FILTER (drift_detected) AS alerts
FROM r GROUP BY report_ts
""",
}
