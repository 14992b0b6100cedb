"""Validation and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.operators import profile, validate
from tidewatch.operators.profile_state import ProfileState
from tidewatch.plans.staging import fresh_path
from tidewatch.workload.tables import table

# Absent discount or tax is stored as 0; the checks read it as missing.
_LINES = "SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem"
LINE_COLUMNS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]
LINE_NUMERIC = [c for c, t in LINE_COLUMNS if t in ("bigint", "int", "double")]
RANGES = {
    "l_quantity": (1.0, 50.0),
    "l_extendedprice": (0.0, 50000.0),
    "l_discount": (0.0, 0.05),
    "l_returnflag": (0.0, 1.0),
    "l_weight": (0.0, 1.0),
}
REQUIRED = ["l_orderkey", "l_quantity", "l_shipmode", "l_comment"]


def lines(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return df.withColumn("l_discount", F.nullif("l_discount", F.lit(0.0))).withColumn(
        "l_tax", F.nullif("l_tax", F.lit(0.0))
    )


def val_nulls(spark, sf_dir):
    return validate.null_report(lines(spark, sf_dir))


def val_findings(spark, sf_dir):
    return validate.findings(lines(spark, sf_dir), REQUIRED, 0.1, RANGES)


def val_empty(spark, sf_dir):
    """A table without rows has the one finding that says so."""
    return validate.findings(lines(spark, sf_dir).filter("l_quantity < 0"), REQUIRED, 0.1, RANGES)


def val_empty_nulls(spark, sf_dir):
    return validate.null_report(lines(spark, sf_dir).filter("l_quantity < 0"))


def val_all_null(spark, sf_dir):
    """Discounts of a table that has only undiscounted lines are all missing."""
    none = lines(spark, sf_dir).filter("l_discount IS NULL").select("l_orderkey", "l_discount")
    return validate.findings(none, ["l_orderkey"], 1.0)


def val_verdict(spark, sf_dir):
    return validate.verdict(lines(spark, sf_dir), REQUIRED, 0.1, RANGES)


def val_request_split(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("double")
    v = F.col("value")
    requests = table(spark, sf_dir, "events").select(
        "event_id",
        (v - 20).alias("temperature_2m"),
        v.alias("relative_humidity_2m"),
        (v / 2).alias("dew_point_2m"),
        v.alias("apparent_temperature"),
        (870 + k * 2.5).alias("pressure_msl"),
        F.when(F.col("event_type") != "signup", v).alias("surface_pressure"),
        (v - 5).alias("precipitation"),
        v.alias("rain"),
        F.lit(0.0).alias("snowfall"),
        k.alias("cloud_cover"),
        v.alias("wind_speed_10m"),
        (k * 4).alias("wind_direction_10m"),
        v.alias("wind_gusts_10m"),
        F.when(F.col("event_type") != "view", F.hour("ts")).alias("hour"),
    )
    checked = validate.check_rows(requests)
    return checked.select(
        "event_id", "hour", "accepted", F.array_join("reasons", "; ").alias("reasons")
    )


def prof_shape(spark, sf_dir):
    return profile.shape(table(spark, sf_dir, "lineitem"))


def prof_missing(spark, sf_dir):
    return profile.missing(lines(spark, sf_dir))


def prof_numeric(spark, sf_dir):
    return profile.numeric_stats(lines(spark, sf_dir))


def prof_outliers(spark, sf_dir):
    return profile.outliers(lines(spark, sf_dir))


def prof_outliers_events(spark, sf_dir):
    return profile.outliers(table(spark, sf_dir, "events"), ["value"])


def prof_corr(spark, sf_dir):
    return profile.correlation_matrix(lines(spark, sf_dir))


def prof_corr_top(spark, sf_dir):
    pairs = profile.correlations(lines(spark, sf_dir))
    return profile.top_pairs(pairs, 10).select("column_a", "column_b", "correlation")


def prof_temporal(spark, sf_dir):
    """Events, orders, and the regular series of the days that have orders."""
    events = profile.temporal(table(spark, sf_dir, "events"), "ts", 900)
    orders = table(spark, sf_dir, "orders")
    days = orders.select("o_orderdate").distinct()
    return (
        events.select(F.lit("events").alias("series"), "*")
        .unionByName(profile.temporal(orders, "o_orderdate").select(F.lit("orders").alias("series"), "*"))
        .unionByName(profile.temporal(days, "o_orderdate").select(F.lit("days").alias("series"), "*"))
    )


def val_preset(spark, sf_dir):
    """Line items as hourly weather, checked by the rules of the weather preset."""
    weather = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") * 2 - 30).alias("temperature_2m"),
        (F.col("l_discount") * 1000).alias("relative_humidity_2m"),
        F.when(F.col("l_linenumber") < 4, 870 + F.col("l_tax") * 100).alias("pressure_msl"),
        (F.col("l_extendedprice") / 100).alias("precipitation"),
    )
    return validate.findings(weather, presets.WEATHER_REQUIRED, presets.MAX_NULL_FRACTION, presets.WEATHER_RANGES)


def prof_incremental(spark, sf_dir):
    """Ten versions of the line items, each read once; what their merged states say of all."""
    state = ProfileState(spark, fresh_path(spark, "profile"))
    for v in range(10):
        state.add(lines(spark, sf_dir).filter(F.col("l_orderkey") % 10 == v), f"v{v}")
    missing = state.missing().select("column", F.col("missing").alias("nulls"), "percent")
    return state.numeric_stats().drop("p25", "p50", "p75").join(missing, "column")


def prof_calendar(spark, sf_dir):
    """Days of shipping cut to months, quarters, years, weeks and working days."""
    day = F.col("l_shipdate")
    lines_ = table(spark, sf_dir, "lineitem").select(day)
    cuts = {
        "months": F.date_trunc("month", day),
        "month ends": F.last_day(day),
        "quarters": F.date_trunc("quarter", day),
        "years": F.date_trunc("year", day),
        "weeks": F.date_trunc("week", day),
        "working days": F.when(F.weekday(day) < 5, day),
        "odd days": F.when(F.dayofmonth(day) % 2 == 1, day),
    }
    found = None
    for name, cut in cuts.items():
        series = lines_.select(cut.cast("timestamp_ntz").alias("t")).distinct()
        row = profile.temporal(series, "t").select(F.lit(name).alias("series"), "*")
        found = row if found is None else found.unionByName(row)
    return found


def prof_gaps(spark, sf_dir):
    return profile.gaps(table(spark, sf_dir, "events"), "ts", ["user_id"], 6 * 3600)


def prof_report(spark, sf_dir):
    return profile.report(lines(spark, sf_dir), "l_shipdate")


def _nulls_sql() -> str:
    rows = [
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) / count(*), 4) AS null_fraction FROM lines"
        for c, _ in LINE_COLUMNS
    ]
    return f"WITH lines AS ({_LINES})\n" + "\nUNION ALL\n".join(rows)


_FINDINGS = f"""
WITH lines AS ({_LINES}),
f AS (
  SELECT 'required' AS "check", 'l_comment,l_shipmode' AS "column", 'error' AS severity,
         'Missing required columns: l_comment, l_shipmode' AS message,
         2.0::DOUBLE AS observed, NULL::DOUBLE AS threshold, count(*) > 0 AS broken FROM lines
  UNION ALL
  SELECT 'nulls', 'l_discount', 'warning',
         printf('Column ''l_discount'' has %.1f%% nulls (threshold: %.1f%%)',
                avg((l_discount IS NULL)::INT) * 100, 10.0::DOUBLE),
         round(avg((l_discount IS NULL)::INT), 4), 0.1::DOUBLE, avg((l_discount IS NULL)::INT) > 0.1 FROM lines
  UNION ALL
  SELECT 'nulls', 'l_tax', 'warning',
         printf('Column ''l_tax'' has %.1f%% nulls (threshold: %.1f%%)',
                avg((l_tax IS NULL)::INT) * 100, 10.0::DOUBLE),
         round(avg((l_tax IS NULL)::INT), 4), 0.1::DOUBLE, avg((l_tax IS NULL)::INT) > 0.1 FROM lines
  UNION ALL
  SELECT 'range', 'l_quantity', 'warning',
         printf('Column ''l_quantity'' out of range: [%.4f, %.4f] vs expected [1.0000, 50.0000]',
                min(l_quantity), max(l_quantity)),
         CASE WHEN min(l_quantity) < 1 THEN min(l_quantity) ELSE max(l_quantity) END,
         CASE WHEN min(l_quantity) < 1 THEN 1.0 ELSE 50.0 END::DOUBLE,
         min(l_quantity) < 1 OR max(l_quantity) > 50 FROM lines
  UNION ALL
  SELECT 'range', 'l_extendedprice', 'warning',
         printf('Column ''l_extendedprice'' out of range: [%.4f, %.4f] vs expected [0.0000, 50000.0000]',
                min(l_extendedprice), max(l_extendedprice)),
         CASE WHEN min(l_extendedprice) < 0 THEN min(l_extendedprice) ELSE max(l_extendedprice) END,
         CASE WHEN min(l_extendedprice) < 0 THEN 0.0 ELSE 50000.0 END::DOUBLE,
         min(l_extendedprice) < 0 OR max(l_extendedprice) > 50000 FROM lines
  UNION ALL
  SELECT 'range', 'l_discount', 'warning',
         printf('Column ''l_discount'' out of range: [%.4f, %.4f] vs expected [0.0000, 0.0500]',
                min(l_discount), max(l_discount)),
         CASE WHEN min(l_discount) < 0 THEN min(l_discount) ELSE max(l_discount) END,
         CASE WHEN min(l_discount) < 0 THEN 0.0 ELSE 0.05 END::DOUBLE,
         min(l_discount) < 0 OR max(l_discount) > 0.05 FROM lines)
"""


def _requests_sql() -> str:
    reasons = []
    for c, (low, high) in presets.REQUEST_LIMITS.items():
        reasons.append(f"CASE WHEN {c} IS NULL THEN '{c}: missing' END")
        if low is not None:
            reasons.append(f"CASE WHEN {c} < {low:g} THEN '{c}: below {low:g}' END")
        if high is not None:
            reasons.append(f"CASE WHEN {c} > {high:g} THEN '{c}: above {high:g}' END")
    return f"""
WITH e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
r AS (
  SELECT event_id, value - 20 AS temperature_2m, value AS relative_humidity_2m,
         value / 2 AS dew_point_2m, value AS apparent_temperature, 870 + k * 2.5 AS pressure_msl,
         CASE WHEN event_type <> 'signup' THEN value END AS surface_pressure,
         value - 5 AS precipitation, value AS rain, 0.0 AS snowfall, k AS cloud_cover,
         value AS wind_speed_10m, k * 4 AS wind_direction_10m, value AS wind_gusts_10m,
         CAST(coalesce(CASE WHEN event_type <> 'view' THEN hour(ts) END, 12) AS INTEGER) AS hour
  FROM e),
c AS (SELECT event_id, hour, concat_ws('; ', {', '.join(reasons)}) AS reasons FROM r)
SELECT event_id, hour, reasons = '' AS accepted, reasons FROM c
"""


def _shape_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", '{t}' AS dtype, "
        f"count(*) AS row_count, {len(LINE_COLUMNS)} AS column_count FROM lineitem"
        for i, (c, t) in enumerate(LINE_COLUMNS)
    )


def _missing_sql() -> str:
    rows = [
        f"SELECT 'column' AS scope, '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"count(*) AS cells, round((count(*) - count({c})) / count(*) * 100, 2) AS percent FROM lines"
        for c, _ in LINE_COLUMNS
    ]
    gone = " + ".join(f"count(*) - count({c})" for c, _ in LINE_COLUMNS)
    n = len(LINE_COLUMNS)
    rows.append(
        f"SELECT 'total', '', {gone}, count(*) * {n}, round(({gone}) / (count(*) * {n}) * 100, 2) FROM lines"
    )
    return f"WITH lines AS ({_LINES})\n" + "\nUNION ALL\n".join(rows)


def _numeric_select(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean,
       round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min,
       round(max({c})::DOUBLE, 4) AS max,
       CASE WHEN min({c}) = max({c}) THEN 0 ELSE round(skewness({c}), 4) END AS skewness,
       CASE WHEN min({c}) = max({c}) THEN 0 ELSE round(kurtosis({c}), 4) END AS kurtosis,
       count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives,
       round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
       round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75
FROM lines"""


def _outlier_select(c: str, source: str) -> str:
    return f"""
SELECT '{c}' AS "column", count(*) FILTER ({c} < lo OR {c} > hi) AS outliers,
       round(count(*) FILTER ({c} < lo OR {c} > hi) / count({c}) * 100, 2) AS percent,
       round(any_value(lo), 4) AS lower_bound, round(any_value(hi), 4) AS upper_bound
FROM {source} CROSS JOIN (
  SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM (
    SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {source}))"""


def _pairs_sql() -> str:
    parts = []
    for i, a in enumerate(LINE_NUMERIC):
        for j in range(i + 1, len(LINE_NUMERIC)):
            b = LINE_NUMERIC[j]
            parts.append(
                f"SELECT {i} AS pos_a, {j} AS pos_b, '{a}' AS column_a, '{b}' AS column_b, "
                f"round(corr({a}, {b}), 4) AS correlation FROM lines"
            )
    return "\nUNION ALL\n".join(parts)


_MATRIX_SQL = (
    f"WITH lines AS ({_LINES}), pairs AS ({_pairs_sql()})\n"
    "SELECT column_a, column_b, correlation FROM pairs UNION ALL\n"
    "SELECT column_b, column_a, correlation FROM pairs UNION ALL\n"
    + "\nUNION ALL\n".join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in LINE_NUMERIC)
)
_TOP_SQL = "SELECT * FROM pairs ORDER BY abs(correlation) DESC, pos_a, pos_b LIMIT 10"


def _temporal_select(series: str, source: str, ts: str, gap: int) -> str:
    return f"""
SELECT '{series}' AS series, min({ts}) AS "start", max({ts}) AS "end",
       CAST(floor(epoch(max({ts}) - min({ts})) / 86400) AS BIGINT) AS duration_days,
       CASE WHEN count(*) < 3 THEN NULL
            WHEN min(d) = max(d) AND min(d) = 86400000000 THEN 'D' ELSE 'irregular' END AS frequency,
       count(*) FILTER (d > {gap}000000) AS gaps
FROM (SELECT {ts}, epoch_us({ts}) - epoch_us(lag({ts}) OVER (ORDER BY {ts})) AS d FROM {source})"""


def _report_sql() -> str:
    def text(source, section, column, other, measure, value):
        return (
            f"SELECT '{section}' AS section, {column} AS \"column\", {other} AS other, "
            f"'{measure}' AS measure, NULL::DOUBLE AS value, {value}::VARCHAR AS text FROM {source}"
        )

    def number(source, section, column, other, measure):
        return (
            f"SELECT '{section}', {column}, {other}, '{measure}', \"{measure}\"::DOUBLE, NULL FROM {source}"
        )

    name, none = '"column"', "NULL::VARCHAR"
    parts = [text("shape", "shape", name, none, "dtype", "dtype")]
    parts += [number("shape", "shape", name, none, m) for m in ("row_count", "column_count")]
    parts += [number("missing", "missing", name, none, m) for m in ("missing", "percent")]
    parts += [
        number("nums", "numeric", name, none, m)
        for m in ("count", "mean", "std", "min", "p25", "p50", "p75", "max", "skewness",
                  "kurtosis", "zeros", "negatives")
    ]
    parts += [
        number("outs", "outliers", name, none, m)
        for m in ("outliers", "percent", "lower_bound", "upper_bound")
    ]
    parts.append(number("tops", "top_pairs", "column_a", "column_b", "correlation"))
    parts += [text("times", "temporal", "'l_shipdate'", none, m, f'"{m}"') for m in ("start", "end", "frequency")]
    parts += [number("times", "temporal", "'l_shipdate'", none, m) for m in ("duration_days", "gaps")]
    missing = _missing_sql().split("\n", 1)[1]
    return (
        f"WITH lines AS ({_LINES}), shape AS ({_shape_sql()}), missing AS ({missing}),\n"
        f"nums AS ({' UNION ALL '.join(_numeric_select(c) for c in LINE_NUMERIC)}),\n"
        f"outs AS ({' UNION ALL '.join(_outlier_select(c, 'lines') for c in LINE_NUMERIC)}),\n"
        f"pairs AS ({_pairs_sql()}), tops AS ({_TOP_SQL}),\n"
        f"times AS ({_temporal_select('lines', 'lines', 'l_shipdate', 7200)})\n"
        + "\nUNION ALL\n".join(parts)
    )


QUERIES = {
    "val_nulls": val_nulls,
    "val_findings": val_findings,
    "val_empty": val_empty,
    "val_empty_nulls": val_empty_nulls,
    "val_all_null": val_all_null,
    "val_verdict": val_verdict,
    "val_request_split": val_request_split,
    "prof_shape": prof_shape,
    "prof_missing": prof_missing,
    "prof_numeric": prof_numeric,
    "prof_outliers": prof_outliers,
    "prof_outliers_events": prof_outliers_events,
    "prof_corr": prof_corr,
    "prof_corr_top": prof_corr_top,
    "prof_temporal": prof_temporal,
    "val_preset": val_preset,
    "prof_incremental": prof_incremental,
    "prof_calendar": prof_calendar,
    "prof_gaps": prof_gaps,
    "prof_report": prof_report,
}

ORACLE = {
    "val_nulls": _nulls_sql(),
    "val_findings": f"{_FINDINGS} SELECT * EXCLUDE (broken) FROM f WHERE broken",
    "val_empty": """SELECT 'empty' AS "check", '' AS "column", 'error' AS severity, 'DataFrame is empty' AS message,
       n::DOUBLE AS observed, NULL::DOUBLE AS threshold
FROM (SELECT count(*) AS n FROM lineitem WHERE l_quantity < 0) WHERE n = 0""",
    "val_empty_nulls": f"""SELECT unnest({[c for c, _ in LINE_COLUMNS]}) AS "column", count(*) AS null_count,
       0.0::DOUBLE AS null_fraction FROM lineitem WHERE l_quantity < 0""",
    "val_all_null": """SELECT 'all_null' AS "check", 'l_discount' AS "column", 'error' AS severity,
       'Column ''l_discount'' is entirely null' AS message, 1.0::DOUBLE AS observed, 1.0::DOUBLE AS threshold
FROM (SELECT count(*) AS n FROM lineitem WHERE l_discount = 0) WHERE n > 0""",
    "val_verdict": f"""{_FINDINGS}
SELECT (SELECT count(*) FROM lines) AS row_count, {len(LINE_COLUMNS)} AS column_count,
       CAST(count(*) FILTER (broken AND severity = 'error') AS INTEGER) AS error_count,
       CAST(count(*) FILTER (broken AND severity = 'warning') AS INTEGER) AS warning_count,
       count(*) FILTER (broken AND severity = 'error') = 0 AS is_valid
FROM f""",
    "val_request_split": _requests_sql(),
    "prof_shape": _shape_sql(),
    "prof_missing": _missing_sql(),
    "prof_numeric": f"WITH lines AS ({_LINES})" + " UNION ALL ".join(map(_numeric_select, LINE_NUMERIC)),
    "prof_outliers": f"WITH lines AS ({_LINES})"
    + " UNION ALL ".join(_outlier_select(c, "lines") for c in LINE_NUMERIC),
    "prof_outliers_events": _outlier_select("value", "events"),
    "prof_corr": _MATRIX_SQL,
    "prof_corr_top": f"WITH lines AS ({_LINES}), pairs AS ({_pairs_sql()}), tops AS ({_TOP_SQL})\n"
    "SELECT column_a, column_b, correlation FROM tops",
    "prof_temporal": _temporal_select("events", "events", "ts", 900)
    + " UNION ALL "
    + _temporal_select("orders", "orders", "o_orderdate", 7200)
    + " UNION ALL "
    + _temporal_select("days", "(SELECT DISTINCT o_orderdate FROM orders)", "o_orderdate", 7200),
    "val_preset": """
WITH w AS (
  SELECT l_quantity * 2 - 30 AS t, l_discount * 1000 AS h, CASE WHEN l_linenumber < 4 THEN 870 + l_tax * 100 END AS p,
         l_extendedprice / 100 AS r FROM lineitem),
ranges AS (
  SELECT 'temperature_2m' AS c, min(t) AS lo, max(t) AS hi, -60.0::DOUBLE AS a, 60.0::DOUBLE AS b FROM w
  UNION ALL SELECT 'relative_humidity_2m', min(h), max(h), 0, 100 FROM w
  UNION ALL SELECT 'pressure_msl', min(p), max(p), 870, 1084 FROM w
  UNION ALL SELECT 'precipitation', min(r), max(r), 0, 500 FROM w),
nulls AS (SELECT avg((p IS NULL)::INT) AS share FROM w)
SELECT 'required' AS "check", 'wind_speed_10m' AS "column", 'error' AS severity,
       'Missing required columns: wind_speed_10m' AS message, 1.0::DOUBLE AS observed, NULL::DOUBLE AS threshold
UNION ALL
SELECT 'nulls', 'pressure_msl', 'warning',
       printf('Column ''pressure_msl'' has %.1f%% nulls (threshold: %.1f%%)', share * 100, 10.0::DOUBLE),
       round(share, 4), 0.1::DOUBLE FROM nulls WHERE share > 0.1
UNION ALL
SELECT 'range', c, 'warning',
       printf('Column ''%s'' out of range: [%.4f, %.4f] vs expected [%.4f, %.4f]', c, lo, hi, a, b),
       CASE WHEN lo < a THEN lo ELSE hi END, CASE WHEN lo < a THEN a ELSE b END FROM ranges WHERE lo < a OR hi > b""",
    "prof_incremental": f"""
WITH lines AS ({_LINES}),
stats AS ({" UNION ALL ".join(map(_numeric_select, LINE_NUMERIC))}),
nulls AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS c, count(*) - count({c}) AS nulls, round((count(*) - count({c})) / count(*) * 100, 2) AS percent FROM lines"
    for c, _ in LINE_COLUMNS
)})
SELECT c AS "column", s.* EXCLUDE ("column", p25, p50, p75), nulls, percent FROM nulls JOIN stats s ON s."column" = c""",
    "prof_calendar": """
WITH s AS (
  SELECT DISTINCT series, t FROM (
    SELECT unnest(['months', 'month ends', 'quarters', 'years', 'weeks', 'working days', 'odd days']) AS series,
           unnest([date_trunc('month', l_shipdate)::TIMESTAMP, last_day(l_shipdate)::TIMESTAMP,
                   date_trunc('quarter', l_shipdate)::TIMESTAMP, date_trunc('year', l_shipdate)::TIMESTAMP,
                   date_trunc('week', l_shipdate)::TIMESTAMP,
                   CASE WHEN isodow(l_shipdate) < 6 THEN l_shipdate::TIMESTAMP END,
                   CASE WHEN day(l_shipdate) % 2 = 1 THEN l_shipdate::TIMESTAMP END]) AS t
    FROM lineitem) WHERE t IS NOT NULL),
l AS (SELECT series, t, lag(t) OVER (PARTITION BY series ORDER BY t) AS l FROM s)
SELECT series, min(t) AS start, max(t) AS "end", date_diff('day', min(t), max(t)) AS duration_days,
       CASE WHEN count(*) < 3 THEN NULL
            WHEN bool_and(day(t) = 1 AND month(t) = 1) AND bool_and(t = l + INTERVAL 1 YEAR) THEN 'YS-JAN'
            WHEN bool_and(day(t) = 1 AND month(t) IN (1, 4, 7, 10)) AND bool_and(t = l + INTERVAL 3 MONTH) THEN 'QS-OCT'
            WHEN bool_and(day(t) = 1) AND bool_and(t = l + INTERVAL 1 MONTH) THEN 'MS'
            WHEN bool_and(t = last_day(t)) AND bool_and(t = last_day(l + INTERVAL 1 DAY)) THEN 'ME'
            WHEN bool_and(isodow(t) = 1) AND bool_and(t = l + INTERVAL 7 DAY) THEN 'W-MON'
            WHEN bool_and(isodow(t) < 6) AND bool_and(t = l + CASE isodow(l) WHEN 5 THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END) THEN 'B'
            ELSE 'irregular' END AS frequency,
       count(*) FILTER (epoch_us(t) - epoch_us(l) > 7200000000) AS gaps
FROM l GROUP BY series""",
    "prof_gaps": """
SELECT user_id, count(*) FILTER (d > 21600000000) AS gaps FROM (
  SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS d FROM events)
GROUP BY user_id""",
    "prof_report": _report_sql(),
}
