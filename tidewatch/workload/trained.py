"""Splitting, training, scoring and importance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import evaluate, importance, score, train
from tidewatch.operators.features import FeatureModel, FeatureSpec
from tidewatch.plans.ordering import over_series
from tidewatch.workload.feature import WITH_INPUT
from tidewatch.workload.tables import measured, table

ORDER = ["ts", "event_id"]
FOREST = {"numTrees": 50, "maxDepth": 10}


def tr_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    first, rest = evaluate.temporal_split(events, ORDER, 0.2)
    return first.select("event_id", F.lit("train").alias("part")).unionByName(
        rest.select("event_id", F.lit("test").alias("part"))
    )


def tr_folds(spark, sf_dir):
    return _fold_sums(table(spark, sf_dir, "events").select("event_id", "ts"))


def _fold_sums(events):
    parts = None
    for k, (before, block) in enumerate(evaluate.expanding_folds(events, ORDER, 5)):
        for name, rows in (("train", before), ("test", block)):
            part = rows.agg(
                F.count(F.lit(1)).alias("rows"),
                F.min("ts").alias("first_ts"),
                F.max("ts").alias("last_ts"),
                F.sum("event_id").alias("id_sum"),
            ).select(F.lit(k).alias("fold"), F.lit(name).alias("part"), "*")
            parts = part if parts is None else parts.unionByName(part)
    return parts


def _some_times_missing(spark, sf_dir):
    ts = F.when(F.col("event_id") % 10 != 3, F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", ts.alias("ts"))


def tr_split_nulls(spark, sf_dir):
    """Rows without a time come first and are kept."""
    first, rest = evaluate.temporal_split(_some_times_missing(spark, sf_dir), ORDER, 0.2)
    return first.select("event_id", F.lit("train").alias("part")).unionByName(
        rest.select("event_id", F.lit("test").alias("part"))
    )


def tr_folds_nulls(spark, sf_dir):
    return _fold_sums(_some_times_missing(spark, sf_dir))


def tr_metrics(spark, sf_dir):
    """Error of predicting each value by the mean of the user's three values before it."""
    return evaluate.regression_metrics(_guessed(spark, sf_dir), "value", "prediction", ["event_type"])


def tr_metrics_nan(spark, sf_dir):
    """Rows with a NaN prediction do not count."""
    guess = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("prediction"))
    broken = _guessed(spark, sf_dir).withColumn("prediction", guess)
    return evaluate.regression_metrics(broken, "value", "prediction", ["event_type"])


def _guessed(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return over_series(
        events,
        ["user_id"],
        ORDER,
        3,
        lambda w: [F.avg("value").over(w.rowsBetween(-3, -1)).alias("prediction")],
    )


def _matrix(spark, sf_dir):
    model = FeatureModel(FeatureSpec(**{**WITH_INPUT.__dict__, "include_current": False}))
    return model.fit_transform(measured(spark, sf_dir)), model.feature_columns


def fitted(spark, sf_dir):
    rows, features = _matrix(spark, sf_dir)
    first, rest = evaluate.temporal_split(rows, ORDER)
    return train.fit_forest(first, features, "value", FOREST), rest, features


def tr_cv_best(spark, sf_dir):
    rows, features = _matrix(spark, sf_dir)
    results = train.cross_validate(rows, features, "value", ORDER)
    best = train.best_combination(results)
    return best.select("combination", F.to_json("params").alias("params"), "folds", "cv_score")


def tr_score(spark, sf_dir):
    model, rest, features = fitted(spark, sf_dir)
    scored = score.score(rest, model, features)
    return scored.select("event_id", "ts", "value", F.round("prediction", 2).alias("prediction"))


def tr_spread(spark, sf_dir):
    model, rest, features = fitted(spark, sf_dir)
    scored = score.score_with_spread(rest, model, features)
    return scored.select("event_id", F.round("prediction", 4).alias("prediction"), "confidence.*")


# One tree of one split on all rows, which SQL can find as well.
STUMP = {"numTrees": 1, "maxDepth": 1, "bootstrap": False}


def hourly(spark, sf_dir):
    """Events with the hour of day as their only feature."""
    hour = F.hour("ts").cast("double").alias("hour")
    return table(spark, sf_dir, "events").select("event_id", "ts", "value", hour)


def stump(spark, sf_dir):
    first, rest = evaluate.temporal_split(hourly(spark, sf_dir), ORDER)
    return train.fit_forest(first, ["hour"], "value", STUMP), rest


def tr_score_stump(spark, sf_dir):
    model, rest = stump(spark, sf_dir)
    scored = score.score(rest, model, ["hour"])
    return scored.select("event_id", "ts", "value", F.round("prediction", 4).alias("prediction"))


def tr_spread_stump(spark, sf_dir):
    """Trees that agree have no spread."""
    model, rest = stump(spark, sf_dir)
    scored = score.score_with_spread(rest, model, ["hour"])
    return scored.select("event_id", F.round("prediction", 4).alias("prediction"), "confidence.*")


def tr_importance_stump(spark, sf_dir):
    model, rest = stump(spark, sf_dir)
    found = importance.builtin_importance(rest, model, ["hour"])
    return found.withColumn("rows", F.lit(rest.count()).cast("long"))


def tr_cv_stump(spark, sf_dir):
    """Error of the stump on each of five folds."""
    grid = {name: [value] for name, value in STUMP.items()}
    found = train.cross_validate(hourly(spark, sf_dir), ["hour"], "value", ORDER, grid, folds=5)
    return found.select("combination", "fold", F.round("mae", 6).alias("mae"))


def tr_importance(spark, sf_dir):
    model, rest, features = fitted(spark, sf_dir)
    return importance.builtin_importance(rest, model, features)


def tr_perm(spark, sf_dir):
    model, rest, features = fitted(spark, sf_dir)
    return importance.permutation_importance(rest, model, features, "value", ORDER, repeats=5)


def tr_perm_pair(spark, sf_dir):
    """A tree of two levels over two features, which SQL can find and permute as well: rows take
    the feature of the row a third, and a seventh, of the table further on."""
    rows = hourly(spark, sf_dir).join(
        table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).cast("double").alias("digit")), "event_id"
    )
    first, rest = evaluate.temporal_split(rows, ORDER)
    model = train.fit_forest(first, ["hour", "digit"], "value", {**STUMP, "maxDepth": 2})
    return importance.permutation_importance(
        rest, model, ["hour", "digit"], "value", ORDER, permutations=lambda n: [(1, n // 3), (1, n // 7)]
    )


def tr_rank(spark, sf_dir):
    """Brands ranked by mean price and by mean size; brands of small parts lack the price."""
    by_brand = (
        table(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(F.round(F.avg("p_size"), 4).alias("size"), F.round(F.avg("p_retailprice"), 2).alias("price"))
    )
    ordinal = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    brands = by_brand.select(ordinal.alias("ordinal"), F.col("p_brand").alias("feature"), "size", "price")
    return importance.combined_ranking(
        brands.select("ordinal", "feature"),
        brands.select("feature", F.col("size").alias("score")),
        brands.filter("size >= 25").select("feature", F.col("price").alias("score")),
    )


_NUMBERED = """
n AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS i,
             count(*) OVER () AS total FROM events)
"""
_NUMBERED_NULLS = """
e AS (SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN ts END AS ts FROM events),
n AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts NULLS FIRST, event_id) - 1 AS i,
             count(*) OVER () AS total FROM e)
"""
_SPLIT_SQL = "SELECT event_id, CASE WHEN i < floor(total * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM n"
_FOLDS_SQL = """
f AS (SELECT n.*, k, total - (5 - k) * (total // 6) AS lo, total - (4 - k) * (total // 6) AS hi
      FROM n CROSS JOIN range(5) AS r(k)),
p AS (SELECT *, CASE WHEN i < lo THEN 'train' ELSE 'test' END AS part FROM f WHERE i < hi)
SELECT CAST(k AS INTEGER) AS fold, part, count(*) AS "rows", min(ts) AS first_ts, max(ts) AS last_ts,
       CAST(sum(event_id) AS BIGINT) AS id_sum
FROM p GROUP BY k, part
"""


def _stump_sql(rows: str) -> str:
    """``best``: threshold and means of the split of ``rows`` (fold, x, y) with the least error."""
    return f"""
xs AS (SELECT DISTINCT fold, x FROM {rows}),
cuts AS (SELECT fold, (x + lead(x) OVER (PARTITION BY fold ORDER BY x)) / 2 AS t FROM xs),
splits AS (
  SELECT fold, t, avg(y) FILTER (x <= t) AS low, avg(y) FILTER (x > t) AS high,
         count(*) FILTER (x <= t) * var_pop(y) FILTER (x <= t)
         + count(*) FILTER (x > t) * var_pop(y) FILTER (x > t) AS cost
  FROM {rows} JOIN cuts USING (fold) WHERE t IS NOT NULL GROUP BY fold, t),
best AS (SELECT fold, arg_min(t, cost) AS t, arg_min(low, cost) AS low, arg_min(high, cost) AS high
         FROM splits GROUP BY fold)"""


_HOURLY_SQL = """
n AS (SELECT event_id, ts, value, hour(ts)::DOUBLE AS x, row_number() OVER (ORDER BY ts, event_id) - 1 AS i,
             count(*) OVER () AS total FROM events)"""
STUMP_SQL = f"""{_HOURLY_SQL},
early AS (SELECT 0 AS fold, x, value AS y FROM n WHERE i < floor(total * (1 - 0.2::DOUBLE))),
{_stump_sql("early")},
scored AS (SELECT event_id, ts, value, CASE WHEN x <= t THEN low ELSE high END AS p
           FROM n CROSS JOIN best WHERE i >= floor(total * (1 - 0.2::DOUBLE)))"""


def best_split_sql(rows: str, name: str) -> str:
    """``name``: feature, threshold and means of the best split of each node of ``rows`` (node, f, x, y)."""
    return f"""
{name}_cuts AS (SELECT node, f, (x + lead(x) OVER (PARTITION BY node, f ORDER BY x)) / 2 AS t
                FROM (SELECT DISTINCT node, f, x FROM {rows})),
{name}_splits AS (
  SELECT node, f, t, avg(y) FILTER (x <= t) AS low, avg(y) FILTER (x > t) AS high,
         count(*) FILTER (x <= t) * var_pop(y) FILTER (x <= t)
         + count(*) FILTER (x > t) * var_pop(y) FILTER (x > t) AS cost
  FROM {rows} JOIN {name}_cuts USING (node, f) WHERE t IS NOT NULL GROUP BY node, f, t),
{name} AS (SELECT node, arg_min(f, cost) AS f, arg_min(t, cost) AS t, arg_min(low, cost) AS low,
                  arg_min(high, cost) AS high FROM {name}_splits GROUP BY node)"""


_PAIR_SQL = f"""
WITH n AS (
  SELECT value AS y, [hour(ts)::DOUBLE, (user_id % 10)::DOUBLE] AS v,
         row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS total FROM events),
early AS (SELECT * FROM n WHERE i < floor(total * (1 - 0.2::DOUBLE))),
late AS (SELECT y, v, i - min(i) OVER () AS p, count(*) OVER () AS m FROM n WHERE i >= floor(total * (1 - 0.2::DOUBLE))),
tops AS (SELECT y, v, 0 AS node, unnest([1, 2]) AS f, unnest(v) AS x FROM early),
{best_split_sql("tops", "top")},
kids AS (SELECT e.y, e.v, CAST(e.v[top.f] > top.t AS INTEGER) AS node, unnest([1, 2]) AS f, unnest(e.v) AS x FROM early e CROSS JOIN top),
{best_split_sql("kids", "kid")},
tried AS (
  SELECT r, c, a.y, CASE c WHEN 0 THEN a.v WHEN 1 THEN [b.v[1], a.v[2]] ELSE [a.v[1], b.v[2]] END AS v
  FROM late a CROSS JOIN (VALUES (3), (7)) w(r) JOIN late b ON b.p = (a.p + a.m // r) % a.m
  CROSS JOIN (VALUES (0), (1), (2)) z(c)),
errors AS (
  SELECT r, c, avg(abs(y - CASE WHEN v[kid.f] <= kid.t THEN kid.low ELSE kid.high END)) AS e
  FROM tried CROSS JOIN top JOIN kid ON kid.node = CAST(v[top.f] > top.t AS INTEGER) GROUP BY r, c),
rises AS (SELECT a.c, a.e - b.e AS rise FROM errors a JOIN errors b ON a.r = b.r AND b.c = 0 WHERE a.c > 0)
SELECT CAST(c - 1 AS INTEGER) AS ordinal, ['hour', 'digit'][c] AS feature, round(avg(rise), 6) AS perm_mean,
       round(stddev_pop(rise), 6) AS perm_std
FROM rises GROUP BY c"""


def _metrics_sql(condition: str) -> str:
    return f"""
WITH g AS (
  SELECT event_id, event_type, value AS y, avg(value) OVER (
           PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS p
  FROM events)
SELECT event_type, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 4) AS r2
FROM g WHERE p IS NOT NULL AND {condition} GROUP BY event_type
"""



QUERIES = {
    "tr_split": tr_split,
    "tr_folds": tr_folds,
    "tr_split_nulls": tr_split_nulls,
    "tr_folds_nulls": tr_folds_nulls,
    "tr_metrics": tr_metrics,
    "tr_metrics_nan": tr_metrics_nan,
    "tr_cv_best": tr_cv_best,
    "tr_score": tr_score,
    "tr_score_stump": tr_score_stump,
    "tr_spread_stump": tr_spread_stump,
    "tr_importance_stump": tr_importance_stump,
    "tr_cv_stump": tr_cv_stump,
    "tr_spread": tr_spread,
    "tr_importance": tr_importance,
    "tr_perm": tr_perm,
    "tr_perm_pair": tr_perm_pair,
    "tr_rank": tr_rank,
}

ORACLE = {
    "tr_split": f"WITH {_NUMBERED} {_SPLIT_SQL}",
    "tr_split_nulls": f"WITH {_NUMBERED_NULLS} {_SPLIT_SQL}",
    "tr_folds": f"WITH {_NUMBERED}, {_FOLDS_SQL}",
    "tr_folds_nulls": f"WITH {_NUMBERED_NULLS}, {_FOLDS_SQL}",
    "tr_metrics": _metrics_sql("true"),
    "tr_metrics_nan": _metrics_sql("event_id % 5 <> 0"),
    "tr_score_stump": f"WITH {STUMP_SQL} SELECT event_id, ts, value, round(p, 4) AS prediction FROM scored",
    "tr_spread_stump": f"""WITH {STUMP_SQL}
SELECT event_id, round(p, 4) AS prediction, 0.0::DOUBLE AS std, round(p, 2) AS min, round(p, 2) AS max FROM scored""",
    "tr_importance_stump": f"""WITH {STUMP_SQL}
SELECT 0 AS ordinal, 'hour' AS feature, 1.0::DOUBLE AS importance, count(*) AS "rows" FROM scored""",
    "tr_cv_stump": f"""
WITH {_HOURLY_SQL},
f AS (SELECT n.*, k AS fold, total - (5 - k) * (total // 6) AS lo, total - (4 - k) * (total // 6) AS hi
      FROM n CROSS JOIN range(5) AS r(k)),
early AS (SELECT fold, x, value AS y FROM f WHERE i < lo),
{_stump_sql("early")}
SELECT 0 AS combination, CAST(fold AS INTEGER) AS fold,
       round(avg(abs(value - CASE WHEN x <= t THEN low ELSE high END)), 6) AS mae
FROM f JOIN best USING (fold) WHERE i >= lo AND i < hi GROUP BY fold""",
    "tr_perm_pair": _PAIR_SQL,
    "tr_rank": """
WITH b AS (
  SELECT CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS ordinal, p_brand AS feature,
         round(avg(p_size), 4) AS size, round(avg(p_retailprice), 2) AS price
  FROM part GROUP BY p_brand),
s AS (SELECT feature, row_number() OVER (ORDER BY size DESC, ordinal) - 1 AS r FROM b),
q AS (SELECT feature, row_number() OVER (ORDER BY price DESC, ordinal) - 1 AS r FROM b WHERE size >= 25),
a AS (
  SELECT b.ordinal, b.feature,
         round((s.r + coalesce(q.r, (SELECT count(*) FROM b))) / 2.0::DOUBLE, 2) AS avg_rank
  FROM b JOIN s USING (feature) LEFT JOIN q USING (feature))
SELECT feature, avg_rank, CAST(row_number() OVER (ORDER BY avg_rank, ordinal) AS INTEGER) AS position FROM a
""",
}
