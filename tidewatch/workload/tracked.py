"""Registry and experiment-run queries.

Suppliers stand for registered models, line items for promotion events and orders
for experiment runs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.operators import registry, runs
from tidewatch.plans.staging import fresh_path
from tidewatch.workload.tables import table


def registry_events(spark, sf_dir):
    """Every supplier registers a version; returned line items promote theirs.

    Line items of supplier 0 promote a version that does not exist.
    """
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit(None).cast("timestamp_ntz").alias("event_ts"),
        F.col("s_suppkey").alias("seq"),
        F.lit("register").alias("kind"),
        (F.col("s_suppkey") + 1).cast("int").alias("version"),
        F.concat(F.lit("models/v"), (F.col("s_suppkey") + 1).cast("string")).alias("model_path"),
        F.when(
            F.col("s_acctbal") >= 0,
            F.create_map(
                F.lit("mae"), F.round(F.col("s_acctbal") / 1000, 6),
                F.lit("rmse"), F.round(F.col("s_acctbal") / 800, 8),
                F.lit("r2"), F.round(1 - F.col("s_acctbal") / 10000, 7),
            ),
        ).otherwise(F.create_map(F.lit("mae"), F.lit(9.5))).alias("metrics"),
        F.create_map(F.lit("name"), F.col("s_name")).alias("training_info"),
    )
    promotions = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("event_ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.lit("promote").alias("kind"),
        F.when(F.col("l_suppkey") == 0, 2_000_000_000)
        .otherwise(F.col("l_suppkey") + 1).cast("int").alias("version"),
        F.lit(None).cast("string").alias("model_path"),
        F.lit(None).cast("map<string,double>").alias("metrics"),
        F.lit(None).cast("map<string,string>").alias("training_info"),
    )
    return suppliers.unionByName(promotions)


def exp_record(spark, sf_dir):
    """A run per market segment, filed and read back; the last asks for an id that is taken."""
    log = runs.RunLog(spark, fresh_path(spark, "runs"))
    accounts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"), F.min("c_custkey").alias("first")
    )
    found = accounts.orderBy("c_mktsegment").collect()
    for i, r in enumerate([*found, found[0]]):
        log.append(
            f"run_{r['c_mktsegment']}", "segments", r["n"] / 4, {"first": r["first"], "depth": None, "on": True},
            {"balance": r["balance"], "n": r["n"]}, {"segment": r["c_mktsegment"]}, [f"a/{r['n']}"],
            None if i else "abc123", datetime(2024, 1, 1 + i),
        )
    rows = log.runs()
    value = lambda kind, key: F.try_element_at(kind, F.lit(key))
    return rows.select(
        "run_id", "experiment", "timestamp", "duration_seconds",
        value("params", "first").alias("first"), value("params", "depth").alias("depth"), value("params", "on").alias("on"),
        value("metrics", "balance").alias("balance"), value("metrics", "n").alias("n"),
        value("tags", "run_name").alias("run_name"), value("tags", "segment").alias("segment"),
        F.col("artifacts")[0].alias("artifact"), "git_commit",
    )


def reg_state(spark, sf_dir):
    state = registry.models(registry_events(spark, sf_dir))
    return state.select("version", "model_path", F.try_element_at("metrics", F.lit("mae")).alias("mae"),
                        F.try_element_at("training_info", F.lit("name")).alias("name"), "is_production")


def reg_info(spark, sf_dir):
    info = registry.model_info(registry_events(spark, sf_dir))
    return info.select("version", "model_path", F.col("metrics.mae").alias("mae"), "is_production")


def reg_compare(spark, sf_dir):
    """First version against the production version."""
    events = registry_events(spark, sf_dir)
    return registry.compare(events, 1, registry.production_version(events))


def reg_best(spark, sf_dir):
    return registry.best_versions(registry_events(spark, sf_dir))


def reg_series(spark, sf_dir):
    return registry.metric_series(registry_events(spark, sf_dir))


def run_records(spark, sf_dir):
    """Every order is a run; finished orders have metrics, pending ones lack r2."""
    price = F.col("o_totalprice")
    mae, rmse = F.round(price / 1000, 6), F.round(price / 800, 8)
    depth = F.when(F.col("o_orderstatus") == "F", F.lit("10"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderdate").alias("timestamp"),
        F.round(price / 100, 5).alias("duration_seconds"),
        F.create_map(
            F.lit("customer"), F.col("o_custkey").cast("string"),
            F.lit("max_depth"), F.coalesce(depth, F.lit("None")),
        ).alias("params"),
        F.when(F.col("o_orderstatus") == "F", F.create_map(
            F.lit("mae"), mae, F.lit("rmse"), rmse, F.lit("r2"), F.round(1 - price / 1000000, 9)))
        .when(F.col("o_orderstatus") == "P", F.create_map(F.lit("mae"), mae, F.lit("rmse"), rmse))
        .otherwise(F.create_map().cast("map<string,double>")).alias("metrics"),
        F.when(F.col("o_orderstatus") == "F", F.create_map(
            F.lit("model_version"), F.col("o_orderkey").cast("string")))
        .otherwise(F.create_map().cast("map<string,string>")).alias("tags"),
        F.array().cast("array<string>").alias("artifacts"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("git_commit"),
    )


def exp_list(spark, sf_dir):
    listed = runs.list_runs(run_records(spark, sf_dir), "1-URGENT")
    return listed.select("run_id", "experiment", "timestamp", "duration_seconds",
                         F.try_element_at("params", F.lit("max_depth")).alias("max_depth"))


def exp_best(spark, sf_dir):
    records = run_records(spark, sf_dir)
    low, high = runs.best_run(records, "mae"), runs.best_run(records, "r2", lower_is_better=False)
    parts = [low.select(F.lit("mae").alias("metric"), "run_id", "metrics"),
             high.select(F.lit("r2").alias("metric"), "run_id", "metrics")]
    both = parts[0].unionByName(parts[1])
    return both.select("metric", "run_id", F.element_at("metrics", F.col("metric")).alias("value"))


def exp_compare(spark, sf_dir):
    """The first run of every experiment side by side."""
    records = run_records(spark, sf_dir)
    firsts = records.groupBy("experiment").agg(
        F.min_by("run_id", F.struct("timestamp", "run_id")).alias("run_id")
    )
    return runs.compare_runs(records, firsts)


def exp_history(spark, sf_dir):
    return runs.run_history(run_records(spark, sf_dir))


def exp_series(spark, sf_dir):
    return runs.metric_over_runs(run_records(spark, sf_dir))


def exp_fingerprint(spark, sf_dir):
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    return runs.fingerprint(part).select(F.lit("part").alias("name"), "*").unionByName(
        runs.fingerprint(customer).select(F.lit("customer").alias("name"), "*")
    )


_REGISTRY_SQL = """
reg AS (
  SELECT CAST(s_suppkey + 1 AS INTEGER) AS version, 'models/v' || (s_suppkey + 1) AS model_path, s_name AS name,
         CASE WHEN s_acctbal >= 0 THEN round(s_acctbal / 1000, 6) ELSE 9.5 END AS mae,
         CASE WHEN s_acctbal >= 0 THEN round(s_acctbal / 800, 8) END AS rmse,
         CASE WHEN s_acctbal >= 0 THEN round(1 - s_acctbal / 10000, 7) END AS r2
  FROM supplier),
prod AS (
  SELECT coalesce(
    (SELECT l_suppkey + 1 FROM lineitem WHERE l_suppkey <> 0
     ORDER BY l_shipdate DESC, l_orderkey * 10 + l_linenumber DESC LIMIT 1),
    (SELECT min(version) FROM reg)) AS version)
"""
_RUNS_SQL = """
runs AS (
  SELECT 'run_' || o_orderkey AS run_id, o_orderpriority AS experiment, o_orderdate AS "timestamp",
         round(o_totalprice / 100, 5) AS duration_seconds,
         CASE WHEN o_orderstatus = 'F' THEN '10' ELSE 'None' END AS max_depth, o_custkey::VARCHAR AS customer,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN round(o_totalprice / 1000, 6) END AS mae,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN round(o_totalprice / 800, 8) END AS rmse,
         CASE WHEN o_orderstatus = 'F' THEN round(1 - o_totalprice / 1000000, 9) END AS r2,
         CASE WHEN o_orderstatus = 'F' THEN o_orderkey::VARCHAR END AS model_version,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS git_commit
  FROM orders)
"""


def _fingerprint_sql(name: str, columns: list[str]) -> str:
    cells = ", ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns)
    names = "[" + ",".join(f'"{c}"' for c in columns) + "]"
    part = lambda start: f"sum(('0x' || substr(h, {start}, 8))::UBIGINT)::HUGEINT"
    return f"""
SELECT '{name}' AS name, n AS row_count, {len(columns)} AS column_count,
       substr(sha256(concat_ws(':', '{names}', n::VARCHAR, a::VARCHAR, b::VARCHAR)), 1, 12) AS data_hash
FROM (SELECT count(*) AS n, {part(1)} AS a, {part(9)} AS b
      FROM (SELECT md5(concat_ws('|', {cells})) AS h FROM {name}))"""


QUERIES = {
    "exp_record": exp_record,
    "reg_state": reg_state,
    "reg_info": reg_info,
    "reg_compare": reg_compare,
    "reg_best": reg_best,
    "reg_series": reg_series,
    "exp_list": exp_list,
    "exp_best": exp_best,
    "exp_compare": exp_compare,
    "exp_history": exp_history,
    "exp_series": exp_series,
    "exp_fingerprint": exp_fingerprint,
}

ORACLE = {
    "exp_record": """
WITH s AS (
  SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS balance, min(c_custkey) AS first,
         row_number() OVER (ORDER BY c_mktsegment) - 1 AS i, count(*) OVER () AS m FROM customer GROUP BY c_mktsegment),
r AS (SELECT *, i AS place, 'run_' || segment AS run_id FROM s UNION ALL SELECT *, m, 'run_' || segment || '_2' FROM s WHERE i = 0)
SELECT run_id, 'segments' AS experiment, TIMESTAMP '2024-01-01' + to_days(CAST(place AS INTEGER)) AS "timestamp",
       round(n / 4, 2) AS duration_seconds, CAST(first AS VARCHAR) AS first, 'None' AS depth, 'True' AS "on",
       balance, n::DOUBLE AS n, run_id AS run_name, segment, 'a/' || n AS artifact,
       CASE WHEN place = 0 THEN 'abc123' END AS git_commit FROM r""",
    "reg_state": f"""WITH {_REGISTRY_SQL}
SELECT version, model_path, mae, name, version = (SELECT version FROM prod) AS is_production FROM reg""",
    "reg_info": f"""WITH {_REGISTRY_SQL}
SELECT version, model_path, mae, true AS is_production FROM reg WHERE version = (SELECT version FROM prod)""",
    "reg_compare": f"""WITH {_REGISTRY_SQL},
long AS (SELECT version, unnest(['mae', 'rmse', 'r2']) AS metric, unnest([mae, rmse, r2]) AS v FROM reg)
SELECT metric, a.v AS value_a, b.v AS value_b, round(b.v - a.v, 4) AS diff
FROM long a JOIN long b USING (metric)
WHERE a.version = 1 AND b.version = (SELECT version FROM prod) AND a.v IS NOT NULL AND b.v IS NOT NULL""",
    "reg_best": f"""WITH {_REGISTRY_SQL},
z AS (SELECT version, mae, coalesce(rmse, 0) AS rmse, coalesce(r2, 0) AS r2 FROM reg)
(SELECT 'mae' AS metric, mae AS value, version FROM z ORDER BY mae, version LIMIT 1)
UNION ALL (SELECT 'rmse', rmse, version FROM z ORDER BY rmse, version LIMIT 1)
UNION ALL (SELECT 'r2', r2, version FROM z ORDER BY r2 DESC, version LIMIT 1)""",
    "reg_series": f"""WITH {_REGISTRY_SQL}
SELECT version, mae, coalesce(rmse, 0) AS rmse, coalesce(r2, 0) AS r2 FROM reg""",
    "exp_list": f"""WITH {_RUNS_SQL}
SELECT run_id, experiment, "timestamp", duration_seconds, max_depth FROM runs WHERE experiment = '1-URGENT'""",
    "exp_best": f"""WITH {_RUNS_SQL}
(SELECT 'mae' AS metric, run_id, mae AS value FROM runs WHERE mae IS NOT NULL
 ORDER BY mae, "timestamp" DESC, run_id DESC LIMIT 1)
UNION ALL
(SELECT 'r2', run_id, r2 FROM runs WHERE r2 IS NOT NULL ORDER BY r2 DESC, "timestamp" DESC, run_id DESC LIMIT 1)""",
    "exp_compare": f"""WITH {_RUNS_SQL},
f AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY "timestamp", run_id) AS i FROM runs)
SELECT run_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp", duration_seconds AS duration_s,
       coalesce(git_commit, 'N/A') AS git_commit, mae AS metric_mae, rmse AS metric_rmse, r2 AS metric_r2,
       customer AS param_customer, max_depth AS param_max_depth
FROM f WHERE i = 1""",
    "exp_history": f"""WITH {_RUNS_SQL}
SELECT run_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp",
       coalesce(mae::VARCHAR, 'N/A') AS mae, coalesce(rmse::VARCHAR, 'N/A') AS rmse,
       coalesce(r2::VARCHAR, 'N/A') AS r2, coalesce(duration_seconds::VARCHAR, 'N/A') AS duration_s,
       coalesce(model_version, 'N/A') AS model_version, coalesce(git_commit, 'N/A') AS git_commit
FROM runs""",
    "exp_series": f"""WITH {_RUNS_SQL}
SELECT run_id, "timestamp", mae FROM runs WHERE mae IS NOT NULL""",
    "exp_fingerprint": _fingerprint_sql(
        "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    )
    + " UNION ALL "
    + _fingerprint_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
}
