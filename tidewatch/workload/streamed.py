"""Streaming queries: tables are landed as files, streamed, and the sink is read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidewatch.operators import drift
from tidewatch.plans.staging import fresh_path
from tidewatch.sources import logs
from tidewatch.streaming import drift as drift_stream
from tidewatch.streaming import features as feature_stream
from tidewatch.streaming import ingest as ingest_stream
from tidewatch.streaming import monitor as monitor_stream
from tidewatch.streaming import score as score_stream
from tidewatch.workload.drifting import ks_sql
from tidewatch.workload.feature import ORACLE as FEATURE_ORACLE
from tidewatch.workload.feature import SERIES
from tidewatch.workload.logged import LOG_SQL, prediction_log
from tidewatch.workload.tables import HALF, HALF_SQL, MEASURED_SQL, at, measured, table
from tidewatch.workload.trained import STUMP_SQL, fitted, stump

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _land(df, path, parts):
    """Append ``df`` as several arrivals, one per predicate."""
    for part in parts:
        df.filter(part).write.mode("append").parquet(path)
        yield


def _halves():
    return [F.col("ts") < at(HALF), F.col("ts") >= at(HALF)]


def st_ingest(spark, sf_dir):
    """Two arrivals ingested by two runs of the same stream; the verdict of each batch."""
    landed, out, log, checkpoint = (fresh_path(spark, n) for n in ("landed", "out", "log", "cp"))
    events = table(spark, sf_dir, "events").drop("props")
    for _ in _land(events, landed, _halves()):
        stream = ingest_stream.read_stream(spark, landed, EVENTS, "parquet")
        ingest_stream.start_ingest(
            stream, out, log, checkpoint, "events", ["event_id"], {"value": (0.0, 100.0)}
        ).awaitTermination()
    rows = spark.read.parquet(out).groupBy("batch").agg(
        F.min("ts").alias("first_ts"), F.sum("event_id").alias("id_sum")
    )
    return spark.read.parquet(log).join(rows, "batch")


def st_monitor(spark, sf_dir):
    """Daily statistics of the closed days; the last day stays open."""
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "out", "cp"))
    logs.append_log(prediction_log(spark, sf_dir), landed)
    stats = monitor_stream.windowed_stats(logs.stream_log(spark, landed), "1 day", "1 hour")
    monitor_stream.start_append(stats, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def st_feature_stats(spark, sf_dir):
    """Daily statistics of each input feature over the closed days."""
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "out", "cp"))
    logs.append_log(prediction_log(spark, sf_dir), landed)
    stats = monitor_stream.windowed_feature_stats(logs.stream_log(spark, landed), "1 day", "1 hour")
    monitor_stream.start_append(stats, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def st_drift(spark, sf_dir):
    """Baseline from the first half; the days of the second half that close, read five files at a
    time and all at once."""
    landed, base = (fresh_path(spark, n) for n in ("landed", "base"))
    first = measured(spark, sf_dir).filter(F.col("ts") < at(HALF))
    drift.Baseline.of(first, ["k", "value"]).save(base)
    log = prediction_log(spark, sf_dir).filter(F.col("timestamp") >= at(HALF))
    for part in ("timestamp < timestamp_ntz'2024-01-23'", "timestamp >= timestamp_ntz'2024-01-23'"):
        logs.append_log(log.filter(part).coalesce(1), landed)
    found = None
    for cut, files in (("few", 5), ("whole", logs.FILES_PER_BATCH)):
        out, checkpoint = (fresh_path(spark, n) for n in ("out", "cp"))
        drift_stream.start_drift(
            logs.stream_log(spark, landed, files), drift.Baseline.load(spark, base), ["k", "value"],
            out, checkpoint, "1 day", "1 day",
        ).awaitTermination()
        report = spark.read.parquet(out).select(
            F.lit(cut).alias("cut"), "window_start", "status", "feature", "ks_statistic", "drift_detected",
            "current_mean", "current_std",
        )
        found = report if found is None else found.unionByName(report)
    return found


def _featured(spark, landed, lateness, **bound):
    """The landed files streamed to their end; ``bound`` says how they are cut into batches."""
    out, checkpoint = (fresh_path(spark, n) for n in ("out", "cp"))
    stream = feature_stream.FeatureStream(SERIES, out, lateness)
    source = ingest_stream.read_stream(spark, landed, EVENTS, "parquet", **bound)
    stream.start(source, checkpoint).awaitTermination()
    stream.finish(spark, checkpoint, source.schema)
    rows = feature_stream.read_features(spark, stream)
    rounded = [F.round(c, 6).alias(c) for c in SERIES.feature_columns]
    return rows.select("event_id", "event_type", *rounded), feature_stream.read_late(spark, stream)


def st_features(spark, sf_dir):
    """The later half arrives first; read one file at a time and all at once."""
    landed = fresh_path(spark, "landed")
    events = table(spark, sf_dir, "events").drop("props")
    for _ in _land(events.coalesce(1), landed, reversed(_halves())):
        pass
    month = timedelta(days=31)
    each, _ = _featured(spark, landed, month, max_files=1)
    whole, _ = _featured(spark, landed, month)
    return each.withColumn("cut", F.lit("each")).unionByName(whole.withColumn("cut", F.lit("whole")))


def st_features_late(spark, sf_dir):
    """Some rows of the first half arrive after the second one, with a day allowed."""
    landed = fresh_path(spark, "landed")
    events = table(spark, sf_dir, "events").drop("props").coalesce(1)
    first, second = _halves()
    tardy = F.col("event_id") % 50 == 7
    for _ in _land(events, landed, [first & ~tardy, second, first & tardy]):
        pass
    rows, late = _featured(spark, landed, timedelta(days=1), max_files=1)
    flagged = late.select("event_id", "event_type", F.lit(True).alias("late"))
    return rows.withColumn("late", F.lit(False)).unionByName(flagged, allowMissingColumns=True)


def st_score(spark, sf_dir):
    """Feature rows of the test period scored from a stream into the prediction log."""
    landed, log, checkpoint = (fresh_path(spark, n) for n in ("landed", "log", "cp"))
    model, rows, features = fitted(spark, sf_dir)
    rows.write.parquet(landed)
    stream = ingest_stream.read_stream(spark, landed, rows.schema, "parquet")
    entries = score_stream.scored_entries(stream, model, features, "ts", 1, "value")
    score_stream.start_scoring(entries, log, checkpoint).awaitTermination()
    return logs.read_log(spark, log).select(
        "timestamp", "prediction", F.col("confidence.std").alias("confidence_std"), "actual", "error"
    )


def st_score_stump(spark, sf_dir):
    """The same with a tree of one split."""
    landed, log, checkpoint = (fresh_path(spark, n) for n in ("landed", "log", "cp"))
    model, rows = stump(spark, sf_dir)
    rows.write.parquet(landed)
    stream = ingest_stream.read_stream(spark, landed, rows.schema, "parquet")
    entries = score_stream.scored_entries(stream, model, ["hour"], "ts", 1, "value")
    score_stream.start_scoring(entries, log, checkpoint).awaitTermination()
    return logs.read_log(spark, log).select(
        "timestamp", "model_version", F.round("prediction", 3).alias("prediction"),
        F.col("input_features.hour").alias("hour"), F.col("confidence.std").alias("std"), "actual",
    )


QUERIES = {
    "st_ingest": st_ingest,
    "st_monitor": st_monitor,
    "st_feature_stats": st_feature_stats,
    "st_drift": st_drift,
    "st_features": st_features,
    "st_features_late": st_features_late,
    "st_score": st_score,
    "st_score_stump": st_score_stump,
}

ORACLE = {
    "st_score_stump": f"""WITH {STUMP_SQL}
SELECT ts AS "timestamp", 1 AS model_version, round(p, 3) AS prediction, hour(ts)::DOUBLE AS hour,
       0.0::DOUBLE AS std, value AS actual FROM scored""",
    "st_ingest": f"""
SELECT CAST(ts >= {HALF_SQL} AS INTEGER) AS batch, 'events' AS source, count(*) AS row_count, 5 AS column_count,
       0 AS error_count, CAST(max(value) > 100 AS INTEGER) AS warning_count, true AS is_valid,
       min(ts) AS first_ts, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM events GROUP BY ts >= {HALF_SQL}""",
    "st_monitor": f"""
WITH {LOG_SQL}
SELECT date_trunc('day', "timestamp")::TIMESTAMP AS window_start,
       date_trunc('day', "timestamp")::TIMESTAMP + INTERVAL 1 DAY AS window_end,
       count(prediction) AS "count", round(avg(prediction), 4) AS mean, round(stddev_pop(prediction), 4) AS std,
       round(min(prediction), 4) AS min, round(max(prediction), 4) AS max,
       round(avg(confidence_std), 4) AS mean_std, round(max(confidence_std), 4) AS max_std,
       count(error) AS with_actual, round(avg(error), 4) AS mean_error, round(max(error), 4) AS max_error
FROM log GROUP BY 1, 2
HAVING date_trunc('day', "timestamp")::TIMESTAMP + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM log) - INTERVAL 1 HOUR""",
    "st_feature_stats": f"""
WITH {LOG_SQL},
long AS (SELECT date_trunc('day', "timestamp")::TIMESTAMP AS d, unnest(['k', 'hour', 'value']) AS feature,
                unnest([k, hour("timestamp")::DOUBLE, value]) AS v FROM log)
SELECT d AS window_start, d + INTERVAL 1 DAY AS window_end, feature, round(avg(v), 4) AS mean,
       round(stddev_pop(v), 4) AS std, round(min(v), 2) AS min, round(max(v), 2) AS max
FROM long WHERE v IS NOT NULL GROUP BY d, feature
HAVING d + INTERVAL 1 DAY <= (SELECT max("timestamp") FROM log) - INTERVAL 1 HOUR""",
    "st_features": f"SELECT f.*, cut FROM ({FEATURE_ORACLE['fe_features']}) f, (VALUES ('each'), ('whole')) c(cut)",
    "st_features_late": f"""
WITH marked AS (SELECT *, event_id % 50 = 7 AND ts < {HALF_SQL} AS late FROM events),
first AS ({FEATURE_ORACLE["fe_features"].replace("FROM events", "FROM (SELECT * FROM marked WHERE NOT late)")})
SELECT *, false AS late FROM first
UNION ALL BY NAME SELECT event_id, event_type, true AS late FROM marked WHERE late""",
    "st_drift": f"""
WITH {LOG_SQL}, {MEASURED_SQL},
base AS (SELECT k, value FROM measured WHERE ts < {HALF_SQL}),
cur AS (SELECT k, value, strftime("timestamp", '%Y-%m-%d') AS day FROM log
        WHERE "timestamp" >= {HALF_SQL}
          AND date_trunc('day', "timestamp") + INTERVAL 2 DAY <= (SELECT max("timestamp") FROM log)),
days AS (SELECT DISTINCT day FROM cur),
"""
    + ks_sql(
        " UNION ALL ".join(
            f"SELECT day || '{c}' AS feature, {c} AS value, false AS cur FROM base CROSS JOIN days "
            f"UNION ALL SELECT day || '{c}', {c}, true FROM cur"
            for c in ("k", "value")
        )
    )
    + """
SELECT cut, CAST(feature[1:10] AS TIMESTAMP) AS window_start, 'checked' AS status, feature[11:] AS feature,
       round(d, 6) AS ks_statistic, p < 0.05 AS drift_detected, round(cm, 4) AS current_mean, round(cs, 4) AS current_std
FROM t JOIN s USING (feature) CROSS JOIN (VALUES ('few'), ('whole')) c(cut)""",
}
