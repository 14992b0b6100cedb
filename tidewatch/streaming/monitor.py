"""Windowed monitoring of the prediction log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions import clock_instant, instant_clock
from tidewatch.operators.monitor import known


def _bounds() -> list[Column]:
    return [
        instant_clock(F.col("w.start")).alias("window_start"),
        instant_clock(F.col("w.end")).alias("window_end"),
    ]


def windowed_stats(log: DataFrame, window: str, watermark: str) -> DataFrame:
    """Prediction, spread and error statistics per tumbling event-time window.

    On a stream, a window comes out once, after the watermark has passed its end.
    """
    return (
        log.withColumn("_at", clock_instant(F.col("timestamp")))
        .withWatermark("_at", watermark)
        .groupBy(F.window("_at", window).alias("w"))
        .agg(
            F.count(known("prediction")).alias("count"),
            F.round(F.avg(known("prediction")), 4).alias("mean"),
            F.round(F.stddev_pop(known("prediction")), 4).alias("std"),
            F.round(F.min(known("prediction")), 4).alias("min"),
            F.round(F.max(known("prediction")), 4).alias("max"),
            F.round(F.avg(known("confidence.std")), 4).alias("mean_std"),
            F.round(F.max(known("confidence.std")), 4).alias("max_std"),
            F.count(known("error")).alias("with_actual"),
            F.round(F.avg(known("error")), 4).alias("mean_error"),
            F.round(F.max(known("error")), 4).alias("max_error"),
        )
        .select(*_bounds(), "*")
        .drop("w")
    )


def windowed_feature_stats(log: DataFrame, window: str, watermark: str) -> DataFrame:
    """Mean, population std, min and max per window and input feature."""
    timed = log.withColumn("_at", clock_instant(F.col("timestamp")))
    values = timed.withWatermark("_at", watermark).select(
        "_at", F.explode("input_features").alias("feature", "value")
    ).filter("value IS NOT NULL AND NOT isnan(value)")
    return (
        values.groupBy(F.window("_at", window).alias("w"), "feature")
        .agg(
            F.round(F.avg("value"), 4).alias("mean"),
            F.round(F.stddev_pop("value"), 4).alias("std"),
            F.round(F.min("value"), 2).alias("min"),
            F.round(F.max("value"), 2).alias("max"),
        )
        .select(*_bounds(), "*")
        .drop("w")
    )


def start_append(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append a streaming table to parquet files, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
