"""Drift of the prediction log over event-time windows.

The stream keeps, behind a watermark, how often each value of each input occurred in each
window; such counts add up whatever files a micro-batch holds. A window is tested once, when the
watermark has passed its end, so the reports do not depend on how the log is cut into batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch import presets
from tidewatch.functions import clock_instant, instant_clock
from tidewatch.operators import drift
from tidewatch.plans.staging import scratch, stage


def windowed_values(log: DataFrame, features: Sequence[str], window: str, watermark: str) -> DataFrame:
    """``window_start, window_end, feature, value, n`` of a log; feature NULL counts its rows."""
    value = lambda c: F.nanvl(F.try_element_at("input_features", F.lit(c)).cast("double"), F.lit(None).cast("double"))
    pairs = [F.struct(F.lit(c).alias("feature"), value(c).alias("value")) for c in features]
    rows = F.struct(F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("value"))
    timed = log.withColumn("_at", clock_instant(F.col("timestamp"))).withWatermark("_at", watermark)
    cells = timed.select("_at", F.inline(F.array(rows, *pairs))).filter("feature IS NULL OR value IS NOT NULL")
    return (
        cells.groupBy(F.window("_at", window).alias("w"), "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            instant_clock(F.col("w.start")).alias("window_start"),
            instant_clock(F.col("w.end")).alias("window_end"),
            "feature", "value", "n",
        )
    )


def start_drift(
    log: DataFrame,
    baseline: drift.Baseline,
    features: Sequence[str],
    out: str,
    checkpoint: str,
    window: str = "1 day",
    watermark: str = "1 hour",
    alpha: float = presets.DRIFT_ALPHA,
    min_rows: int = presets.DRIFT_MIN_ROWS,
) -> StreamingQuery:
    """Write the drift reports of the windows that closed to ``out/batch=<id>``.

    A window of fewer than ``min_rows`` rows has status "insufficient_data"; rows behind the
    watermark of their batch do not count. A replayed batch overwrites its own reports. Rows
    with ``drift_detected`` are the signal to retrain.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            closed = stage(batch, "closed")  # the stream's state is asked once
            if closed.isEmpty():
                return
            report = drift.window_reports(baseline, closed, alpha, min_rows)
            report.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        windowed_values(log, features, window, watermark)
        .writeStream.outputMode("append")
        .foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
