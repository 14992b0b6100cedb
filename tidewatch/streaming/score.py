"""Scoring a stream of feature rows into the prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.forest import Forest
from tidewatch.operators.monitor import log_entries
from tidewatch.operators.score import score_with_spread
from tidewatch.sources import logs


def scored_entries(
    rows: DataFrame,
    model: Forest,
    features: Sequence[str],
    time_column: str,
    model_version: int,
    actual: str | None = None,
) -> DataFrame:
    """Prediction-log rows for feature rows; works on batch and streaming tables."""
    scored = score_with_spread(rows, model, features)
    pairs = [x for c in features for x in (F.lit(c), F.col(f"`{c}`"))]
    return log_entries(
        scored,
        timestamp=F.col(time_column),
        model_version=F.lit(model_version),
        prediction=F.col("prediction"),
        input_features=F.create_map(*pairs),
        confidence=F.col("confidence"),
        actual=None if actual is None else F.col(actual),
    )


def start_scoring(entries: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Append streamed log entries to the log, by day."""
    return (
        logs.dated(entries).writeStream.format("parquet")
        .partitionBy(logs.LOG_DATE)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", log_path)
        .trigger(availableNow=True)
        .start()
    )
