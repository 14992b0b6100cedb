"""Incremental ingestion of landed files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch import presets
from tidewatch.operators import validate

MAX_BYTES = 64 << 30


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "json",
    max_bytes: int = MAX_BYTES,
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream with a declared schema.

    ``max_bytes`` bounds a micro-batch, also when a long backlog is read; ``max_files``
    bounds it by the number of files instead.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is None:
        return reader.option("maxBytesPerTrigger", max_bytes).load(path)
    return reader.option("maxFilesPerTrigger", max_files).load(path)


def start_ingest(
    stream: DataFrame,
    out: str,
    log_path: str,
    checkpoint: str,
    source: str,
    required: Sequence[str] = (),
    ranges: Mapping[str, tuple[float, float]] | None = None,
    max_null_fraction: float = presets.MAX_NULL_FRACTION,
) -> StreamingQuery:
    """Append each micro-batch to ``out`` with its validation verdict in ``log_path``.

    Both are partitioned by ``batch``, and a replayed batch overwrites its own
    partition, so a restart neither loses nor repeats rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{out}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        saved = spark.read.schema(batch.schema).parquet(path)
        verdict = validate.verdict(saved, required, max_null_fraction, ranges)
        verdict.select(F.lit(source).alias("source"), "*").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{log_path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
