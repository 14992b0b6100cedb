"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest_input(spans: Iterable[tuple[str, int, int]]) -> str:
    """``kind:start:end`` of each span, joined by commas."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def training_row(doc_id: Column) -> Column:
    """True where labels may be learned from; the other rows are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def dealt(df: DataFrame) -> DataFrame:
    """``df`` behind an exchange of its own, so that a later join can split hot partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
