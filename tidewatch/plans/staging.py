"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A staged table replaces the lineage of everything above it, so an executor lost
later costs a re-read of parquet and never a re-run of a range partitioning whose
sampled bounds would come out differently.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SETTING = "spark.checkpoint.dir"
_scope: ContextVar[dict[str, StructType] | None] = ContextVar("scope", default=None)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables; without the setting, one below the warehouse."""
    root = spark.conf.get(SETTING, None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staged"
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    folder = f"{staging_root(spark)}/tidewatch/{spark.sparkContext.applicationId}"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet below the shared folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    if (held := _scope.get()) is not None:
        held[path] = df.schema
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are emptied at the end; nothing may read them any more.

    Scopes nest, and those of other threads are apart.
    """
    held: dict[str, StructType] = {}
    token = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(token)
        for path, schema in held.items():
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
