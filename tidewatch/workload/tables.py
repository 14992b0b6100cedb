"""Access to the test tables and the series derived from ``events``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import clock

# The events cover January 2024; this instant splits them into two halves.
HALF = datetime(2024, 1, 16)
HALF_SQL = "TIMESTAMP '2024-01-16 00:00:00'"
SHIP_HALF = datetime(1998, 7, 1)
SHIP_HALF_SQL = "TIMESTAMP '1998-07-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(moment: datetime):
    return clock(moment)


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in ``props`` as ``k``; error events carry no ``k``."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.when(F.col("event_type") != "error", k).alias("k"),
    )


MEASURED_SQL = """
measured AS (
  SELECT event_id, ts, user_id, event_type, value,
         CASE WHEN event_type <> 'error'
              THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k
  FROM events)
"""
