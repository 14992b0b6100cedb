"""Model registry as an append-only event table, folded when it is read.

Registering and promoting each append one row. Concurrent readers never see a
half-written registry, and the history of promotions is kept.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.claims import claim_number

REGISTRY_EVENTS = (
    "event_ts timestamp_ntz, seq long, kind string, version int, model_path string, "
    "metrics map<string,double>, training_info map<string,string>"
)


def production_version(events: DataFrame) -> int | None:
    """Version of the latest valid promotion, else the first registered version."""
    registered = events.filter("kind = 'register'").select("version").distinct()
    promoted = events.filter("kind = 'promote'").join(registered, "version", "left_semi")
    latest = promoted.agg(F.max_by("version", F.struct("event_ts", "seq"))).first()[0]
    if latest is not None:
        return latest
    return events.filter("kind = 'register'").agg(F.min("version")).first()[0]


def models(events: DataFrame) -> DataFrame:
    """Registered versions with their metadata and the ``is_production`` flag."""
    current = production_version(events)
    return events.filter("kind = 'register'").select(
        "version",
        "model_path",
        "metrics",
        "training_info",
        F.col("event_ts").alias("registered_at"),
        F.coalesce(F.col("version") == F.lit(current), F.lit(False)).alias("is_production"),
    )


def model_info(events: DataFrame, version: int | None = None) -> DataFrame:
    """The row of ``version``, by default of the production model."""
    state = models(events)
    found = state.filter("is_production") if version is None else state.filter(
        F.col("version") == version
    )
    if found.isEmpty():
        raise ValueError(f"model v{version} not found in registry")
    return found


def compare(events: DataFrame, version_a: int, version_b: int) -> DataFrame:
    """Metrics that both versions have, and the difference b - a (4 decimals)."""
    state = models(events)

    def side(version: int, name: str) -> DataFrame:
        row = state.filter(F.col("version") == version)
        if row.isEmpty():
            raise ValueError(f"model v{version} not found in registry")
        return row.select(F.explode("metrics").alias("metric", name))

    both = side(version_a, "value_a").join(side(version_b, "value_b"), "metric")
    return both.select(
        "metric",
        "value_a",
        "value_b",
        F.round(F.col("value_b") - F.col("value_a"), 4).alias("diff"),
    )


def best_versions(events: DataFrame) -> DataFrame:
    """Best value and owning version of mae, rmse (lowest) and r2 (highest).

    A missing metric counts as 0 and the lowest version wins ties.
    """
    metric = lambda name: F.coalesce(
        F.try_element_at("metrics", F.lit(name)), F.lit(0.0)
    )
    scored = events.filter("kind = 'register'").select(
        "version", metric("mae").alias("mae"), metric("rmse").alias("rmse"), metric("r2").alias("r2")
    )
    first_on_ties = -F.col("version")
    row = scored.agg(
        F.min(F.struct("mae", "version")).alias("mae"),
        F.min(F.struct("rmse", "version")).alias("rmse"),
        F.max(F.struct(F.col("r2"), first_on_ties.alias("version"))).alias("r2"),
    )
    entry = lambda name, version: F.struct(
        F.lit(name).alias("metric"),
        F.col(f"{name}.{name}").alias("value"),
        version.alias("version"),
    )
    entries = F.array(
        entry("mae", F.col("mae.version")),
        entry("rmse", F.col("rmse.version")),
        entry("r2", -F.col("r2.version")),
    )
    return row.select(F.inline(entries)).filter("version IS NOT NULL")


def metric_series(events: DataFrame) -> DataFrame:
    """mae, rmse and r2 by version; a missing metric is 0."""
    return events.filter("kind = 'register'").select(
        "version",
        *[
            F.coalesce(F.try_element_at("metrics", F.lit(m)), F.lit(0.0)).alias(m)
            for m in ("mae", "rmse", "r2")
        ],
    )


class ModelRegistry:
    """Registry events stored as parquet below ``path``; versions and places are claimed.

    Every event has a folder of its own: writers at the same time would clear each other's
    unfinished files in a shared one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(REGISTRY_EVENTS).option("recursiveFileLookup", True).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], REGISTRY_EVENTS)

    def claim_version(self) -> int:
        """A version number that no other writer gets, for :meth:`register`."""
        last = self.events().filter("kind = 'register'").agg(F.max("version")).first()[0]
        return claim_number(self.spark, self.path, "version=", last or 0)

    def register(
        self,
        model_path: str,
        metrics: Mapping[str, float],
        training_info: Mapping[str, str] | None = None,
        at: datetime | None = None,
        version: int | None = None,
    ) -> int:
        """Append a version, by default a new one; only the first one becomes production by itself."""
        version = self.claim_version() if version is None else version
        info = {k: str(v) for k, v in (training_info or {}).items()}
        self._append("register", version, model_path, dict(metrics), info, at)
        return version

    def promote(self, version: int, at: datetime | None = None) -> None:
        """Make ``version`` the production model; an unknown version changes nothing."""
        known = self.events().filter((F.col("kind") == "register") & (F.col("version") == version))
        if known.isEmpty():
            raise ValueError(f"model v{version} not found in registry")
        self._append("promote", version, None, None, None, at)

    def _append(self, kind, version, model_path, metrics, info, at) -> None:
        seq = claim_number(self.spark, self.path, "seq=", self.events().agg(F.max("seq")).first()[0] or 0)
        row = (at or datetime.now(), seq, kind, version, model_path, metrics, info)
        self.spark.createDataFrame([row], REGISTRY_EVENTS).coalesce(1).write.parquet(f"{self.path}/event={seq}")

    def models(self) -> DataFrame:
        return models(self.events())

    def info(self, version: int | None = None) -> DataFrame:
        return model_info(self.events(), version)

    def compare(self, version_a: int, version_b: int) -> DataFrame:
        return compare(self.events(), version_a, version_b)

    def production_version(self) -> int | None:
        return production_version(self.events())
