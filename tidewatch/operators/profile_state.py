"""Profiles of a growing data set from partial states that add up.

Every data version leaves one small row per column: counts, power sums about a shift that all versions
share, extremes and a quantile sketch. A profile of all versions merges these rows, so a new
version costs one scan of itself and nothing that came before is read again.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import clean, numeric_columns
from tidewatch.operators.profile import unpivot

SKETCH = 1024  # size of a quantile sketch: ranks within about half a percent
STATES = (
    "column string, position int, numeric boolean, rows long, n long, zeros long, negatives long, shift double, "
    "s1 double, s2 double, s3 double, s4 double, low double, high double, sketch binary"
)


class ProfileState:
    """Partial states below ``path``, a folder per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def states(self) -> DataFrame:
        """One row per version and column."""
        try:
            return self.spark.read.schema(f"{STATES}, version string").parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], f"{STATES}, version string")

    def add(self, df: DataFrame, version: str) -> None:
        """File the state of a version; filing it again replaces it.

        The first version sets the shift of its columns; a column that comes later sets its own.
        """
        shifts = {r["column"]: r["shift"] for r in self.states().groupBy("column").agg(F.first("shift").alias("shift")).collect()}
        new = [c for c in numeric_columns(df) if shifts.get(c) is None]
        if new:
            means = df.agg(*[F.avg(clean(df, c).cast("double")).alias(f"m{i}") for i, c in enumerate(new)]).first()
            shifts |= {c: _short(m) for c, m in zip(new, means, strict=True) if m is not None}
        state = partial_state(df, shifts).withColumn("version", F.lit(version))
        state.coalesce(1).drop("version").write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def missing(self) -> DataFrame:
        """Missing values per column over all versions; a version without the column lacks all of its."""
        return missing_of(self.states())

    def numeric_stats(self) -> DataFrame:
        """Distribution of each numeric column over all versions; quartiles are the sketch's."""
        return numeric_of(self.states())


def partial_state(df: DataFrame, shifts: dict[str, float]) -> DataFrame:
    """The state of every column of ``df``, in one scan for the counts and one for the numbers."""
    columns = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(clean(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    numbers = numeric_columns(df)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(i).alias("position"), F.lit(c in numbers).alias("numeric"),
                F.col("rows"), F.col(f"n{i}").alias("n"),
            )
            for i, c in enumerate(columns)
        ]
    )
    there = counts.select(F.inline(cells))
    if not numbers:
        blank = [F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in STATES.split(", ")[5:])]
        return there.select("*", *blank)
    v, x = F.col("value"), F.col("value") - F.col("shift")
    sums = unpivot(df, numbers, shift=[float(shifts.get(c, 0.0)) for c in numbers]).groupBy("position").agg(
        F.count_if(v == 0).alias("zeros"),
        F.count_if(v < 0).alias("negatives"),
        F.first("shift").alias("shift"),
        *[F.sum(_power(x, k)).alias(f"s{k}") for k in range(1, 5)],
        F.min(v).alias("low"),
        F.max(v).alias("high"),
        F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("sketch"),
    )
    name = F.element_at(F.array(*map(F.lit, numbers)), F.col("position") + 1).alias("column")
    return there.join(sums.select(name, *sums.columns[1:]), "column", "left").select(*[f.split()[0] for f in STATES.split(", ")])


def _short(mean: float) -> float:
    """A number near the mean with so few digits that sums of whole numbers less it are exact."""
    part, exponent = math.frexp(mean)
    return math.ldexp(round(part * 2**20), exponent - 20) if math.isfinite(mean) else 0.0


def _power(x: Column, k: int) -> Column:
    out = x
    for _ in range(k - 1):
        out = out * x
    return out


def missing_of(states: DataFrame) -> DataFrame:
    """``column, missing, percent`` (2 decimals) of merged states."""
    total = states.groupBy("version").agg(F.first("rows").alias("rows")).agg(F.sum("rows")).first()[0] or 0
    lacking = F.lit(total) - F.sum("n")
    percent = F.round(lacking / F.lit(total) * 100, 2) if total else F.lit(0.0)
    return states.groupBy("column").agg(lacking.alias("missing"), percent.alias("percent"))


def numeric_of(states: DataFrame) -> DataFrame:
    """Count, corrected moments, extremes and quartiles (4 decimals) of merged states.

    Moments about the mean follow from power sums about the shift. All-null columns are left out.
    """
    merged = (
        states.filter(F.col("numeric") & (F.col("n") > 0))
        .groupBy("column")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "zeros", "negatives", "s1", "s2", "s3", "s4")],
            F.max("shift").alias("shift"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("sketch"),
        )
    )
    n = F.col("n").cast("double")
    d, a2, a3, a4 = (F.col(c) / n for c in ("s1", "s2", "s3", "s4"))
    m2 = a2 - d * d
    m3 = a3 - 3 * d * a2 + 2 * d * d * d
    m4 = a4 - 4 * d * a3 + 6 * d * d * a2 - 3 * d * d * d * d
    constant = F.col("low") == F.col("high")
    skewness = F.try_divide(m3, F.pow(m2, 1.5)) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    kurtosis = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * (F.try_divide(m4, m2 * m2) - 3) + 6)
    quartile = lambda p: F.round(F.kll_sketch_get_quantile_double("sketch", F.lit(p)), 4)
    return merged.select(
        "column",
        F.col("n").alias("count"),
        F.round((F.col("shift") * n + F.col("s1")) / n, 4).alias("mean"),
        F.when(n > 1, F.when(constant, 0.0).otherwise(F.round(F.sqrt(F.greatest(m2, F.lit(0.0)) * n / (n - 1)), 4))).alias("std"),
        F.round("low", 4).alias("min"),
        *[quartile(p).alias(name) for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))],
        F.round("high", 4).alias("max"),
        F.when(n < 3, None).when(constant, 0.0).otherwise(F.round(skewness, 4)).alias("skewness"),
        F.when(n < 4, None).when(constant, 0.0).otherwise(F.round(kurtosis, 4)).alias("kurtosis"),
        "zeros",
        "negatives",
    )
