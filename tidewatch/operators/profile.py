"""Data profiles: shape, missing cells, distributions, outliers, correlation, time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import (
    clean,
    clock_micros,
    normalise_missing,
    numeric_columns,
    quoted,
    sample_kurtosis,
    sample_skewness,
)
from tidewatch.plans.selection import exact_quantiles

GAP_SECONDS = 7200
IQR_MULTIPLIER = 1.5
_DAY_MICROS = 86_400_000_000
_ERA_SLOTS = 10_000


def shape(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, type, and the size of the table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.col("row_count"),
                        F.lit(len(df.columns)).alias("column_count"),
                    )
                    for i, f in enumerate(df.schema.fields)
                ]
            )
        )
    )


def missing(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, and one ``scope='total'`` row.

    The total row counts cells. Percentages have two decimals and are 0 for an
    empty table.
    """
    data = normalise_missing(df)
    row = data.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )

    def entry(scope: str, name: str, count, cells):
        percent = F.when(cells > 0, F.round(count / cells * 100, 2)).otherwise(0.0)
        return F.struct(
            F.lit(scope).alias("scope"),
            F.lit(name).alias("column"),
            count.alias("missing"),
            cells.alias("cells"),
            percent.alias("percent"),
        )

    total = F.lit(0).cast("long")
    for i in range(len(df.columns)):
        total = total + F.col(f"m{i}")
    entries = [
        entry("column", c, F.col(f"m{i}"), F.col("rows")) for i, c in enumerate(df.columns)
    ]
    entries.append(entry("total", "", total, F.col("rows") * len(df.columns)))
    return row.select(F.inline(F.array(*entries)))


def _cell(name: str) -> str:
    """SQL text of a numeric column as double, NaN read as NULL."""
    return f"nanvl(CAST({quoted(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def unpivot(df: DataFrame, columns: Sequence[str], **extra: Sequence[float]) -> DataFrame:
    """(position, value) rows of numeric columns, NaN read as NULL.

    One grouped aggregate over this form stays one small compiled loop, where one
    aggregate per column and statistic outgrows code generation on wide tables.
    ``extra`` adds a constant per column.
    """
    rows = []
    for i, c in enumerate(columns):
        more = "".join(f", CAST('{values[i]!r}' AS DOUBLE) AS {name}" for name, values in extra.items())
        rows.append(f"struct({i} AS position, {_cell(c)} AS value{more})")
    return df.select(F.expr(f"inline(array({', '.join(rows)}))"))


def _named(columns: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, columns)), F.col("position") + 1).alias("column")


Quartiles = dict[tuple[str, float], float | None]


def numeric_stats(
    df: DataFrame, columns: Sequence[str] | None = None, quartiles: Quartiles | None = None
) -> DataFrame:
    """Distribution of each numeric column (4 decimals); all-null columns are left out.

    Quartiles are exact. The corrected moments and the counts come from one
    aggregate over all columns.
    """
    columns = list(columns or numeric_columns(df))
    quartiles = quartiles or exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    v = F.col("value")
    moments = unpivot(df, columns).groupBy("position").agg(
        F.count(v).alias("count"),
        F.round(F.avg(v), 4).alias("mean"),
        F.round(F.stddev_samp(v), 4).alias("std"),
        F.round(F.min(v), 4).alias("min"),
        F.round(F.max(v), 4).alias("max"),
        F.round(sample_skewness(v), 4).alias("skewness"),
        F.round(sample_kurtosis(v), 4).alias("kurtosis"),
        F.count_if(v == 0).alias("zeros"),
        F.count_if(v < 0).alias("negatives"),
    )
    places = [
        F.round(
            F.element_at(F.array(*[F.lit(quartiles[c, p]).cast("double") for c in columns]),
                         F.col("position") + 1),
            4,
        ).alias(name)
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ]
    named = moments.filter(F.col("count") > 0).select("*", _named(columns), *places)
    return named.select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max",
        "skewness", "kurtosis", "zeros", "negatives",
    )


def outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    multiplier: float = IQR_MULTIPLIER,
    quartiles: Quartiles | None = None,
) -> DataFrame:
    """Values strictly outside ``q1 - m*iqr .. q3 + m*iqr``, counted per column."""
    columns = list(columns or numeric_columns(df))
    quartiles = quartiles or exact_quantiles(df, columns, [0.25, 0.75])
    present = [c for c in columns if quartiles[c, 0.25] is not None]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "column string, outliers long, percent double, lower_bound double, upper_bound double"
        )
    low, high = [], []
    for c in present:
        q1, q3 = quartiles[c, 0.25], quartiles[c, 0.75]
        low.append(q1 - multiplier * (q3 - q1))
        high.append(q3 + multiplier * (q3 - q1))
    cells = unpivot(df, present, low=low, high=high).filter("value IS NOT NULL")
    outside = F.count_if((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
    return cells.groupBy("position").agg(
        outside.alias("outliers"),
        F.round(outside / F.count("value") * 100, 2).alias("percent"),
        F.round(F.first("low"), 4).alias("lower_bound"),
        F.round(F.first("high"), 4).alias("upper_bound"),
    ).select(_named(present), "outliers", "percent", "lower_bound", "upper_bound")


_GRAM = "pos_a int, pos_b int, n long, sum_a double, sum_b double, square_a double, square_b double, product double"
# Of the mean square: variances below it are rounding, the column is constant.
_FLAT = 1e-13


def _gram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums over the rows where both columns of a pair are set, for every ordered pair.

    A batch of rows is a matrix of values less the column means and a matrix of what is set;
    their products are the sums of all pairs at once, and only these leave a task.
    """
    values = df.select(*[clean(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(c).alias(c) for c in values.columns]).first()
    shift = np.array([0.0 if m is None else m for m in means])
    size = len(columns)

    def run(batches):
        total = None
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(size)]) - shift
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            sums, squares = x.T @ there, (x * x).T @ there
            new = np.array([there.T @ there, sums, sums.T, squares, squares.T, x.T @ x])
            total = new if total is None else total + new
        if total is not None:
            a, b = np.indices((size, size), dtype=np.int32).reshape(2, -1)
            flat = total.reshape(len(total), -1)
            names = [c.split()[0] for c in _GRAM.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, flat[0].astype(np.int64), *flat[1:])], names)

    parts = values.mapInArrow(run, _GRAM)
    return parts.groupBy("pos_a", "pos_b").agg(*[F.sum(c).alias(c) for c in parts.columns[2:]])


def _pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every ordered pair of columns, each with itself too."""

    def spread(side: str) -> Column:
        square = F.col(f"square_{side}") / F.col("n")
        mean = F.col(f"sum_{side}") / F.col("n")
        return F.when(square - mean * mean > _FLAT * square, square - mean * mean)

    covariance = F.col("product") / F.col("n") - F.col("sum_a") / F.col("n") * (F.col("sum_b") / F.col("n"))
    r = F.try_divide(covariance, F.sqrt(spread("a")) * F.sqrt(spread("b")))
    names = F.array(*map(F.lit, columns))
    return _gram(df, columns).select(
        "pos_a",
        "pos_b",
        F.element_at(names, F.col("pos_a") + 1).alias("column_a"),
        F.element_at(names, F.col("pos_b") + 1).alias("column_b"),
        F.when(F.col("n") > 0, F.round(r, 4)).alias("correlation"),
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation (4 decimals) of every column pair, on rows where both are set.

    One row per unordered pair with its schema positions; no rows below two numeric
    columns. A constant column has no correlation (NULL).
    """
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        return df.sparkSession.createDataFrame(
            [], "pos_a int, pos_b int, column_a string, column_b string, correlation double"
        )
    return _pair_correlations(df, columns).filter("pos_a < pos_b")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full square matrix in long form, with the diagonal."""
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        return correlations(df, columns).select("column_a", "column_b", "correlation")
    return _pair_correlations(df, columns).select("column_a", "column_b", "correlation")


def top_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` pairs with the largest absolute correlation, column order on ties."""
    return pairs.orderBy(F.abs("correlation").desc_nulls_last(), "pos_a", "pos_b").limit(n)


def _micros(df: DataFrame, time_column: str) -> Column:
    if isinstance(df.schema[time_column].dataType, T.TimestampNTZType):
        return clock_micros(F.col(quoted(time_column)))
    return F.unix_micros(F.col(quoted(time_column)).cast("timestamp"))


def gaps(
    df: DataFrame,
    time_column: str,
    keys: Sequence[str] = (),
    max_gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """Number of neighbouring timestamps more than ``max_gap_seconds`` apart.

    Two rows in one slot as wide as the threshold are never that far apart, so only
    the first and last timestamp of each slot matter and no row is sorted. Slots are
    compared inside eras of many slots first and eras after that, so that a long
    series without keys is not compared in one task.
    """
    keys = list(keys)
    width = max_gap_seconds * 1_000_000
    times = df.select(*keys, _micros(df, time_column).alias("_t")).filter("_t IS NOT NULL")
    slots = times.groupBy(*keys, F.expr(f"_t - pmod(_t, {width}L)").alias("_slot")).agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last")
    )
    slots = slots.withColumn("_era", F.expr(f"_slot - pmod(_slot, {width * _ERA_SLOTS}L)"))

    def wide(*scope: str, order: str) -> Column:
        previous = F.lag("_last").over(Window.partitionBy(*keys, *scope).orderBy(order))
        return F.col("_first") - previous > width

    inner = slots.withColumn("_wide", wide("_era", order="_slot"))
    eras = inner.groupBy(*keys, "_era").agg(
        F.count_if("_wide").alias("_gaps"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    between = eras.select(*keys, "_gaps", wide(order="_era").alias("_wide"))
    return between.groupBy(*keys).agg(
        (F.coalesce(F.sum("_gaps"), F.lit(0)) + F.count_if("_wide")).alias("gaps")
    )


def temporal(
    df: DataFrame, time_column: str, max_gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """One row: first and last timestamp, whole days between, frequency, gaps.

    ``frequency`` is a step of the calendar (see :func:`calendar_label`) or else the constant step
    as a multiple of D, h, min, s, ms or us; "irregular" without one, and NULL below three rows.
    """
    spark = df.sparkSession
    ts = F.col(f"`{time_column}`")
    times = df.select(ts.alias("_ts"), _micros(df, time_column).alias("_t")).filter(
        "_t IS NOT NULL"
    )
    month = F.year("_ts") * 12 + F.month("_ts") - 1
    time_of_day = F.pmod(F.col("_t"), F.lit(_DAY_MICROS))
    span = times.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_ts").alias("start"),
        F.max("_ts").alias("end"),
        F.min("_t").alias("lo"),
        F.max("_t").alias("hi"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
        (F.min(time_of_day) == F.max(time_of_day)).alias("daily"),
        F.bool_and(F.dayofmonth("_ts") == 1).alias("starts"),
        F.bool_and(F.col("_ts").cast("date") == F.last_day("_ts")).alias("ends"),
        F.bool_and(F.weekday("_ts") < 5).alias("workdays"),
    ).first()
    frequency = None
    if span["n"] >= 3:
        step, rest = divmod(span["hi"] - span["lo"], span["n"] - 1)
        months, odd = divmod(span["last_month"] - span["first_month"], span["n"] - 1)
        # n different timestamps on a grid of n places: regular.
        on_steps = F.lit(False) if rest or not step else (F.col("_t") - F.lit(span["lo"])) % F.lit(step) == 0
        on_months = F.lit(False) if odd or not months else (month - F.lit(span["first_month"])) % F.lit(months) == 0
        grid = times.agg(
            F.count_distinct("_t").alias("distinct"), F.bool_and(on_steps).alias("steps"), F.bool_and(on_months).alias("months")
        ).first()
        frequency = "irregular"
        if grid["distinct"] == span["n"]:
            named = calendar_label(span, step if grid["steps"] else None, months if grid["months"] else None)
            frequency = named or (step_label(step) if grid["steps"] else frequency)
    days = None if span["n"] == 0 else (span["hi"] - span["lo"]) // _DAY_MICROS
    schema = T.StructType(
        [
            T.StructField("start", df.schema[time_column].dataType),
            T.StructField("end", df.schema[time_column].dataType),
            T.StructField("duration_days", T.LongType()),
            T.StructField("frequency", T.StringType()),
            T.StructField("gaps", T.LongType()),
        ]
    )
    found = gaps(df, time_column, (), max_gap_seconds).first()["gaps"]
    return spark.createDataFrame(
        [(span["start"], span["end"], days, frequency, found)], schema
    )


_WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")
_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def calendar_label(span: Mapping[str, Any], step: int | None, months: int | None) -> str | None:
    """Name of a calendar step at one time of day, None where there is none.

    MS, QS and YS count months, quarters and years from the first day of a month, ME, QE and YE
    from the last one; quarters are named by the last month of the year that they begin or end in,
    years by their month. W names weeks by their day, and B is every Monday to Friday.
    """
    if not span["daily"]:
        return None
    if months and (span["starts"] or span["ends"]):
        side, at = ("S" if span["starts"] else "E"), span["first_month"] % 12
        if months % 12 == 0:
            return _counted(months // 12, f"Y{side}-{_MONTHS[at]}")
        if months % 3 == 0:
            return _counted(months // 3, f"Q{side}-{_MONTHS[9 + at % 3]}")
        return _counted(months, f"M{side}")
    start = span["lo"] // _DAY_MICROS
    if step and step % (7 * _DAY_MICROS) == 0:
        return _counted(step // (7 * _DAY_MICROS), f"W-{_WEEKDAYS[(start + 3) % 7]}")  # 1970-01-01 was a Thursday
    days = [d for d in range(7) if (start + d + 3) % 7 < 5]
    length = (span["hi"] - span["lo"]) // _DAY_MICROS + 1
    working = length // 7 * 5 + sum(d < length % 7 for d in days)
    if not step and span["workdays"] and working == span["n"]:
        return "B"
    return None


def _counted(count: int, name: str) -> str:
    return name if count == 1 else f"{count}{name}"


def step_label(micros: int) -> str:
    """Name of a constant time step: the largest unit that divides it."""
    units = [
        ("D", _DAY_MICROS),
        ("h", 3_600_000_000),
        ("min", 60_000_000),
        ("s", 1_000_000),
        ("ms", 1_000),
        ("us", 1),
    ]
    for name, size in units:
        if micros % size == 0:
            count = micros // size
            return name if count == 1 else f"{count}{name}"
    raise ValueError(f"not a time step: {micros}")


def report(df: DataFrame, time_column: str | None = None, top: int = 10) -> DataFrame:
    """The whole profile as (section, column, other, measure, value, text) rows."""

    def long(frame: DataFrame, section: str, column, other, measures: Sequence[str]) -> DataFrame:
        types = dict(frame.dtypes)
        entries = []
        for m in measures:
            textual = types[m] not in ("bigint", "int", "double")
            entries.append(
                F.struct(
                    F.lit(m).alias("measure"),
                    (F.lit(None) if textual else F.col(m)).cast("double").alias("value"),
                    (F.col(m) if textual else F.lit(None)).cast("string").alias("text"),
                )
            )
        return frame.select(
            F.lit(section).alias("section"),
            column.cast("string").alias("column"),
            other.cast("string").alias("other"),
            F.inline(F.array(*entries)),
        )

    name, none = F.col("column"), F.lit(None)
    quartiles = exact_quantiles(df, numeric_columns(df), [0.25, 0.5, 0.75])
    parts = [
        long(shape(df), "shape", name, none, ["dtype", "row_count", "column_count"]),
        long(missing(df), "missing", name, none, ["missing", "percent"]),
        long(
            numeric_stats(df, quartiles=quartiles), "numeric", name, none,
            ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "skewness",
             "kurtosis", "zeros", "negatives"],
        ),
        long(
            outliers(df, quartiles=quartiles), "outliers", name, none,
            ["outliers", "percent", "lower_bound", "upper_bound"],
        ),
        long(
            top_pairs(correlations(df), top), "top_pairs",
            F.col("column_a"), F.col("column_b"), ["correlation"],
        ),
    ]
    if time_column is not None:
        parts.append(
            long(
                temporal(df, time_column), "temporal", F.lit(time_column), none,
                ["start", "end", "duration_days", "frequency", "gaps"],
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
