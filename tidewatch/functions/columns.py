"""Missing-value handling and schema inspection."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Column name for use in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def floating_columns(df: DataFrame) -> list[str]:
    """Names of the float and double columns, in schema order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]


def clean(df: DataFrame, name: str) -> Column:
    """Column ``name`` with NaN read as NULL; other types pass unchanged."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None).cast(df.schema[name].dataType)).alias(name)
    return column


def normalise_missing(df: DataFrame) -> DataFrame:
    """All columns with NaN read as NULL, in one projection."""
    if not floating_columns(df):
        return df
    return df.select(*[clean(df, c) for c in df.columns])


def clock_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp without time zone.

    Built from the calendar fields, so the session time zone plays no part.
    """
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (
        F.unix_date(ts.cast("date")).cast("long") * 86_400_000_000
        + F.hour(ts).cast("long") * 3_600_000_000
        + F.minute(ts).cast("long") * 60_000_000
        + (seconds * 1_000_000).cast("long")
    )


def clock_instant(ts: Column) -> Column:
    """The clock time read as UTC; watermarks take no timestamp without time zone."""
    return F.timestamp_micros(clock_micros(ts))


def instant_clock(instant: Column) -> Column:
    """Inverse of :func:`clock_instant`."""
    micros = F.unix_micros(instant)
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def clock(moment: datetime | None) -> Column:
    """A naive datetime as a timestamp without time zone.

    Goes through text: a datetime literal would pass through the session time zone.
    """
    return F.lit(None if moment is None else str(moment)).cast("timestamp_ntz")


def is_ordinal(df: DataFrame, name: str) -> bool:
    """Whether :func:`as_long` keeps the order of the column."""
    kinds = (T.TimestampNTZType, T.TimestampType, T.DateType, T.IntegralType)
    return isinstance(df.schema[name].dataType, kinds)


def as_long(df: DataFrame, name: str) -> Column:
    """Order column as a number; text, which may only break ties, by its hash."""
    kind = df.schema[name].dataType
    column = F.col(quoted(name))
    if isinstance(kind, T.TimestampNTZType):
        return clock_micros(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, T.StringType):
        return F.xxhash64(column)
    raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
