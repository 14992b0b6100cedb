"""Table-level and row-level validation.

Every table-level check reads one shared aggregate row, so a validation costs one
scan whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.functions import normalise_missing, numeric_columns

FINDING = "check string, column string, severity string, message string, observed double, threshold double"

# Message texts.
EMPTY_TEXT = "DataFrame is empty"
MISSING_TEXT = "Missing required columns: {columns}"
NULLS_TEXT = "Column '{column}' has %.1f%% nulls (threshold: %.1f%%)"
ALL_NULL_TEXT = "Column '{column}' is entirely null"
RANGE_TEXT = "Column '{column}' out of range: [%.4f, %.4f] vs expected [%.4f, %.4f]"
FAILED_TEXT = "Validation failed: {errors}"


class ValidationError(ValueError):
    """Raised by :func:`require_valid` for a table with validation errors."""


def null_report(df: DataFrame) -> DataFrame:
    """Null count and fraction (4 decimals) per column; NaN counts as null.

    The fraction is 0 in an empty table.
    """
    row = _summary(df, {})
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"nulls_{i}").alias("null_count"),
                        F.coalesce(
                            F.round(F.try_divide(F.col(f"nulls_{i}"), F.col("rows")), 4), F.lit(0.0)
                        ).alias("null_fraction"),
                    )
                    for i, c in enumerate(df.columns)
                ]
            )
        )
    )


def _summary(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row: row count, nulls per column, min and max per range rule."""
    data = normalise_missing(df)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        aggregates.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}"))
    for i, c in enumerate(ranges):
        value = F.col(f"`{c}`").cast("double")
        aggregates += [F.min(value).alias(f"min_{i}"), F.max(value).alias(f"max_{i}")]
    return data.agg(*aggregates)


def _finding(
    check: str, column: str, severity: str, message: Column, observed: Column, threshold: Column
) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        observed.cast("double").alias("observed"),
        threshold.cast("double").alias("threshold"),
    )


def findings(
    df: DataFrame,
    required: Sequence[str] = (),
    max_null_fraction: float = presets.MAX_NULL_FRACTION,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One row per broken rule.

    An empty table yields the single error "DataFrame is empty". Otherwise missing
    required columns and entirely null columns are errors; a null fraction above
    the threshold and values outside a range are warnings. Range rules on absent
    or non-numeric columns are skipped.
    """
    numeric = set(numeric_columns(df))
    rules = {c: r for c, r in (ranges or {}).items() if c in numeric}
    has_rows = F.col("rows") > 0
    none = F.lit(None)
    checks = [
        F.when(
            ~has_rows,
            _finding("empty", "", "error", F.lit(EMPTY_TEXT), F.col("rows"), none),
        )
    ]
    missing = sorted(set(required) - set(df.columns))
    if missing:
        text = F.lit(MISSING_TEXT.format(columns=", ".join(missing)))
        checks.append(
            F.when(
                has_rows,
                _finding("required", ",".join(missing), "error", text, F.lit(len(missing)), none),
            )
        )
    for i, c in enumerate(df.columns):
        fraction = F.try_divide(F.col(f"nulls_{i}"), F.col("rows"))
        text = F.format_string(
            NULLS_TEXT.format(column=c.replace("%", "%%")),
            fraction * 100,
            F.lit(max_null_fraction * 100.0),
        )
        checks.append(
            F.when(
                has_rows & (fraction > max_null_fraction),
                _finding("nulls", c, "warning", text, F.round(fraction, 4), F.lit(max_null_fraction)),
            )
        )
        checks.append(
            F.when(
                has_rows & (F.col(f"nulls_{i}") == F.col("rows")),
                _finding(
                    "all_null", c, "error", F.lit(ALL_NULL_TEXT.format(column=c)),
                    F.lit(1.0), F.lit(1.0),
                ),
            )
        )
    for i, (c, (low, high)) in enumerate(rules.items()):
        smallest, largest = F.col(f"min_{i}"), F.col(f"max_{i}")
        text = F.format_string(
            RANGE_TEXT.format(column=c.replace("%", "%%")),
            smallest, largest, F.lit(float(low)), F.lit(float(high)),
        )
        below = smallest < low
        checks.append(
            F.when(
                has_rows & (below | (largest > high)),
                _finding(
                    "range", c, "warning", text,
                    F.when(below, smallest).otherwise(largest),
                    F.when(below, F.lit(float(low))).otherwise(F.lit(float(high))),
                ),
            )
        )
    return _summary(df, rules).select(F.inline(F.array_compact(F.array(*checks))))


def verdict(
    df: DataFrame,
    required: Sequence[str] = (),
    max_null_fraction: float = presets.MAX_NULL_FRACTION,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One row: row and column count, error and warning count, ``is_valid``."""
    numeric = set(numeric_columns(df))
    rules = {c: r for c, r in (ranges or {}).items() if c in numeric}
    has_rows = F.col("rows") > 0
    errors = F.when(~has_rows, 1).otherwise(int(bool(set(required) - set(df.columns))))
    warnings = F.lit(0)
    for i, _ in enumerate(df.columns):
        nulls = F.col(f"nulls_{i}")
        errors = errors + (has_rows & (nulls == F.col("rows"))).cast("int")
        over = F.try_divide(nulls, F.col("rows")) > max_null_fraction
        warnings = warnings + F.coalesce(over, F.lit(False)).cast("int")
    for i, (low, high) in enumerate(rules.values()):
        outside = (F.col(f"min_{i}") < low) | (F.col(f"max_{i}") > high)
        warnings = warnings + F.coalesce(outside, F.lit(False)).cast("int")
    return _summary(df, rules).select(
        F.col("rows").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        errors.alias("error_count"),
        warnings.alias("warning_count"),
        (errors == 0).alias("is_valid"),
    )


def require_valid(df: DataFrame, **rules) -> None:
    """Raise :class:`ValidationError` listing the errors of ``df``, if any."""
    # At most two errors per column, so this collect is bounded by the schema.
    errors = findings(df, **rules).filter("severity = 'error'").select("message").collect()
    if errors:
        raise ValidationError(
            FAILED_TEXT.format(errors="; ".join(r["message"] for r in errors))
        )


def check_rows(
    df: DataFrame,
    limits: Mapping[str, tuple[float | None, float | None]] = presets.REQUEST_LIMITS,
    defaults: Mapping[str, float] = presets.REQUEST_DEFAULTS,
) -> DataFrame:
    """Append ``accepted`` and ``reasons`` to every row.

    Columns in ``defaults`` are filled when null; all other limited columns are
    required. Limits are inclusive.
    """
    data = normalise_missing(df)
    for c, value in defaults.items():
        data = data.withColumn(c, F.coalesce(F.col(c), F.lit(value)))
    reasons = []
    for c, (low, high) in limits.items():
        value = F.col(f"`{c}`")
        reasons.append(F.when(value.isNull(), F.lit(f"{c}: missing")))
        if low is not None:
            reasons.append(F.when(value < low, F.lit(f"{c}: below {low:g}")))
        if high is not None:
            reasons.append(F.when(value > high, F.lit(f"{c}: above {high:g}")))
    checked = data.withColumn("reasons", F.array_compact(F.array(*reasons)))
    return checked.withColumn("accepted", F.size("reasons") == 0)
