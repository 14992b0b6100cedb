"""Temporal splits and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.functions.columns import as_long, clean
from tidewatch.plans.selection import before, row_positions


def temporal_split(
    df: DataFrame, order_by: Sequence[str], test_size: float = presets.TEST_SIZE
) -> tuple[DataFrame, DataFrame]:
    """First ``int(n * (1 - test_size))`` rows in time order, and the rest.

    The split point is found by counting, so both parts are filters on the order
    columns that reach the scan. Rows without an order value come first.
    """
    rows, keys, n = _null_first(df, order_by)
    cut = int(n * (1 - test_size))
    if cut <= 0:
        return df.limit(0), df
    if cut >= n:
        return df, df.limit(0)
    (position,) = row_positions(rows, keys, [cut])
    earlier = before(rows, keys, position)
    return rows.filter(earlier).select(df.columns), rows.filter(~earlier).select(df.columns)


def _null_first(df: DataFrame, order_by: Sequence[str]) -> tuple[DataFrame, list[str], int]:
    """``df`` with order columns that have no NULL, their names, and the row count.

    Only where a NULL occurs are the columns replaced by numbers of the same order, NULL
    the least; otherwise they stay as they are and filters on them reach the scan.
    """
    holes = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"h{i}") for i, c in enumerate(order_by)]
    n, *nulls = df.agg(F.count(F.lit(1)).alias("n"), *holes).first()
    if not any(nulls):
        return df, list(order_by), n
    names = [f"_order_{i}" for i in range(len(order_by))]
    numbers = [
        F.coalesce(as_long(df, c), F.lit(-(1 << 63))).alias(name)
        for c, name in zip(order_by, names)
    ]
    return df.select("*", *numbers), names, n


def fold_bounds(n: int, folds: int = presets.CV_FOLDS) -> list[tuple[int, int]]:
    """(first, last+1) test rows of each expanding-window fold over ``n`` rows."""
    size = n // (folds + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    starts = [n - (folds - i) * size for i in range(folds)]
    return [(s, s + size) for s in starts]


def expanding_folds(
    df: DataFrame, order_by: Sequence[str], folds: int = presets.CV_FOLDS
) -> list[tuple[DataFrame, DataFrame]]:
    """(train, test) pairs: each test block follows all of its training rows.

    Rows without an order value come first.
    """
    rows, keys, n = _null_first(df, order_by)
    bounds = fold_bounds(n, folds)
    cuts = sorted({s for s, _ in bounds} | {e for _, e in bounds if e < n})
    positions = dict(zip(cuts, row_positions(rows, keys, cuts)))
    pairs = []
    for start, end in bounds:
        earlier = before(rows, keys, positions[start])
        test = rows.filter(~earlier)
        if end < n:
            test = test.filter(before(rows, keys, positions[end]))
        pairs.append((rows.filter(earlier).select(df.columns), test.select(df.columns)))
    return pairs


def fold_blocks(
    df: DataFrame, order_by: Sequence[str], folds: int = presets.CV_FOLDS, name: str = "_block"
) -> DataFrame:
    """``df`` with the number of the fold that tests each row, -1 for rows before all of them.

    The rows that a fold trains on are those of the blocks before its own.
    """
    rows, keys, n = _null_first(df, order_by)
    starts = [start for start, _ in fold_bounds(n, folds)]
    block = F.lit(-1)
    for position in row_positions(rows, keys, starts):
        block = block + (~before(rows, keys, position)).cast("int")
    return rows.withColumn(name, block).select(*df.columns, name)


def regression_metrics(
    df: DataFrame, actual: str, prediction: str, keys: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R2 (4 decimals) in one aggregate.

    A constant target gives R2 = 1 for perfect predictions and 0 otherwise. Rows whose
    target or prediction is NULL or NaN do not count.
    """
    y = F.col(actual)
    e = y - F.col(prediction)
    squared = F.sum(e * e)
    spread = F.var_pop(y) * F.count(y)
    constant = F.min(y) == F.max(y)
    r2 = F.when(constant, F.when(squared == 0, 1.0).otherwise(0.0)).otherwise(
        1 - F.try_divide(squared, spread)
    )
    known = clean(df, actual).isNotNull() & clean(df, prediction).isNotNull()
    return df.filter(known).groupBy(*keys).agg(
        F.round(F.avg(F.abs(e)), 4).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"),
        F.round(r2, 4).alias("r2"),
    )
