"""Row numbers and look-back windows without a single-partition sort.

Spark evaluates ``Window.orderBy`` without ``partitionBy`` in one task, and gives a
key that holds a third of the table one task too. The functions here split the
order itself into ranges, so every task stays the same size whatever the keys are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import as_long, is_ordinal
from tidewatch.plans.staging import stage

# A key with more rows than this is windowed in blocks instead of in one task.
HOT_KEY_ROWS = 1_000_000
# Rows per block of a blocked window; far above any look-back, far below task memory.
BLOCK_ROWS = 2_000_000
# Cuts that a series gets before its blocks grow to BLOCK_ROWS, and that it may get after that; the
# driver and each task hold all cuts, so they do not grow with the rows while blocks are small.
FEW_BLOCKS = 1_000
MAX_BLOCKS = 50_000
# Whole numbers below this have an exact double.
_EXACT = float(1 << 53)

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _number(df: DataFrame, label: str) -> DataFrame:
    """Freeze ``df`` with its partition number ``_pid`` and row number ``_pos`` in it."""
    frozen = stage(df.select("*", F.monotonically_increasing_id().alias("_mid")), label)
    return frozen.select(
        *df.columns,
        F.shiftright("_mid", _ROW_BITS).cast("int").alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_pos"),
    )


def _add_offsets(numbered: DataFrame, index: str) -> DataFrame:
    """Turn (``_pid``, ``_pos``) into one dense 0-based ``index``."""
    spark = numbered.sparkSession
    sizes = numbered.groupBy("_pid").agg((F.max("_pos") + 1).alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_pid"]):
        offsets.append((row["_pid"], total))
        total += row["n"]
    if not offsets:
        return numbered.withColumn(index, F.col("_pos")).drop("_pid", "_pos")
    # One row per shuffle partition, so the broadcast side cannot grow with the data.
    table = spark.createDataFrame(offsets, "_pid int, _offset long")
    return numbered.join(F.broadcast(table), "_pid").select(
        *[c for c in numbered.columns if c not in ("_pid", "_pos")],
        (F.col("_offset") + F.col("_pos")).alias(index),
    )


def chunked(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``df`` split into sorted ranges of ``order_by``.

    Adds ``_pid`` (range number, increasing with the order) and ``_pos`` (0-based
    position inside the range). The split is frozen in a staged table.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return _number(ranged, "chunked")


def row_index(df: DataFrame, order_by: Sequence[str], index: str = "row_idx") -> DataFrame:
    """Global 0-based row number in ``order_by`` order; ``order_by`` must be unique."""
    return _add_offsets(chunked(df, order_by), index)


def dense_index(df: DataFrame, index: str = "row_idx") -> DataFrame:
    """Global 0-based row number in no particular order; needs no shuffle."""
    return _add_offsets(_number(df, "dense"), index)


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    history: int,
    build: Callable[[WindowSpec], list[Column]],
    hot_rows: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Append window columns that look back at most ``history`` rows.

    ``build`` receives an ordered window spec and returns the columns to append.
    Keys below ``hot_rows`` rows share one hash shuffle. Hotter keys, and a series
    without keys, are cut into blocks of about ``block_rows``; each block carries at
    least the last ``history`` rows before it, so no window reaches outside its block.
    """
    hot_rows = HOT_KEY_ROWS if hot_rows is None else hot_rows
    block_rows = max(BLOCK_ROWS if block_rows is None else block_rows, history + 1)
    keys, order_by = list(keys), list(order_by)

    def windowed(rows: DataFrame, axis: Column | None, n: int) -> DataFrame:
        cut = None if axis is None else _cut_along(rows, axis, n, keys, order_by, history, build, block_rows)
        rows = rows.select(df.columns)
        return _blocked(rows, keys, order_by, history, build, block_rows) if cut is None else cut

    time = order_by[0]
    clocked = is_ordinal(df, time)
    at = as_long(df, time).cast("double") if clocked else F.lit(None).cast("double")
    if not keys:
        return windowed(df, at if clocked else None, df.count() if clocked else 0)

    # At most rows / hot_rows keys can be hot, which bounds this collect.
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_low"), F.max(at).alias("_high")
    )
    hot = sizes.filter(F.col("_n") > hot_rows).orderBy(*keys).collect()
    if not hot:
        return df.select("*", *build(Window.partitionBy(*keys).orderBy(*order_by)))
    schema = T.StructType(
        [T.StructField(f"_hot_{k}", df.schema[k].dataType) for k in keys]
        + [T.StructField("_start", T.DoubleType()), T.StructField("_low", T.DoubleType())]
    )
    # Hot keys follow each other on one axis, so they are cut together: a block, and the rows
    # carried into it, may reach over the end of a key, and windows do not.
    places, start = [], 0.0
    for row in hot:
        places.append((*[row[k] for k in keys], start, row["_low"]))
        start += (row["_high"] or 0.0) - (row["_low"] or 0.0) + 1
    table = F.broadcast(df.sparkSession.createDataFrame(places, schema))
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    cold = df.join(table, match, "left_anti")
    parts = [cold.select("*", *build(Window.partitionBy(*keys).orderBy(*order_by)))]
    rows = df.join(table, match).select(*df.columns, (F.col("_start") + at - F.col("_low")).alias("_axis"))
    exact = clocked and start < _EXACT and all(row["_low"] is not None for row in hot)
    parts.append(windowed(rows, F.col("_axis") if exact else None, sum(row["_n"] for row in hot)))
    names = parts[0].columns
    return reduce(DataFrame.unionByName, [p.select(names) for p in parts])


def _cut_along(
    df: DataFrame,
    axis: Column,
    n: int,
    keys: list[str],
    order_by: list[str],
    history: int,
    build: Callable[[WindowSpec], list[Column]],
    block_rows: int,
) -> DataFrame | None:
    """Blocks cut at values of a numeric axis: one shuffle, nothing staged.

    ``axis`` grows with the order of the rows. Returns None for a series that this
    cannot cut: one too short, or one with so many rows at an instant that a block
    would outgrow its task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = max(min(block_rows, n // tasks), 50 * history, min(n // FEW_BLOCKS, BLOCK_ROWS), n // MAX_BLOCKS, 1)
    blocks = n // rows
    if blocks < 2:
        return None

    # A sample proposes block starts and, a tenth of a block earlier, where the carried
    # rows start. A pass over all rows counts what lies between before any is used.
    times = df.select(axis.alias("_t"))
    wanted = 100 * blocks
    source = times if n <= max(wanted, 1_000_000) else times.sample(wanted / n, seed=11)
    places = [x for j in range(1, blocks) for x in ((j - 0.1) / blocks, j / blocks)]
    found = source.agg(F.percentile_approx("_t", places, 100 * blocks)).first()[0] or []
    pairs = []
    for carry, start in zip(found[::2], found[1::2]):
        if carry < start and (not pairs or pairs[-1][1] < carry):
            pairs.append((carry, start))
    if not pairs:
        return None
    sizes = dict(_segment(times, pairs).groupBy("_segment").count().collect())
    if sum(sizes.values()) < n:
        return None  # rows without a time
    kept, size = [], sizes.get(0.0, 0)
    for j, pair in enumerate(pairs):
        carried, own = sizes.get(2.0 * j + 1, 0), sizes.get(2.0 * j + 2, 0)
        size += carried
        if carried >= history:
            kept.append(pair)
            if size > 4 * max(rows, block_rows):
                return None
            size = 0
        size += own
    if not kept or size > 4 * max(rows, block_rows):
        return None

    cut = _segment(df.select("*", axis.alias("_t")), kept)
    segment = F.col("_segment").cast("int")
    own = F.struct(F.floor(segment / 2).cast("int").alias("_blk"), F.lit(False).alias("_carried"))
    carried = F.struct(((segment + 1) / 2).cast("int").alias("_blk"), F.lit(True).alias("_carried"))
    copies = F.when(segment % 2 == 1, F.array(own, carried)).otherwise(F.array(own))
    window = Window.partitionBy("_blk", *keys).orderBy(*order_by)
    spread = cut.select(*df.columns, F.inline(copies))
    whole = spread.select("*", *build(window)).filter(~F.col("_carried"))
    return whole.drop("_blk", "_carried", "_axis")


def _segment(df: DataFrame, pairs: list[tuple[float, float]]) -> DataFrame:
    """Append ``_segment``: 2j inside block j, 2j+1 for its last rows, carried to the next."""
    splits = [-math.inf, *[x for pair in pairs for x in pair], math.inf]
    return Bucketizer(
        splits=splits, inputCol="_t", outputCol="_segment", handleInvalid="skip"
    ).transform(df)


def _blocked(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    history: int,
    build: Callable[[WindowSpec], list[Column]],
    block_rows: int,
) -> DataFrame:
    indexed = row_index(df, keys + order_by, "_idx")
    block = F.floor(F.col("_idx") / F.lit(block_rows))
    in_tail = F.col("_idx") % F.lit(block_rows) >= F.lit(block_rows - history)
    own = F.struct(block.alias("_blk"), F.lit(False).alias("_carried"))
    carried = F.struct((block + 1).alias("_blk"), F.lit(True).alias("_carried"))
    copies = F.when(in_tail, F.array(own, carried)).otherwise(F.array(own))
    spread = indexed.select("*", F.inline(copies))
    window = Window.partitionBy("_blk", *keys).orderBy("_idx")
    return (
        spread.select("*", *build(window))
        .filter(~F.col("_carried"))
        .drop("_idx", "_blk", "_carried")
    )
