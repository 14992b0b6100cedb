"""Exact order statistics by narrowing value brackets.

``percentile`` keeps every distinct value of a column in one task. Here a sketch
proposes a bracket of values around each wanted rank, and one more pass counts the
rows below the bracket and each distinct value inside it. Those counts prove where
the rank lies, so the result is exact; a bracket that missed its rank is widened and
tried again. Only counts of a few values per bracket are shuffled.

A sketch of every scan task meets the others in one reducer, which thousands of tasks
would swamp. On large input the sketch therefore reads a sample. That changes how
wide the brackets come out and nothing else: all rows are counted against them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import as_long, clean, is_ordinal, quoted

# Brackets expected to hold more rows than this are narrowed before they are sorted.
SORT_ROWS = 1_000_000
# Input of at most this many bytes is sketched whole, larger input from so many rows.
SKETCH_BYTES = 8 << 30
SAMPLE_ROWS = 4_000_000
_ACCURACY = 10_000


@dataclass
class OrderStatistic:
    """Value at a rank, with the rows strictly below it and the rows equal to it."""

    value: Any
    below: int
    equal: int


@dataclass
class _Bracket:
    """Values ``low..high`` of a column, thought to hold all of ``ranks``."""

    column: str
    ranks: list[int]
    total: int
    low: Any = None  # None: the whole column
    high: Any = None
    expected: float = math.inf  # rows inside, from the sketch's error bound
    slack: float = 0.0  # error bound of the sketch, as a fraction of its values
    found: dict[int, OrderStatistic] = field(default_factory=dict)

    @property
    def value(self) -> Column:
        return F.col(f"`{self.column}`")

    def fractions(self, offset: int, rows: int) -> list[float]:
        """Where the sketch of ``rows`` values should look, ``offset`` rows lying below them."""
        first = (min(self.ranks) - offset) / rows - self.slack
        last = (max(self.ranks) + 1 - offset) / rows + self.slack
        return [min(1.0, max(0.0, first)), min(1.0, max(0.0, last))]


def _is_small(df: DataFrame) -> bool:
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= SKETCH_BYTES


def _slack(whole: bool) -> float:
    """Error bound of the sketch; four standard errors of a median for a sample."""
    return 2.0 / _ACCURACY + (0.0 if whole else 2.0 / math.sqrt(SAMPLE_ROWS))


def _sampled(df: DataFrame, rows: int, whole: bool) -> DataFrame:
    """``df``, or a sample with SAMPLE_ROWS of the ``rows`` of interest."""
    if whole or rows <= SAMPLE_ROWS:
        return df
    return df.sample(SAMPLE_ROWS / rows, seed=11)


def _sketch(value: Column, fractions: list[float]) -> Column:
    return F.percentile_approx(value, fractions, _ACCURACY)


def _propose(df: DataFrame, brackets: list[_Bracket], whole: bool) -> None:
    """Set the brackets from one sketch per column."""
    columns = list(dict.fromkeys(b.column for b in brackets))
    spots: dict[str, list[float]] = {c: [] for c in columns}
    for b in brackets:
        b.slack = b.slack or _slack(whole)
        spots[b.column] += b.fractions(0, b.total)
    source = _sampled(df, min(b.total for b in brackets), whole)
    row = source.agg(
        *[_sketch(F.col(f"`{c}`"), spots[c]).alias(f"s{i}") for i, c in enumerate(columns)]
    ).first()
    ends = {c: iter(row[f"s{i}"] or ()) for i, c in enumerate(columns)}
    for b in brackets:
        b.low, b.high = next(ends[b.column], None), next(ends[b.column], None)
        b.expected = 2 * b.slack * b.total if b.low is not None else b.total


def _literal(value: Any, kind: T.DataType) -> str:
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    if isinstance(kind, T.LongType):
        return f"CAST('{value}' AS BIGINT)"
    return f"CAST('{value!r}' AS DOUBLE)"


def _segments(df: DataFrame, brackets: list[_Bracket]) -> tuple[DataFrame, list[str]]:
    """(position, value, segment) cells of the bracketed columns, and those columns.

    The disjoint brackets of a column cut its values into segments: an odd segment
    is a bracket, an even one lies between brackets. Overlapping brackets are merged.
    """
    columns = list(dict.fromkeys(b.column for b in brackets))
    lowest, highest = -math.inf, math.inf
    if isinstance(df.schema[columns[0]].dataType, T.LongType):
        lowest, highest = -(1 << 63), (1 << 63) - 1
    cuts: list[list[tuple[Any, Any]]] = []
    for c in columns:
        own = [b for b in brackets if b.column == c]
        for b in own:
            if b.low is None:
                b.low, b.high = lowest, highest
        merged: list[tuple[Any, Any]] = []
        for low, high in sorted((b.low, b.high) for b in own):
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        for b in own:
            b.low, b.high = next(m for m in merged if m[0] <= b.low and b.high <= m[1])
        cuts.append(merged)

    depth = max(map(len, cuts))
    kind = df.schema[columns[0]].dataType
    entries = []
    for i, c in enumerate(columns):
        ends = "".join(
            f", {_literal(low, kind)} AS l{j}, {_literal(high, kind)} AS h{j}"
            for j, (low, high) in enumerate(cuts[i] + [(None, None)] * (depth - len(cuts[i])))
        )
        entries.append(f"struct({i} AS position, {quoted(c)} AS value{ends})")
    cells = df.select(F.expr(f"inline(array({', '.join(entries)}))")).filter("value IS NOT NULL")
    steps = " + ".join(
        f"CASE WHEN value >= l{j} THEN 1 ELSE 0 END + CASE WHEN value > h{j} THEN 1 ELSE 0 END"
        for j in range(depth)
    )
    steps = F.expr(steps)
    return cells.select("position", "value", steps.alias("segment")), columns


def _narrow(df: DataFrame, brackets: list[_Bracket], whole: bool) -> None:
    """Count the brackets, then sketch again inside each of them."""
    cells, columns = _segments(df, brackets)
    sizes = {
        (r["position"], r["segment"]): r["n"]
        for r in cells.groupBy("position", "segment").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    lows = {c: sorted({b.low for b in brackets if b.column == c}) for c in columns}
    usable = []
    for b in brackets:
        i = columns.index(b.column)
        segment = 2 * lows[b.column].index(b.low) + 1
        below = sum(n for (p, s), n in sizes.items() if p == i and s < segment)
        inside = sizes.get((i, segment), 0)
        if below <= min(b.ranks) and max(b.ranks) < below + inside:
            usable.append((b, below, inside))
        else:
            _widen(df, b, whole)
    if not usable:
        return
    source = _sampled(df, min(inside for _, _, inside in usable), whole)
    row = source.agg(
        *[
            _sketch(
                F.when(b.value.between(F.lit(b.low), F.lit(b.high)), b.value),
                b.fractions(below, inside),
            ).alias(f"s{i}")
            for i, (b, below, inside) in enumerate(usable)
        ]
    ).first()
    for i, (b, _, inside) in enumerate(usable):
        expected = 2 * b.slack * inside
        if row[i] is None or (b.low, b.high) == tuple(row[i]) or expected >= b.expected:
            b.expected = 0  # few distinct values: nothing left to narrow
            continue
        (b.low, b.high), b.expected = row[i], expected


def _widen(df: DataFrame, bracket: _Bracket, whole: bool) -> None:
    """Try again with more slack; from the whole column the result cannot be missed."""
    bracket.slack *= 8
    if bracket.slack >= 1:
        bracket.low = bracket.high = None
        bracket.expected = 0
    else:
        _propose(df, [bracket], whole)


def _tally(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Count rows between brackets and per value inside them; look the ranks up."""
    cells, columns = _segments(df, brackets)
    inside = F.col("segment") % 2 == 1
    counted = cells.groupBy(
        "position", "segment", F.when(inside, F.col("value")).alias("value")
    ).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("position").orderBy("segment", "value")
    running = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("first", running - F.col("n"))
    ranks = [sorted({r for b in brackets if b.column == c for r in b.ranks}) for c in columns]
    wanted = F.element_at(
        F.array(*[F.array(*map(F.lit, r)).cast("array<long>") for r in ranks]),
        F.col("position") + 1,
    )
    holds_rank = F.exists(
        wanted, lambda r: (F.col("first") <= r) & (r < F.col("first") + F.col("n"))
    )
    # At most one row per wanted rank.
    for row in ranked.filter(inside & holds_rank).collect():
        for b in brackets:
            if b.column == columns[row["position"]]:
                for rank in b.ranks:
                    if row["first"] <= rank < row["first"] + row["n"]:
                        b.found[rank] = OrderStatistic(row["value"], row["first"], row["n"])


def _resolve(df: DataFrame, brackets: list[_Bracket], sort_rows: int, whole: bool) -> None:
    while True:
        pending = [b for b in brackets if len(b.found) < len(set(b.ranks))]
        if not pending:
            return
        wide = [b for b in pending if b.expected > sort_rows]
        if wide:
            _narrow(df, wide, whole)
            continue
        _tally(df, pending)
        for b in pending:
            if len(b.found) < len(set(b.ranks)):
                b.found.clear()
                _widen(df, b, whole)


def _brackets(column: str, ranks: Sequence[int], total: int) -> list[_Bracket]:
    """One bracket per run of neighbouring ranks."""
    groups: list[list[int]] = []
    for rank in sorted(set(ranks)):
        if groups and rank - groups[-1][-1] <= 1:
            groups[-1].append(rank)
        else:
            groups.append([rank])
    return [_Bracket(column, g, total) for g in groups]


def order_statistics(
    df: DataFrame, column: str, ranks: Sequence[int], sort_rows: int | None = None
) -> list[OrderStatistic]:
    """Exact values at 0-based ``ranks`` among the non-null values of a numeric column."""
    if not ranks:
        return []
    df = df.select(F.col(f"`{column}`"))
    total = df.agg(F.count(F.col(f"`{column}`"))).first()[0]
    for rank in ranks:
        if not 0 <= rank < total:
            raise IndexError(f"rank {rank} is outside the {total} values of {column}")
    brackets = _brackets(column, ranks, total)
    whole = _is_small(df)
    _propose(df, brackets, whole)
    _resolve(df, brackets, SORT_ROWS if sort_rows is None else sort_rows, whole)
    found = {rank: stat for b in brackets for rank, stat in b.found.items()}
    return [found[rank] for rank in ranks]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    sort_rows: int | None = None,
) -> dict[tuple[str, float], float | None]:
    """Exact linearly interpolated quantiles of several columns at once.

    Two passes over the columns unless a bracket has to be narrowed. NaN counts as
    missing. A column without values gets None.
    """
    columns, probabilities = list(columns), list(probabilities)
    if not columns:
        return {}
    values = df.select(*[clean(df, c).cast("double").alias(c) for c in columns])
    whole = _is_small(values)
    slack = _slack(whole)
    spots = [x for p in probabilities for x in (max(0.0, p - slack), min(1.0, p + slack))]
    tallies = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)]
    sketches = [_sketch(F.col(f"`{c}`"), spots).alias(f"s{i}") for i, c in enumerate(columns)]
    if whole:
        first = sketched = values.agg(*tallies, *sketches).first()
    else:
        first = values.agg(*tallies).first()
        least = min((n for n in first if n), default=0)
        sketched = _sampled(values, least, whole).agg(*sketches).first()
    counts = {c: first[f"n{i}"] for i, c in enumerate(columns)}

    brackets: dict[tuple[str, float], _Bracket] = {}
    for i, c in enumerate(columns):
        if not counts[c]:
            continue
        for j, p in enumerate(probabilities):
            place = (counts[c] - 1) * p
            ranks = sorted({math.floor(place), math.ceil(place)})
            b = _Bracket(c, ranks, counts[c], slack=slack, expected=counts[c])
            if sketched[f"s{i}"] is not None:
                b.low, b.high = sketched[f"s{i}"][2 * j : 2 * j + 2]
                b.expected = 2 * slack * b.total
            brackets[c, p] = b
    _resolve(
        values, list(brackets.values()), SORT_ROWS if sort_rows is None else sort_rows, whole
    )

    result: dict[tuple[str, float], float | None] = {}
    for c in columns:
        for p in probabilities:
            if not counts[c]:
                result[c, p] = None
                continue
            place = (counts[c] - 1) * p
            found = brackets[c, p].found
            low, high = found[math.floor(place)].value, found[math.ceil(place)].value
            result[c, p] = low + (high - low) * (place - math.floor(place))
    return result


def row_positions(
    df: DataFrame, order_by: Sequence[str], ranks: Sequence[int], sort_rows: int | None = None
) -> list[tuple]:
    """Order key (as integers) of the row at each 0-based rank of ``order_by``.

    Finds split points with a few counting passes, so that a positional split is a
    filter on the order columns and needs no numbered copy of the table. Text may
    only break ties, and does so by its hash.
    """
    if not is_ordinal(df, order_by[0]):
        raise TypeError("the first order column must be an integer, date or timestamp")
    keys = df.select(*[as_long(df, c).alias(c) for c in order_by])
    return _positions(keys, list(order_by), ranks, sort_rows)


def _positions(
    keys: DataFrame, order_by: list[str], ranks: Sequence[int], sort_rows: int | None
) -> list[tuple]:
    head, rest = order_by[0], order_by[1:]
    stats = order_statistics(keys, head, ranks, sort_rows)
    positions = []
    for rank, stat in zip(ranks, stats):
        if stat.equal == 1 or not rest:
            if stat.equal > 1:
                raise ValueError(f"rows repeat in {order_by}; add a column that tells them apart")
            positions.append((stat.value,))
            continue
        ties = keys.filter(F.col(head) == stat.value)
        (inner,) = _positions(ties, rest, [rank - stat.below], sort_rows)
        positions.append((stat.value, *inner))
    return positions


def before(df: DataFrame, order_by: Sequence[str], position: tuple) -> Column:
    """Predicate: the row sorts strictly before ``position``."""
    name, value = order_by[0], position[0]
    column, bound = F.col(f"`{name}`"), _from_long(df, name, value)
    if isinstance(df.schema[name].dataType, T.StringType):
        column = F.xxhash64(column)
    if len(position) == 1:
        return column < bound
    return (column <= bound) & (
        (column < bound) | before(df, list(order_by[1:]), position[1:])
    )


def _from_long(df: DataFrame, name: str, value: int) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        day, micros = divmod(value, 86_400_000_000)
        seconds, fraction = divmod(micros, 1_000_000)
        clock = f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}.{fraction:06d}"
        return F.expr(f"to_timestamp_ntz(concat(date_from_unix_date({day}), ' {clock}'))")
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(value).cast("int"))
    return F.lit(value)
