"""Regression forests as node tables, grown by Spark one level at a time and finished in tasks.

A feature is cut into at most 256 bins at thresholds from a bounded sample. Nodes of many rows are
split level by level: tasks add up histograms of the bins, and the best split of each node comes
back. A node of few enough rows is dealt to one task, which grows all below it. Both find the split
that lowers the squared error most, so the bound between them does not change a forest.

Trees are grown as deep as they go. Depth, the rows a node must have to be split, and the
number of trees are then cuts of the same forest: a tree of depth 10 is a deeper one cut
there, and 50 trees are the first 50 of 200. Only the rows a leaf must have change the splits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans.staging import stage

SAMPLE = 10_000  # rows that thresholds are taken from
BINS = 32
CELLS = 1 << 24  # rows times features that one task grows whole trees of; of a subtree it gets a quarter
ROWS = 1 << 20  # rows that one task grows whole trees of
LEVELS = 12  # trees of at most so many levels are split by histograms to their ends once they are large
HELD = 1 << 23  # numbers of histograms that a task holds at a time
CHUNK = 1 << 17  # rows that a task adds to them at a time
NODES = 64  # nodes of a tree whose histograms meet in one group
TOGETHER = 10  # trees of one task
GROUPS = 12  # tasks that the trees of a fit are dealt to, if there are as many
NO_GAIN = 1e-12  # of a node's squared error: smaller gains are rounding
DENSE = 6  # rows above which a node is split by histograms in a task
MIDDLE = 48  # rows up to which nodes of all blocks are split together
BLOCK = 1 << 15  # rows of nodes worked on at a time, once they are that few
STRETCH = 1 << 13  # rows added to histograms at a time
SLAB = 1 << 14  # numbers of histograms that splits are taken from at a time
LAID = 1 << 22  # numbers of histograms of a block
TABLE = 1 << 14  # sums of subsets of a block
SAME = 1 - 1e-12  # gains nearer than that are equal
ROUNDING = 1e-20  # of a node's sum of squares: what sums of equal targets may differ by, squared

# Defaults of the parameters.
DEFAULTS: dict[str, Any] = {
    "numTrees": 20,
    "maxDepth": 5,
    "minInstancesPerNode": 1,
    "minRowsToSplit": 2,
    "bootstrap": True,
    "maxBins": BINS,
}


@dataclass(frozen=True)
class Params:
    """``maxDepth`` None is no limit; ``minInstancesPerNode`` rows stay in every leaf."""

    numTrees: int = 20
    maxDepth: int | None = 5
    minInstancesPerNode: int = 1
    minRowsToSplit: int = 2
    bootstrap: bool = True
    maxBins: int = BINS

    @classmethod
    def of(cls, params: Mapping[str, Any] | None) -> Params:
        return cls(**{**DEFAULTS, **dict(params or {})})

    @property
    def depth(self) -> int:
        return 1 << 30 if self.maxDepth is None else self.maxDepth


# ---- Trees


@dataclass
class Tree:
    """Nodes of one tree, children side by side and behind their parent.

    ``feature`` is -1 in a leaf, ``left`` the place of the left child, whose rows have a bin of
    at most ``bin``. ``rows`` counts rows as often as they were drawn; ``gain`` is the fall of the
    squared error.
    """

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray
    depth: np.ndarray

    COLUMNS = (("feature", "<i4"), ("bin", "<i4"), ("left", "<i4"), ("value", "<f8"), ("rows", "<i8"), ("gain", "<f8"), ("depth", "<i4"))

    def packed(self) -> list[bytes]:
        return [np.asarray(getattr(self, c), kind).tobytes() for c, kind in self.COLUMNS]

    @classmethod
    def unpacked(cls, values: Sequence[bytes]) -> Tree:
        return cls(*[np.frombuffer(v, kind).copy() for v, (_, kind) in zip(values, cls.COLUMNS, strict=True)])

    def cut(self, depth: int, min_rows: int) -> Tree:
        """The tree without the splits of nodes at ``depth`` or of fewer rows."""
        inner = (self.feature >= 0) & (self.depth < depth) & (self.rows >= min_rows)
        keep = np.zeros(len(self.feature), bool)
        keep[0] = True
        for level in range(int(self.depth.max()) + 1):
            at = np.flatnonzero(keep & inner & (self.depth == level))
            keep[self.left[at]] = keep[self.left[at] + 1] = True
        place = np.cumsum(keep) - 1
        inner = inner[keep]
        some = lambda x, other: np.where(inner, x[keep], other)
        return Tree(
            some(self.feature, -1), some(self.bin, 0), some(place[np.maximum(self.left, 0)], -1),
            self.value[keep], self.rows[keep], some(self.gain, 0.0), self.depth[keep],
        )

    def walk(self, bins: np.ndarray, depths: Sequence[int], min_rows: int) -> Iterator[np.ndarray]:
        """Values of the rows in the tree cut at each of the ascending ``depths``."""
        node = np.zeros(len(bins), np.int64)
        going = np.arange(len(bins))
        level = 0
        for depth in depths:
            while len(going) and level < depth:
                at = node[going]
                more = (self.feature[at] >= 0) & (self.rows[at] >= min_rows)
                going, at = going[more], at[more]
                node[going] = self.left[at] + (bins[going, self.feature[at]] > self.bin[at])
                level += 1
            yield self.value[node]


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, least: int, depth: int = 1 << 30, base: int = 0) -> Tree:
    """The tree over rows of bins, targets and whole weights, as deep as it goes."""
    return grow_alike(bins, y, w, [least], depth, base)[0]


def grow_alike(bins: np.ndarray, y: np.ndarray, w: np.ndarray, leasts: Sequence[int], depth: int = 1 << 30, base: int = 0) -> list[Tree]:
    """A tree for each of the ascending ``leasts``, the rows that stay in every leaf.

    The trees share a node as long as they share all splits above it: the best split of all leaves
    no side too small for most of them. Of equal splits the first feature and the lowest bin win.
    """
    return _Growth(bins, y, w, leasts, depth, base).trees()


class _Nodes(NamedTuple):
    """``rows`` side by side by node; ``size`` of a node, its ``place`` in each tree or -1, its ``level``."""

    rows: np.ndarray
    size: np.ndarray
    place: np.ndarray
    level: np.ndarray

    @classmethod
    def merged(cls, parts: Sequence[_Nodes]) -> _Nodes:
        return cls(*(np.concatenate(c) for c in zip(*parts, strict=True))) if len(parts) > 1 else parts[0]

    def some(self, of: np.ndarray) -> _Nodes:
        """Those where ``of`` is true."""
        return self if of.all() else _Nodes(self.rows[of.repeat(self.size)], self.size[of], self.place[of], self.level[of])

    def blocks(self, most: int) -> Iterator[_Nodes]:
        """Whole nodes of at most so many rows together, one at least."""
        ends = np.cumsum(self.size)
        at = 0
        while at < len(ends):
            begin = ends[at] - self.size[at]
            to = max(at + 1, int(np.searchsorted(ends, begin + most, side="right")))
            yield _Nodes(self.rows[begin : ends[to - 1]], self.size[at:to], self.place[at:to], self.level[at:to])
            at = to


class _Splits(NamedTuple):
    """The best split of each node: feature -1 where none helps; weight and weighted offset from the
    node's mean of its left side."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    weight: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, floor: np.ndarray, weight: np.ndarray, offset: np.ndarray) -> _Splits:
        inner = gain > floor
        return cls(np.where(inner, feature, -1), *(np.where(inner, x, 0) for x in (cut, gain, weight, offset)))


class _Rows(NamedTuple):
    """Rows of nodes with their weights and weighted offsets, and of each node its number of rows, weight,
    the gain that a split must exceed and the weight that its sides must have."""

    rows: np.ndarray
    w: np.ndarray
    offset: np.ndarray
    size: np.ndarray
    weight: np.ndarray
    floor: np.ndarray
    least: np.ndarray

    def some(self, of: np.ndarray, least: float) -> _Rows:
        """Those of some nodes, by number."""
        at = _rows_of(of, self.size)
        return _Rows(*(x.take(at) for x in self[:3]), *(x.take(of) for x in self[3:6]), np.full(len(of), least))


class _Growth:
    """Trees on their way. Nodes of many rows are split by histograms, level by level until some fit a block,
    then block by block, so that their rows stay in the cache; nodes of few rows by the sums of all subsets
    of their rows. Small nodes of all blocks are worked on together."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, leasts: Sequence[int], depth: int, base: int) -> None:
        there = np.flatnonzero(w > 0)
        self.lines = bins[there]
        self.columns = np.ascontiguousarray(self.lines.T)
        self.width = int(self.lines.max(initial=0)) + 1
        self.y, self.w = y[there], w[there].astype(np.float64)
        self.leasts, self.depth = np.maximum(1.0, leasts), depth + base
        self.made = [1] * len(leasts)
        self.out = []
        for least in self.leasts:
            most = max(1, 2 * min(len(there), int(self.w.sum() // least)) - 1)
            leaf = lambda: np.full(most, -1, np.int32)  # noqa: B023, E731
            number = lambda: np.zeros(most)  # noqa: B023, E731
            tree = Tree(leaf(), np.zeros(most, np.uint8), leaf(), number(), number(), number(), np.zeros(most, np.int32))
            tree.depth[0] = base
            if len(there):
                tree.value[0], tree.rows[0] = (self.w * self.y).sum() / self.w.sum(), self.w.sum()
            self.out.append(tree)
        self.blocks: list[_Nodes] = []
        self.middle: list[_Nodes] = []
        self.tiny: list[list[_Nodes]] = [[] for _ in range(9)]
        self.root = _Nodes(np.arange(len(there)), np.full(1, len(there)), np.zeros((1, len(leasts)), np.int64), np.full(1, base))

    def trees(self) -> list[Tree]:
        small = min(DENSE, 8)  # a byte has a bit for each row
        going = self._kept([self.root], BLOCK, small) if len(self.y) > 1 and self.root.level[0] < self.depth else []
        while going:
            going = self._kept(self._split(_Nodes.merged(going), self._by_histograms), BLOCK, small)
        for block in _Nodes.merged(self.blocks).blocks(BLOCK) if self.blocks else ():
            going = [block]
            while going:
                going = self._kept(self._split(_Nodes.merged(going), self._by_histograms), MIDDLE, small)
        while self.middle:
            waiting, self.middle = _Nodes.merged(self.middle), []
            for block in waiting.blocks(BLOCK):
                self._kept(self._split(block, self._by_histograms), MIDDLE, small)
        for size in range(small, 1, -1):  # children have fewer rows
            if self.tiny[size]:
                for block in _Nodes.merged(self.tiny[size]).blocks(size * (TABLE >> size)):
                    self._kept(self._split(block, self._by_subsets), MIDDLE, small)
        return [Tree(*(np.array(getattr(t, c)[:n], kind) for c, kind in Tree.COLUMNS)) for t, n in zip(self.out, self.made, strict=True)]

    def _kept(self, parts: Iterable[_Nodes], most: int, small: int) -> list[_Nodes]:
        """Lays nodes of at most ``most`` rows aside; gives back the others."""
        out = []
        for part in parts:
            kind = np.where(part.size > most, 11, np.where(part.size > MIDDLE, 10, np.where(part.size > small, 9, part.size)))
            for k in np.flatnonzero(np.bincount(kind)):
                to = out if k == 11 else self.blocks if k == 10 else self.middle if k == 9 else self.tiny[k]
                to.append(part.some(kind == k))
        return out

    def _split(self, nodes: _Nodes, best: Callable[[_Rows], _Splits]) -> list[_Nodes]:
        """Writes the splits of nodes and the values of their children; the children that may be split."""
        rows, size, place, level = nodes
        node = np.arange(len(size)).repeat(size)
        w, y = self.w.take(rows), self.y.take(rows)
        weight = np.bincount(node, w, len(size))
        mean = np.bincount(node, w * y, len(size)) / weight
        y -= mean.take(node)
        offset = w * y
        error = np.bincount(node, offset * y, len(size))
        floor = np.maximum(NO_GAIN * error, ROUNDING * (error + mean * mean * weight))
        here = place >= 0
        for tree, at, own in zip(self.out, here.T, place.T, strict=True):
            tree.value[own[at]] = mean[at]
        given = _Rows(rows, w, offset, size, weight, floor, self.leasts.take(here.argmax(axis=1)))
        now = best(given)
        # The nodes and splits of each kind, and the kind that each tree takes at a node.
        kinds, kind = [(np.arange(len(size)), now)], np.zeros(place.shape, np.int8)
        for i, least in enumerate(self.leasts[1:], 1):
            again = np.flatnonzero(here[:, i] & (now.feature >= 0) & (np.minimum(now.weight, weight - now.weight) < least))
            if len(again):
                other = best(given.some(again, least))
                now = _Splits(*(x.copy() for x in now))
                for x, v in zip(now, other, strict=True):
                    x[again] = v
                kind[again, i:] = len(kinds)
                kinds.append((again, other))
        children = []
        for k, (of, split) in enumerate(kinds):
            mine = here[of] & (kind[of] == k) & (split.feature >= 0)[:, None]
            some = np.flatnonzero(mine.any(axis=1))
            if len(some) < len(of):
                of, mine, split = of[some], mine[some], _Splits(*(x[some] for x in split))
            if len(of):
                children += self._write(nodes, of, mine, split, weight[of], mean[of])
        return children

    def _write(self, nodes: _Nodes, of: np.ndarray, mine: np.ndarray, split: _Splits, weight: np.ndarray, mean: np.ndarray) -> list[_Nodes]:
        """The same of the nodes ``of`` in the trees ``mine``."""
        size, level, place = nodes.size[of], nodes.level[of] + 1, nodes.place[of]
        right = weight - split.weight
        sides = (mean + split.offset / split.weight, split.weight), (mean - split.offset / right, right)
        left = np.full(mine.shape, -1)
        for i, tree in enumerate(self.out):
            at = np.flatnonzero(mine[:, i])
            to, own = self.made[i] + 2 * np.arange(len(at)), place[at, i]
            self.made[i] += 2 * len(at)
            left[at, i] = to
            tree.feature[own], tree.bin[own], tree.left[own], tree.gain[own] = split.feature[at], split.bin[at], to, split.gain[at]
            for side, (value, rows) in enumerate(sides):
                tree.value[to + side], tree.rows[to + side], tree.depth[to + side] = value[at], rows[at], level[at]
        if size.max() == 2:
            return []
        rows = nodes.rows if len(of) == len(nodes.size) else nodes.rows.take(_rows_of(of, nodes.size))
        node = np.arange(len(of)).repeat(size)
        high = self.columns.ravel().take((split.feature * len(self.y)).take(node) + rows) > split.bin.take(node)
        more = np.bincount(node[high], minlength=len(of))
        children = []
        for side, (count, total) in enumerate(((size - more, split.weight), (more, right))):
            on = mine & ((count > 1) & (level < self.depth))[:, None] & (total[:, None] >= 2 * self.leasts)
            go = on.any(axis=1)
            if go.any():
                take = go.take(node) & (high if side else ~high)
                children.append(_Nodes(rows[take], count[go], np.where(on[go], left[go] + side, -1), level[go]))
        return children

    def _by_histograms(self, given: _Rows) -> _Splits:
        """The best splits; nodes are in the order of their rows."""
        count, width = self.columns.shape[0], self.width
        most = max(1, LAID // max(1, 2 * count * width))
        if len(given.size) > most:
            parts = [self._by_histograms(given.some(np.arange(i, min(i + most, len(given.size))), 0.0)._replace(least=given.least[i : i + most])) for i in range(0, len(given.size), most)]
            return _Splits(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        nodes = len(given.size)
        node = np.arange(nodes).repeat(given.size)
        held = np.zeros((2, count, nodes * width))
        for i in range(0, len(node), STRETCH):
            rows, w, offset = (x[i : i + STRETCH] for x in given[:3])
            first, last = node[i], node[min(i + STRETCH, len(node)) - 1] + 1
            start = (node[i : i + STRETCH] - first) * width
            for j, column in enumerate(self.columns):
                cell = column.take(rows) + start
                for to, numbers in zip(held, (w, offset), strict=True):
                    to[j, first * width : last * width] += np.bincount(cell, numbers, (last - first) * width)
        gain = np.empty((count, nodes))
        some = max(1, SLAB // (nodes * width))
        for j in range(0, count, some):
            wl, sl = (x[j : j + some].reshape(-1, width).T.copy() for x in held)
            for i in range(1, width):
                wl[i] += wl[i - 1]
                sl[i] += sl[i - 1]
            times = wl.shape[1] // nodes
            gain[j : j + some] = _gains(wl, sl, np.tile(given.weight, times), np.tile(given.least, times)).max(axis=0).reshape(times, nodes)
        top = gain.max(axis=0, initial=0.0)
        if not count:
            return _Splits.of(*np.zeros((2, nodes), np.int64), top, given.floor, *np.zeros((2, nodes)))
        feature, at = np.argmax(gain >= top * SAME, axis=0), np.arange(nodes)
        wl, sl = (x.reshape(count, nodes, width)[feature, at].cumsum(axis=1) for x in held)
        found = _gains(wl, sl, given.weight[:, None], given.least[:, None])
        cut = np.argmax(found >= gain[feature, at][:, None] * SAME, axis=1)
        return _Splits.of(feature, cut, gain[feature, at] * given.weight, given.floor, wl[at, cut], sl[at, cut])

    def _by_subsets(self, given: _Rows) -> _Splits:
        """The same of nodes of equally many rows: the rows that a split leaves left are the bits of a
        number, and the sums of all such subsets are made once."""
        m, nodes = int(given.size[0]), len(given.size)
        bins = self.lines.take(given.rows.reshape(nodes, m).T, axis=0)  # row, node, feature
        sums = np.zeros((2, nodes, 1 << m))
        for j in range(m):
            half = 1 << j
            for to, numbers in zip(sums, (given.w, given.offset), strict=True):
                to[:, half : 2 * half] = to[:, :half] + numbers[j::m, None]
        wl, sl = sums
        gains = _gains(wl, sl, given.weight[:, None], given.least[:, None])
        gains = np.maximum(gains, gains[:, ::-1])  # the same split with its sides swapped, so that rounding decides nothing
        left = np.zeros(bins.shape, np.uint8)  # the rows with at most the bin of a row
        for j in range(m):
            left |= (bins[j] <= bins).view(np.uint8) << np.uint8(j)
        at = np.arange(nodes)
        gain = gains.ravel().take(left + (at << m)[:, None])
        most = gain.max(axis=0)
        if not most.size:
            return _Splits.of(*np.zeros((2, nodes), np.int64), np.zeros(nodes), given.floor, *np.zeros((2, nodes)))
        feature = np.argmax(most >= (most.max(axis=1) * SAME)[:, None], axis=1)
        top, cuts = most[at, feature], bins[:, at, feature]
        row = np.where(gain[:, at, feature] >= top * SAME, cuts, 255).argmin(axis=0)
        subset = left[row, at, feature]
        return _Splits.of(feature, cuts[row, at], top * given.weight, given.floor, wl[at, subset], sl[at, subset])


def _rows_of(of: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the rows of some nodes."""
    some = np.zeros(len(size), bool)
    some[of] = True
    return np.flatnonzero(some.repeat(size))


def _gains(wl: np.ndarray, sl: np.ndarray, weight: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Gain over the weight of a node, 0 where a side is too small."""
    wr = weight - wl
    good = (wl >= least) & (wr >= least)
    wr *= wl
    gain = sl * sl
    gain /= np.maximum(wr, 1.0, out=wr)
    gain *= good
    return gain


# ---- Rows


def thresholds(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Cut points of each feature, halfway between values of a sample of ``SAMPLE`` distinct rows.

    Between all distinct values where they are few, else at even shares of the rows. A row is
    likelier in the sample the more often it occurs and stands for as many rows (priority
    sampling by a hash), so copies crowd nothing out; up to ``SAMPLE`` distinct rows, every one is there.
    """
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    columns = [F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(features)]
    names = [f"c{i}" for i in range(len(features))]
    found = df.select(*columns).select("*", F.xxhash64(*names).alias("h"))
    share = (F.shiftrightunsigned("h", 11) + 0.5) * 2.0**-53
    alike = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).withColumn("priority", F.col("n") / share)
    top = alike.orderBy(F.desc("priority"), "h").limit(SAMPLE + 1).collect()
    least = top[SAMPLE]["priority"] if len(top) > SAMPLE else 0.0
    stands = [(r["h"], max(float(r["n"]), least)) for r in top[:SAMPLE]]
    picked = F.broadcast(df.sparkSession.createDataFrame(stands, "h long, n double"))
    rows = found.join(picked, "h").groupBy("h").agg(*[F.first(c).alias(c) for c in names], F.first("n").alias("n"))
    sample = rows.orderBy("h").select(*names, "n").toPandas().to_numpy(float)
    out = []
    for values in sample.T[:-1]:
        there = np.flatnonzero(~np.isnan(values))
        there = there[np.argsort(values[there])]
        each, first = np.unique(values[there], return_index=True)
        if len(each) > bins:
            upto = np.cumsum(sample[there, -1])  # rows at most as large
            places = np.searchsorted(upto, [upto[-1] * k // bins for k in range(1, bins)])
            at = np.unique(np.searchsorted(first, places, side="right") - 1)
            at = at[at + 1 < len(each)]
        else:
            at = np.arange(len(each) - 1)
        out.append((each[at] + each[at + 1]) / 2)
    return out


def matrix(values: pd.Series) -> np.ndarray:
    """Rows of an array column; NULL is NaN."""
    return np.concatenate([np.empty(0), *values]).astype(float, copy=False).reshape(len(values), -1)


def as_array(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in features])


def binned(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], target: str, key: Column, block: Column) -> DataFrame:
    """``id, key, block, y, b``: a row number, what the draws depend on, and the bins as bytes.

    A missing or NaN feature is in the lowest bin; rows without target are left out.
    """

    @F.pandas_udf("binary")
    def run(x: pd.Series) -> pd.Series:
        rows = matrix(x)
        out = np.empty(rows.shape, np.uint8)
        for j, edges in enumerate(cuts):
            out[:, j] = np.where(np.isnan(rows[:, j]), 0, np.searchsorted(edges, rows[:, j], side="left"))
        return pd.Series([r.tobytes() for r in out])

    y = F.nanvl(F.col(f"`{target}`").cast("double"), F.lit(None).cast("double"))
    rows = df.select(key.alias("key"), block.cast("int").alias("block"), y.alias("y"), run(as_array(features)).alias("b"))
    # A series of features is one task's; levels and subtrees need all cores.
    even = rows.filter(F.col("y").isNotNull()).repartition(2 * df.sparkSession.sparkContext.defaultParallelism, "key")
    return stage(even.withColumn("id", F.monotonically_increasing_id()), "binned")


def draws(key: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson numbers by a hash of row, tree and seed."""
    if not bootstrap:
        return np.ones(len(key), np.int64)
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) % (1 << 64))
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    found = _DRAWS.take((x >> np.uint64(48)).view(np.int64))
    open_ = np.flatnonzero(found < 0)
    found[open_] = np.searchsorted(_POISSON, (x[open_] >> np.uint64(11)) * 2.0**-53, side="right")
    return found


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
_POISSON = _POISSON[_POISSON < 1]
_SHARES = np.arange(1 << 16) * 2.0**-16
# The number that the upper 16 bits of a hash give, or -1 where the lower ones decide.
_DRAWS = np.searchsorted(_POISSON, _SHARES, side="right")
_DRAWS[_DRAWS != np.searchsorted(_POISSON, _SHARES + (2.0**-16 - 2.0**-53), side="right")] = -1


def _frame(batch: pd.DataFrame, count: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch["b"]), np.uint8).reshape(-1, count)
    return bins, batch["y"].to_numpy(float), batch["key"].to_numpy(np.int64), batch["block"].to_numpy()


# ---- Levels of large nodes


@dataclass(frozen=True)
class Kind:
    """Trees grown alike: on the rows of the blocks before ``fold``, ``least`` rows to a leaf."""

    fold: int
    least: int


_SPLIT = "kind int, tree int, node int, feature int, bin int, gain double, lw double, ls double, rw double, rs double"


def _routed(top: Tree, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    inner = top.feature >= 0
    feature = np.where(inner, top.feature, 0)
    last = np.where(inner, top.bin, 255).astype(np.int16)  # no bin is above, so a leaf leads to itself
    left = np.where(inner, top.left, np.arange(len(inner)))
    flat, base = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    node = np.zeros(len(bins), np.int64)
    for _ in range(int(top.depth.max())):
        node = left.take(node) + (flat.take(base + feature.take(node)) > last.take(node))
    return node


def _passes(active: Mapping[tuple, set], cells: int) -> Iterator[dict[tuple, list[int]]]:
    """Nodes to split, as many at a time as a task may hold the histograms of."""
    asked: dict[tuple, list[int]] = {}
    room = most = max(1, HELD // cells)
    for key, nodes in active.items():
        rest = sorted(nodes)
        while rest:
            asked[key], rest = rest[:room], rest[room:]
            room -= len(asked[key])
            if not room:
                yield asked
                asked, room = {}, most
    if asked:
        yield asked


def _chunks(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Packed parts joined to ``CHUNK`` rows or more.

    A batch has as many parts as Spark sends at a time, so they stay where they are in it:
    copies are made of one chunk only.
    """
    held: list[tuple] = []
    for batch in batches:
        numbers = [batch.column(c).to_pylist() for c in ("part", "block", "n")]
        for part, block, n, rows in zip(*numbers, batch.column("rows"), strict=True):
            held.append((part, block, n, rows.as_buffer()))
            if sum(h[2] for h in held) >= CHUNK:
                yield _joined(held, count)
                held = []
    if held:
        yield _joined(held, count)


def _tops(rows: DataFrame, kinds: Sequence[Kind], trees: int, count: int, width: int, most: int, seed: int, bootstrap: bool, depth: int):
    """The upper part of every tree of more than ``most`` rows, whose leaves have at most a quarter of
    them or no split; the whole tree where it has few levels. Also the rows, packed where there is one.

    Each round splits one level of all trees; histograms are added up by Spark, and a node's
    best split is all that comes back.
    """
    sizes = {r["block"]: r["n"] for r in rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    root = {k: sum(n for b, n in sizes.items() if b < kind.fold) for k, kind in enumerate(kinds)}
    single = lambda: Tree(*(np.array([x]) for x in (-1, 0, -1, 0.0, 0, 0.0, 0)))
    tops = {(k, t): single() for k in root if root[k] > most for t in range(trees)}
    packs = _packed(rows, count) if tops else None
    active = {key: {0} for key in tops}
    least = 1 if depth <= LEVELS else max(1, most // 4)
    while any(active.values()):
        splits = []
        for asked in _passes(active, 2 * count * width):
            splits += _level(packs, kinds, tops, asked, count, width, seed, bootstrap)
        active = {key: set() for key in tops}
        for s in sorted(splits, key=lambda r: (r["kind"], r["tree"], r["node"])):
            top, at = tops[s["kind"], s["tree"]], s["node"]
            w = s["lw"] + s["rw"]
            top.value[at], top.rows[at] = (s["ls"] + s["rs"]) / w if w else 0.0, w
            if s["feature"] < 0 or top.depth[at] >= depth:
                continue
            left, level = len(top.feature), top.depth[at] + 1
            top.feature[at], top.bin[at], top.left[at], top.gain[at] = s["feature"], s["bin"], left, s["gain"]
            for name, values in (
                ("feature", (-1, -1)), ("bin", (0, 0)), ("left", (-1, -1)), ("gain", (0.0, 0.0)), ("depth", (level, level)),
                ("value", (s["ls"] / s["lw"], s["rs"] / s["rw"])), ("rows", (int(s["lw"]), int(s["rw"]))),
            ):
                setattr(top, name, np.append(getattr(top, name), values))
            if level < depth:
                active[s["kind"], s["tree"]] |= {left + side for side, n in enumerate((s["lw"], s["rw"])) if n > least}
    return tops, packs


def _level(packs: DataFrame, kinds: Sequence[Kind], tops: Mapping, asked: Mapping, count: int, width: int, seed: int, bootstrap: bool) -> list:
    """The best split of each of the ``asked`` nodes."""
    now = {key: tops[key] for key in asked}

    def histograms(batches):
        held = {key: (np.zeros((2, count, len(nodes) * width)), np.zeros(len(nodes))) for key, nodes in asked.items()}
        seen = False
        for bins, y, key, block in _chunks(batches, count):
            seen, drawn = True, (-1, None)
            for (k, t), nodes in sorted(asked.items(), key=lambda i: (i[0][1], i[0][0])):
                if drawn[0] != t:
                    drawn = t, draws(key, t, seed, bootstrap)
                w = drawn[1]
                of = np.flatnonzero((w > 0) & (block < kinds[k].fold))
                some = bins.take(of, axis=0)
                slot = np.full(len(now[k, t].feature), -1)
                slot[nodes] = np.arange(len(nodes))
                slot = slot.take(_routed(now[k, t], some))
                there = np.flatnonzero(slot >= 0)
                if len(there) < len(of):
                    of, some, slot = of.take(there), some.take(there, axis=0), slot.take(there)
                ww, actual = w.take(of).astype(float), y.take(of)
                wy = ww * actual
                sums, squares = held[k, t]
                squares += np.bincount(slot, wy * actual, len(nodes))
                slot *= width
                for j, column in enumerate(np.ascontiguousarray(some.T)):
                    cell = slot + column
                    sums[0, j] += np.bincount(cell, ww, len(nodes) * width)
                    sums[1, j] += np.bincount(cell, wy, len(nodes) * width)
        if not seen:
            return
        for (k, t), nodes in asked.items():
            sums, squares = held.pop((k, t))
            sums = sums.reshape(2, count, len(nodes), width)
            parts = [(k, t, i, sums[:, :, i : i + NODES].tobytes(), squares[i : i + NODES].tobytes()) for i in range(0, len(nodes), NODES)]
            yield _batch(parts, "kind int, tree int, part int, h binary, q binary")

    def best(group: pd.DataFrame) -> pd.DataFrame:
        k, t, part = (int(group[c].iloc[0]) for c in ("kind", "tree", "part"))
        squares = sum(np.frombuffer(x, "<f8") for x in group["q"])
        w, s = sum(np.frombuffer(x, "<f8") for x in group["h"]).reshape(2, count, len(squares), width)
        found = [
            (k, t, node, *_split_of(w[:, i], s[:, i], squares[i], kinds[k].least))
            for i, node in enumerate(asked[k, t][part : part + NODES])
        ]
        return pd.DataFrame(found, columns=[c.split()[0] for c in _SPLIT.split(", ")])

    # No more tasks than cores: each gives a histogram of every node, however few its rows are.
    tasks = packs.sparkSession.sparkContext.defaultParallelism
    parts = packs.coalesce(max(1, tasks)).mapInArrow(histograms, "kind int, tree int, part int, h binary, q binary")
    return parts.groupBy("kind", "tree", "part").applyInPandas(best, _SPLIT).collect()


def _split_of(weights: np.ndarray, sums: np.ndarray, squares: float, least: int) -> tuple:
    """The best split of a node's histograms: feature, bin, gain, and weight and sum to both sides."""
    w, s = weights.cumsum(axis=1), sums.cumsum(axis=1)
    total, whole = w[0, -1], s[0, -1]
    mean = whole / total if total else 0.0
    error = max(0.0, squares - mean * whole)
    wl, sl = w[:, :-1], s[:, :-1] - w[:, :-1] * mean
    wr = total - wl
    good = (wl >= max(1, least)) & (wr >= max(1, least))
    gain = np.where(good, sl * sl * total / np.where(good, wl * wr, 1.0), 0.0)
    if not gain.size or gain.max() <= max(NO_GAIN * error, ROUNDING * squares):
        return -1, 0, 0.0, total, whole, 0.0, 0.0
    f, b = np.unravel_index(np.argmax(gain >= gain.max() * (1 - 1e-12)), gain.shape)
    return int(f), int(b), float(gain[f, b]), w[f, b], s[f, b], total - w[f, b], whole - s[f, b]


# ---- Subtrees


def _packed(rows: DataFrame, count: int) -> DataFrame:
    """``part, block, n, rows``: keys, targets and bins of some rows of a block at a time, as bytes."""

    def pack(batches):
        for batch in batches:
            for block, some in batch.groupby("block"):
                bins, y, key, _ = _frame(some, count)
                yield pd.DataFrame([(block, len(some), key.tobytes() + y.tobytes() + bins.tobytes())], columns=["block", "n", "rows"])

    parts = rows.mapInPandas(pack, "block int, n int, rows binary")
    return stage(parts.withColumn("part", F.monotonically_increasing_id()), "packed")


def _unpacked(group: pd.DataFrame, count: int) -> tuple[np.ndarray, ...]:
    """Bins, targets, keys and blocks of the rows of parts, in the order of the parts."""
    return _joined(group[["part", "block", "n", "rows"]].itertuples(index=False, name=None), count)


def _joined(parts: Iterable[tuple], count: int) -> tuple[np.ndarray, ...]:
    """The same of tuples ``part, block, n, rows``."""
    parts = sorted(parts, key=lambda p: p[0])
    keys, ys, bins = [], [], []
    for _, _, n, data in parts:
        keys.append(np.frombuffer(data, np.int64, n))
        ys.append(np.frombuffer(data, np.float64, n, 8 * n))
        bins.append(np.frombuffer(data, np.uint8, n * count, 16 * n).reshape(n, count))
    blocks = np.repeat([p[1] for p in parts], [p[2] for p in parts])
    return np.concatenate(bins), np.concatenate(ys), np.concatenate(keys), blocks


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _batch(rows: Sequence[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch with the columns of a Spark ``schema`` of numbers and bytes."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = [pa.array(c, _ARROW[kind]) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, list(names))


def _whole(rows: DataFrame, kinds: Sequence[Kind], trees: int, tops: Mapping, count: int, tested: bool, together: int) -> DataFrame | None:
    """``fold, tree`` and the parts of each group that one task grows ``together`` whole trees of, all kinds
    of a fold; None where every fold has upper parts."""
    large = {kinds[k].fold for k, _ in tops}
    folds = sorted({k.fold for k in kinds} - large)
    if not folds:
        return None
    takes = lambda f: F.col("block") <= f if tested else F.col("block") < f
    at = F.explode(F.filter(F.array(*[F.when(takes(f), F.lit(f)) for f in folds]), lambda x: x.isNotNull()))
    first = F.explode(F.sequence(F.lit(0), F.lit(trees - 1), F.lit(together)))
    dealt = _packed(rows.filter(takes(folds[-1])), count).withColumn("fold", at).withColumn("tree", first)
    # More partitions than groups, so that few groups share one: coalescing by size would line up
    # trees behind each other, as their rows are few for the time that they take.
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(max(least, 4 * len(folds) * -(-trees // together)), "fold", "tree")


def _groups(rows: DataFrame, kinds: Sequence[Kind], tops: dict, count: int, tested: bool) -> DataFrame:
    """``fold, kind, tree, node`` and the rows of each leaf of every upper part, which one task works on."""

    def route(batches):
        for batch in batches:
            bins = _frame(batch, count)[0]
            for (k, t), top in tops.items():
                fold = kinds[k].fold
                of = (batch["block"] <= fold if tested else batch["block"] < fold).to_numpy()
                part = batch[of].assign(fold=fold, kind=k, tree=t, node=_routed(top, bins[of]))
                yield part[["fold", "kind", "tree", "node", "id", "key", "block", "y", "b"]]

    schema = "fold int, kind int, tree int, node int, id long, key long, block int, y double, b binary"
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.mapInPandas(route, schema).repartition(least, "fold", "kind", "tree", "node")


def _plan(rows: DataFrame, kinds: Sequence[Kind], trees: int, cuts: Sequence[np.ndarray], seed: int, params: Params, depth: int, cells: int):
    """Upper parts of trees, the packed rows that gave them, and the settings that tasks need."""
    count = len(cuts)
    width = max((len(c) for c in cuts), default=0) + 1
    most = max(1, min(ROWS, cells // max(1, count)))
    return *_tops(rows, kinds, trees, count, width, most, seed, params.bootstrap, depth), count


def fit(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    params: Mapping[str, Any] | None = None,
    seed: int = 0,
    key: Column | None = None,
    cells: int = CELLS,
) -> Forest:
    """Forest over all features per split. ``key`` names a row for the draws, by default its values."""
    want = Params.of(params)
    cuts = thresholds(df, features, want.maxBins)
    name = F.xxhash64(*[F.col(f"`{c}`") for c in (*features, target)]) if key is None else key
    rows = binned(df, features, cuts, target, name, F.lit(0))
    kinds = [Kind(1, want.minInstancesPerNode)]
    tops, _, count = _plan(rows, kinds, want.numTrees, cuts, seed, want, want.depth, cells)
    together = max(1, min(TOGETHER, want.numTrees // GROUPS))
    names = ["tree", "node", *[c for c, _ in Tree.COLUMNS]]

    def grown(rows, tree: int, node: int, base: int) -> tuple:
        bins, y, keys, _ = rows
        found = grow(bins, y, draws(keys, tree, seed, want.bootstrap), want.minInstancesPerNode, want.depth - base, base)
        return tree, node, *found.cut(want.depth, want.minRowsToSplit).packed()

    def build(group: pd.DataFrame) -> pd.DataFrame:
        first, rows = int(group["tree"].iloc[0]), _unpacked(group, count)
        return pd.DataFrame([grown(rows, t, -1, 0) for t in range(first, min(first + together, want.numTrees))], columns=names)

    def build_below(group: pd.DataFrame) -> pd.DataFrame:
        node, tree = int(group["node"].iloc[0]), int(group["tree"].iloc[0])
        return pd.DataFrame([grown(_frame(group, count), tree, node, int(tops[0, tree].depth[node]))], columns=names)

    schema = "tree int, node int, " + ", ".join(f"{c} binary" for c, _ in Tree.COLUMNS)
    found = []
    if not tops:
        groups = _whole(rows, kinds, want.numTrees, tops, count, False, together)
        found = groups.groupBy("fold", "tree").applyInPandas(build, schema).collect()
    elif want.depth > LEVELS:
        groups = _groups(rows, kinds, tops, count, False)
        found = groups.groupBy("fold", "kind", "tree", "node").applyInPandas(build_below, schema).collect()
    parts = {(r["tree"], r["node"]): Tree.unpacked(r[2:]) for r in found}
    empty = grow(np.empty((0, count), np.uint8), np.empty(0), np.empty(0), 1)
    whole = []
    for t in range(want.numTrees):
        if (0, t) in tops:
            tree = _grafted(tops[0, t], {n: p for (i, n), p in parts.items() if i == t})
            whole.append(tree.cut(want.depth, want.minRowsToSplit))
        else:
            whole.append(parts.get((t, -1), empty))
    return Forest.of(whole, cuts, features)


def _grafted(top: Tree, below: Mapping[int, Tree]) -> Tree:
    """The upper part with a subtree at each of its leaves."""
    columns = {c: [getattr(top, c)] for c, _ in Tree.COLUMNS}
    at = len(top.feature)
    for node, part in sorted(below.items()):
        if part.feature[0] < 0:
            continue
        shift = at - 1  # the root takes the leaf's place, the rest follows
        top.feature[node], top.bin[node], top.gain[node] = part.feature[0], part.bin[0], part.gain[0]
        top.left[node] = part.left[0] + shift
        for c, _ in Tree.COLUMNS:
            values = getattr(part, c)[1:]
            columns[c].append(np.where(values >= 0, values + shift, -1) if c == "left" else values)
        at += len(part.feature) - 1
    return Tree(*(np.concatenate(columns[c]) for c, _ in Tree.COLUMNS))


_ERRORS = "fold int, n long, "


def validation_errors(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    combinations: Sequence[Mapping[str, Any]],
    folds: int,
    seed: int,
    key: Column,
    cells: int = CELLS,
) -> dict[tuple[int, int], float | None]:
    """Mean absolute error of every (combination, fold).

    ``df`` has the column ``_block``: rows of block ``k`` are fold ``k``'s test rows, those of
    lower blocks its training rows. Trees are grown once per fold and leaf size, with the most
    trees and no limit of depth; each task scores the test rows that it has with every cut of its trees.
    """
    wanted = [Params.of(c) for c in combinations]
    if len({(p.bootstrap, p.maxBins) for p in wanted}) > 1:
        raise ValueError("combinations must share bootstrap and maxBins")
    depths = sorted({p.depth for p in wanted})
    splits = sorted({p.minRowsToSplit for p in wanted})
    leasts = sorted({p.minInstancesPerNode for p in wanted})
    counts = sorted({p.numTrees for p in wanted})
    together = math.gcd(TOGETHER, *counts)
    cuts = thresholds(df, features, wanted[0].maxBins)
    rows = binned(df, features, cuts, target, key, F.col("_block"))
    kinds = [Kind(f, m) for f in range(folds) for m in leasts]
    tops, packs, count = _plan(rows, kinds, counts[-1], cuts, seed, wanted[0], depths[-1], cells)
    cells_ = [(m, s, d) for m in leasts for s in splits for d in depths]

    needed = sorted({(p.numTrees, cells_.index((p.minInstancesPerNode, p.minRowsToSplit, p.depth))) for p in wanted})
    names = [f"p{n}_{i}" for n, i in needed]

    def build(group: pd.DataFrame) -> pd.DataFrame:
        """A row per part of test rows: their targets, and sums of the trees for every cell."""
        fold, tree = int(group["fold"].iloc[0]), int(group["tree"].iloc[0])
        bins, y, keys, block = _unpacked(group, count)
        early, late = block < fold, block == fold
        there = group[group["block"] == fold].sort_values("part")
        if not len(there):
            return pd.DataFrame([], columns=["fold", "part", "tree", "y", "sums"])
        trained, targets, tested = bins[early], y[early], bins[late]
        sums = np.zeros((len(cells_), len(tested)))
        for t in range(tree, tree + together):
            w = draws(keys[early], t, seed, wanted[0].bootstrap)
            at = 0
            for found in grow_alike(trained, targets, w, leasts, depths[-1]):
                for s in splits:
                    for values in found.walk(tested, depths, s):
                        sums[at] += values
                        at += 1
        ends = np.cumsum(there["n"].to_numpy())[:-1]
        actual, sums = np.split(y[late], ends), np.split(sums, ends, axis=1)
        found = [(fold, p, tree, a.tobytes(), s.tobytes()) for p, a, s in zip(there["part"], actual, sums, strict=True)]
        return pd.DataFrame(found, columns=["fold", "part", "tree", "y", "sums"])

    def off(group: pd.DataFrame) -> pd.DataFrame:
        """Absolute errors of the rows of a part, summed, for every number of trees and cell."""
        group = group.sort_values("tree")
        actual = np.frombuffer(group["y"].iloc[0], np.float64)
        total, errors = np.zeros((len(cells_), len(actual))), np.zeros(len(needed))
        for tree, sums in zip(group["tree"], group["sums"], strict=True):
            total += np.frombuffer(sums, np.float64).reshape(total.shape)
            for j, (n, i) in enumerate(needed):
                if n == tree + together:
                    errors[j] = np.abs(actual - total[i] / n).sum()
        return pd.DataFrame([(group["fold"].iloc[0], len(actual), *errors)], columns=["fold", "n", *names])

    def build_below(group: pd.DataFrame) -> pd.DataFrame:
        fold, kind, tree, node = (int(group[c].iloc[0]) for c in ("fold", "kind", "tree", "node"))
        bins, y, keys, block = _frame(group, count)
        early, late = block < fold, block == fold
        sums = np.zeros((int(late.sum()), len(cells_)))
        if len(sums):
            w = draws(keys[early], tree, seed, wanted[0].bootstrap)
            top, least = tops[kind, tree], kinds[kind].least
            base = int(top.depth[node])
            grown = grow(bins[early], y[early], w, least, depths[-1] - base, base)
            at = cells_.index((least, splits[0], depths[0]))
            for s in splits:
                for values in _below(top, node, grown, bins[late], depths, s):
                    sums[:, at] += values
                    at += 1
        out = pd.DataFrame(sums, columns=[f"s{i}" for i in range(len(cells_))])
        out.insert(0, "y", y[late])
        out.insert(0, "tree", tree)
        out.insert(0, "id", group["id"].to_numpy()[late])
        out.insert(0, "fold", fold)
        return out

    whole = bool(tops) and depths[-1] <= LEVELS  # nothing is left to grow in the large folds
    found = {}
    dealt = _whole(rows, kinds, counts[-1], tops, count, True, together)
    if dealt is not None:
        sums = dealt.groupBy("fold", "tree").applyInPandas(build, "fold int, part long, tree int, y binary, sums binary")
        # A part's sums are some MB, so a few parts to a task.
        tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        parts = sums.repartition(tasks, "fold", "part").groupBy("fold", "part").applyInPandas(off, _ERRORS + ", ".join(f"{c} double" for c in names))
        means = parts.groupBy("fold").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in names])
        found = {r["fold"]: r for r in means.collect()}
    if tops and not whole:
        schema = "fold int, id long, tree int, y double, " + ", ".join(f"s{i} double" for i in range(len(cells_)))
        sums = _groups(rows, kinds, tops, count, True).groupBy("fold", "kind", "tree", "node").applyInPandas(build_below, schema)
        totals = sums.groupBy("fold", "id").agg(
            F.first("y").alias("y"),
            *[F.sum(F.when(F.col("tree") < n, F.col(f"s{i}"))).alias(f"p{n}_{i}") for n, i in needed],
        )
        errors = totals.groupBy("fold").agg(*[F.avg(F.abs(F.col("y") - F.col(f"p{n}_{i}") / n)).alias(f"p{n}_{i}") for n, i in needed])
        found |= {r["fold"]: r for r in errors.collect()}
    if whole:
        large = sorted({kinds[k].fold for k, _ in tops})

        def scored(batches):
            for bins, y, _, block in _chunks(batches, count):
                for fold in large:
                    late = np.flatnonzero(block == fold)
                    tested, actual = bins[late], y[late]
                    sums, off = np.zeros((len(cells_), len(late))), np.zeros(len(needed))
                    for t in range(counts[-1]):
                        grown = [tops[k, t] for k, kind in enumerate(kinds) if kind.fold == fold]
                        values = (v for tree in grown for s in splits for v in tree.walk(tested, depths, s))
                        for at, value in enumerate(values):
                            sums[at] += value
                        for j, (n, i) in enumerate(needed):
                            if n == t + 1:
                                off[j] = np.abs(actual - sums[i] / n).sum()
                    if len(late):
                        yield _batch([(fold, len(late), *off)], schema)

        schema = _ERRORS + ", ".join(f"{c} double" for c in names)
        parts = packs.mapInArrow(scored, schema)
        means = parts.groupBy("fold").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in names])
        found |= {r["fold"]: r for r in means.collect()}
    out = {}
    for c, p in enumerate(wanted):
        name = f"p{p.numTrees}_{cells_.index((p.minInstancesPerNode, p.minRowsToSplit, p.depth))}"
        for k in range(folds):
            out[c, k] = found[k][name] if k in found else None
    return out


def _below(top: Tree, node: int, grown: Tree, bins: np.ndarray, depths: Sequence[int], min_rows: int) -> Iterator[np.ndarray]:
    """Values at each depth of rows at a leaf of an upper part that goes on in a subtree."""
    path = _path(top, node)
    stop = next((n for n in path if top.rows[n] < min_rows), None)
    inner = list(grown.walk(bins, [max(0, d - int(top.depth[node])) for d in depths], min_rows))
    for depth, values in zip(depths, inner, strict=True):
        end = next((n for n in path if top.depth[n] == depth), None)
        over = [n for n in (stop, end) if n is not None and n != node]
        yield np.full(len(bins), top.value[min(over, key=lambda n: top.depth[n])]) if over else values


def _path(top: Tree, node: int) -> list[int]:
    """Nodes from the root to ``node``."""
    parent = {int(c): p for p in np.flatnonzero(top.feature >= 0) for c in (top.left[p], top.left[p] + 1)}
    path = [node]
    while path[-1] in parent:
        path.append(int(parent[path[-1]]))
    return path[::-1]


# ---- Forests


@dataclass(frozen=True)
class Forest:
    """Trees as one node table: ``start`` has each tree's root, rows with a value above
    ``threshold`` go right of ``left``; missing values go left."""

    features: tuple[str, ...]
    start: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    NUMBERS = (("start", "<i8"), ("feature", "<i4"), ("threshold", "<f8"), ("left", "<i8"), ("value", "<f8"), ("gain", "<f8"))

    @classmethod
    def of(cls, trees: Sequence[Tree], cuts: Sequence[np.ndarray], features: Sequence[str]) -> Forest:
        start = np.cumsum([0, *(len(t.feature) for t in trees)])
        width = max((len(c) for c in cuts), default=0)
        table = np.array([np.pad(c, (0, width - len(c)), constant_values=np.nan) for c in cuts]).reshape(len(cuts), width)
        bins = np.concatenate([t.bin for t in trees]).astype(int)
        feature = np.concatenate([t.feature for t in trees]).astype(np.int32)
        inner = feature >= 0
        cut = np.zeros(len(feature))
        cut[inner] = table[feature[inner], bins[inner]]
        left = np.concatenate([np.where(t.left >= 0, t.left + s, -1) for t, s in zip(trees, start[:-1], strict=True)])
        value = np.concatenate([t.value for t in trees])
        # MLlib's weighting: a tree's gains are shares of its sum.
        gain = np.concatenate([t.gain / max(t.gain.sum(), 1e-300) for t in trees])
        return cls(tuple(features), start, feature, cut, left.astype(np.int64), value.astype(float), gain)

    @property
    def trees(self) -> int:
        return len(self.start) - 1

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the fall of the squared error, by trees."""
        inner = self.feature >= 0
        found = np.bincount(self.feature[inner], self.gain[inner], len(self.features))
        return found / found.sum() if found.sum() > 0 else found

    def steps(self, x: np.ndarray, node: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Walk ``node`` (changed in place) down for the rows at the same places; yields who moves, by which feature."""
        going = np.arange(len(node))
        while True:
            at = node[going]
            f = self.feature[at]
            more = f >= 0
            going, at, f = going[more], at[more], f[more]
            if not len(going):
                return
            yield going, f
            node[going] = self.left[at] + (x[row[going], f] > self.threshold[at])

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Prediction of every tree for every row."""
        row = np.repeat(np.arange(len(x)), self.trees)
        node = np.tile(self.start[:-1], len(x))
        for _ in self.steps(x, node, row):
            pass
        return self.value[node].reshape(len(x), self.trees)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row, written by Spark."""
        row = [list(self.features), *(getattr(self, c).astype(kind).tobytes() for c, kind in self.NUMBERS)]
        schema = "features array<string>, " + ", ".join(f"{c} binary" for c, _ in self.NUMBERS)
        spark.createDataFrame([tuple(row)], schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        row = spark.read.parquet(path).first()
        return cls(tuple(row["features"]), *(np.frombuffer(row[c], kind) for c, kind in cls.NUMBERS))


STEP = 512  # rows walked at a time


def voted(forest: Forest, x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    for i in range(0, len(x), STEP):
        yield slice(i, i + STEP), forest.votes(x[i : i + STEP])
