"""Whitening of vectors by their leading principal components.

Entries become whole numbers, so sums over rows are exact and every row is centred before
anything is multiplied. The covariance is never formed: each pass over the rows multiplies it
with a block of vectors, ``X'(XQ)``, as partial sums of a task that Spark adds up. The block is
a little wider than the number of components. A Chebyshev polynomial of the covariance, built by
its three-term recurrence at one pass a degree, damps the spectrum below the block's smallest
Ritz value; QR and Rayleigh-Ritz follow, until the residuals certify the components and a search
outside of them finds no larger eigenvalue. Only blocks and sums per dimension reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.plans import stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 46)  # entries from here on have no exact whole number
DEGREE = 10  # passes of one filter
ROUNDS = 40
TOLERANCE = 1e-13  # residual over the largest eigenvalue
STALLED = 1e-9  # accepted where rounding forbids more
NO_VARIANCE = 1e-12  # eigenvalue over the largest below which a component is flat
SEED = 11


@dataclass(frozen=True)
class Sums:
    """Of ``n`` rows: exact sums, least and largest entry per dimension."""

    n: int
    sums: tuple[int, ...]
    least: tuple[int, ...]
    largest: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        """Whole part of the means."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def part(self) -> np.ndarray:
        """What the means have beyond it."""
        return np.array([(s % self.n) / self.n for s in self.sums])


@dataclass(frozen=True)
class Basis:
    """Unit components as columns, their eigenvalues, and the trace of the covariance."""

    sums: Sums
    components: np.ndarray
    values: np.ndarray
    trace: float
    passes: int


# ---- Rows


def whole_vectors(df: DataFrame, row: str, vector: str) -> DataFrame:
    """``row, x`` with ``x = floor(64 c) + 1000000`` for the rows that have a usable vector.

    Left out: NULL vectors, those with NULL, non-finite or (from 2**46 on) inexact entries, empty
    ones, and vectors of another length than the most frequent one (the longer one on ties).
    """
    known = F.col("v").isNotNull() & (F.size("v") > 0)
    usable = F.forall("v", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)) & ~F.isnan(c))
    rows = df.select(F.col(row), F.col(vector).cast("array<double>").alias("v")).filter(known & usable)
    x = F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT)
    rows = stage(rows.select(row, x.alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    found = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("x") == found[0]["d"]) if found else rows


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[np.ndarray]:
    """The vectors of a task; empty batches are skipped."""
    for batch in batches:
        if batch.num_rows:
            yield _matrix(batch.column(name))


def sums(x: DataFrame) -> Sums | None:
    """None for an empty table. High and low halves are added apart, so nothing overflows."""

    def run(batches):
        found = None
        for rows in _blocks(batches, "x"):
            new = [len(rows), (rows >> 32).sum(0), (rows & 0xFFFFFFFF).sum(0), rows.min(0), rows.max(0)]
            if found:
                new = [
                    found[0] + new[0], found[1] + new[1], found[2] + new[2],
                    np.minimum(found[3], new[3]), np.maximum(found[4], new[4]),
                ]
            found = new
        if found:
            d = len(found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, found[0], np.int64)), *map(pa.array, found[1:])],
                ["i", "n", "high", "low", "least", "largest"],
            )

    parts = x.select("x").mapInArrow(run, "i int, n long, high long, low long, least long, largest long")
    exact = (F.sum(F.col("high").cast("decimal(38,0)")) * 4294967296 + F.sum("low")).alias("sum")
    total = parts.groupBy("i").agg(F.sum("n").alias("n"), exact, F.min("least").alias("least"), F.max("largest").alias("largest"))
    rows = total.orderBy("i").collect()
    if not rows:
        return None
    return Sums(rows[0]["n"], *(tuple(int(r[c]) for r in rows) for c in ("sum", "least", "largest")))


# ---- Passes


def _added(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape)
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def _cells(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(matrix.shape, dtype=np.int32)
    return pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(matrix.ravel())], ["i", "j", "v"])


class Covariance:
    """The covariance of the rows as a product with blocks of vectors, one pass each."""

    def __init__(self, x: DataFrame, of: Sums):
        self.x, self.of, self.passes, self.trace = x, of, 0, None
        self.d = len(of.sums)

    def __call__(self, block: np.ndarray) -> np.ndarray:
        """``V @ block``; sums of squares per dimension ride along as one more column."""
        whole, part, width = self.of.whole, self.of.part, block.shape[1]

        def run(batches):
            total = None
            for rows in _blocks(batches, "x"):
                centred = (rows - whole).astype(np.float64) - part
                new = np.column_stack([centred.T @ (centred @ block), np.square(centred).sum(0)])
                total = new if total is None else total + new
            if total is not None:
                yield _cells(total)

        parts = self.x.select("x").mapInArrow(run, "i int, j int, v double")
        out = _added(parts, (self.d, width + 1)) / self.of.n
        self.passes += 1
        self.trace = float(out[:, width].sum())
        return out[:, :width]


def filtered(v: Covariance, block: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """Chebyshev polynomial of ``v`` that is small on ``low..cut``, scaled to 1 at ``top``."""
    centre, half = (low + cut) / 2, (cut - low) / 2
    first = half / (top - centre)
    scale, older = first, block
    newer = (v(block) - centre * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        latest = (v(newer) - centre * newer) * (2 * following / half) - (scale * following) * older
        older, newer, scale = newer, latest, following
    return newer


def _krylov(v: Covariance, block: np.ndarray, outside: np.ndarray | None, steps: int) -> tuple[float, float]:
    """Least and largest Ritz value over a block Krylov space, less and more their residuals.

    With ``outside``, the space is kept orthogonal to those columns.
    """
    space, images = np.zeros((v.d, 0)), np.zeros((v.d, 0))
    for _ in range(steps):
        for _ in range(2):
            for known in (space, outside):
                if known is not None and known.shape[1]:
                    block = block - known @ (known.T @ block)
        q, r = np.linalg.qr(block)
        q = q[:, np.abs(np.diag(r)) > 1e-10 * max(1e-300, np.abs(r).max())]
        q = q[:, : v.d - space.shape[1] - (0 if outside is None else outside.shape[1])]
        if not q.shape[1]:
            break
        image = v(q)
        space, images = np.column_stack([space, q]), np.column_stack([images, image])
        block = image
    if not space.shape[1]:
        return 0.0, 0.0
    if outside is not None:
        images = images - outside @ (outside.T @ images)
    values, turn = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
    rest = np.linalg.norm(images @ turn - space @ turn * values, axis=0)
    return float(values[0] - rest[0]), float(values[-1] + rest[-1])


def fit(x: DataFrame, components: int = COMPONENTS, of: Sums | None = None) -> Basis | None:
    """Leading components of the covariance of ``x``; None for an empty table.

    The block has half as many columns again. Stops when every residual is within
    ``TOLERANCE`` of the largest eigenvalue, or within ``STALLED`` and no longer falling, and
    no larger eigenvalue shows outside of the components; raises after ``ROUNDS`` filters.
    """
    of = of or sums(x)
    if of is None:
        return None
    v = Covariance(x, of)
    k = min(components, v.d)
    width = min(v.d, k + max(8, k // 2))
    draw = np.random.default_rng(SEED)
    block = np.linalg.qr(draw.standard_normal((v.d, width)))[0]
    low, last, pending = None, np.inf, None
    for _ in range(ROUNDS):
        block, values, images = _ritz(v, block)
        top = max(float(values[0]), 0.0)
        rest = float(np.linalg.norm(images[:, :k] - block[:, :k] * values[:k], axis=0).max())
        done = rest <= TOLERANCE * top or rest <= STALLED * top and rest > last / 2
        if done and width < v.d:
            start = np.column_stack([block[:, k:], draw.standard_normal((v.d, 4))])
            outside = _krylov(v, start, block[:, :k], 2)[1]
            done = outside <= values[k - 1] + max(rest, 1e-9 * top)
        if done:
            return Basis(of, block[:, :k], values[:k], v.trace, v.passes)
        last = rest
        if low is None:
            low, pending = _krylov(v, draw.standard_normal((v.d, min(8, v.d))), None, 6)
        top, cut = max(top, pending), float(values[-1])
        floor = max(0.0, min(low, cut - 1e-3 * top))
        block = np.linalg.qr(filtered(v, block, floor, max(cut, floor + 1e-6 * top), top, DEGREE))[0]
    raise RuntimeError(f"components not certified after {ROUNDS} rounds: residual {rest}, largest value {top}")


def _ritz(v: Covariance, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: the block turned, its values falling, and its image, for one pass."""
    image = v(block)
    inner = block.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    turn = turn[:, ::-1]
    return block @ turn, values[::-1], image @ turn


# ---- Results


def whitened(x: DataFrame, row: str, basis: Basis) -> DataFrame:
    """``row, deviation, whitened``: the sum of ``(n x - S)**2``, and a value per component.

    ``deviation`` is exact; it is NULL where it does not fit into a long. A component without
    variance is 0 in every row.
    """
    of = basis.sums
    n, whole, part = of.n, of.whole, of.part
    rest = np.array([s % n for s in of.sums], np.int64 if n < 1 << 62 else object)
    flat = basis.values <= NO_VARIANCE * max(float(basis.values[0]), 0.0)
    turn = basis.components / np.where(flat, 1.0, np.sqrt(np.where(flat, 1.0, basis.values)))
    turn[:, flat] = 0.0
    reach = max(n * max(b - int(w), int(w) - a) + n for a, b, w in zip(of.least, of.largest, whole, strict=True))
    fits = reach * reach * len(whole) < 1 << 63
    kind = x.schema[row].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("x")) - whole
            if fits:
                deviation = pa.array(np.square(rows * n - rest).sum(1))
            else:
                exact = np.square(rows.astype(object) * n - rest.astype(object)).sum(1)
                deviation = pa.array([int(e) if e < 1 << 63 else None for e in exact], pa.int64())
            out = (rows.astype(np.float64) - part) @ turn
            lists = pa.ListArray.from_arrays(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1], out.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(row), deviation, lists], [row, "deviation", "whitened"])

    return x.select(row, "x").mapInArrow(run, f"`{row}` {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, basis: Basis) -> float:
    """Largest entry of the covariance of ``whitened`` less the identity, by size.

    Taken from the values themselves in two passes; components without variance do not count.
    """
    n, k = basis.sums.n, len(basis.values)

    def means(batches):
        total = sum((rows.sum(0) for rows in _blocks(batches, "whitened")), np.zeros(k))
        yield _cells(total.reshape(1, -1))

    mean = _added(white.select("whitened").mapInArrow(means, "i int, j int, v double"), (1, k))[0] / n

    def products(batches):
        total = np.zeros((k, k))
        for rows in _blocks(batches, "whitened"):
            total += (rows - mean).T @ (rows - mean)
        yield _cells(total)

    found = _added(white.select("whitened").mapInArrow(products, "i int, j int, v double"), (k, k)) / n
    seen = basis.values > NO_VARIANCE * max(float(basis.values[0]), 0.0)
    left = np.abs(found - np.eye(k))[np.ix_(seen, seen)]
    return float(left.max()) if left.size else 0.0


def whitened_rows(df: DataFrame, row: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, with ``n``, ``explained`` and ``identity_error``.

    NULL ids and repeated rows are rows of their own; further columns are ignored. An empty
    table gives an empty result, one without variance NULL ``explained`` and 0 ``whitened``.
    """
    x = whole_vectors(df, row, vector)
    basis = fit(x, components)
    if basis is None:
        out = x.select(row, *[F.lit(None).cast(kind).alias(name) for name, kind in _REST])
        return out.limit(0)
    white = stage(whitened(x, row, basis), "whitened")
    error = identity_error(white, basis)
    share = [float(e) / basis.trace if basis.trace > 0 else None for e in basis.values]
    explained = F.array(*[F.lit(s).cast("double") for s in share])
    cells = white.select(row, "deviation", F.posexplode("whitened").alias("at", "value"))
    return cells.select(
        row,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(basis.sums.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


_REST = [
    ("component", "int"), ("n", "long"), ("deviation", "long"),
    ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
]


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on up to 32 whitened components."""
    return whitened_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
