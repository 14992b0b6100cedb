"""Near-duplicates by SimHash, found with BK-trees.

A document's fingerprint has a bit set where more than half of its word shingles have
it. Documents whose fingerprints differ in at most ``radius`` bits are linked.

The search runs over distinct fingerprints. Cut into ``parts`` parts, two fingerprints
within the radius agree on at least ``parts - radius`` of them, so every choice of that
many parts gives shards that together hold each link. A shard's BK-tree, children keyed by
their distance to the parent, is followed only along edges within the radius. A shard
of more than ``SHARD`` fingerprints is cut into blocks and its trees are copied to
each block's queries. A tree reports a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import dealt, table
from tidewatch.llm.components import components
from tidewatch.plans import stage

BITS = 64
RADIUS = 3
SEED = 42
SHINGLE = 3
PARTS = 5
SHARD = 2048  # fingerprints of one tree
_STEP = 1 << 16  # shingles hashed at a time

# ---- Fingerprints


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of each word shingle, repeats included, some at a time; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    for i in range(0, len(starts), _STEP):
        pairs = zip(starts[i : i + _STEP], ends[i : i + _STEP], strict=True)
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)


def simhash(parts: Iterable[np.ndarray]) -> int:
    """Unsigned fingerprint of shingle hashes; 0 where there is none."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in parts:
        rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big") if n else 0


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        bits = np.array([simhash(shingle_hashes(t, shingle)) for t in texts], dtype=np.uint64)
        return pd.Series(bits.view(np.int64))

    return run(text)


def as_hex(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


# ---- BK-trees


class Tree:
    """BK-tree over distinct fingerprints; ``children[i]`` maps a distance to a node."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.children: list[dict[int, int]] = [{} for _ in prints]
        pending = [(0, np.arange(1, len(prints)))] if len(prints) else []
        while pending:
            node, below = pending.pop()
            distance = np.bitwise_count(prints[below] ^ prints[node])
            for d in np.unique(distance):
                same = below[distance == d]
                self.children[node][int(d)] = int(same[0])
                if len(same) > 1:
                    pending.append((int(same[0]), same[1:]))

    def within(self, queries: np.ndarray, radius: int):
        """Yield a node and the queries within the radius of it, for every node met."""
        pending = [(0, np.arange(len(queries)))] if len(self.prints) else []
        while pending:
            node, asked = pending.pop()
            distance = np.bitwise_count(queries[asked] ^ self.prints[node]).astype(np.int64)
            yield node, asked[distance <= radius]
            for edge, child in self.children[node].items():
                follow = np.abs(distance - edge) <= radius
                if follow.any():
                    pending.append((child, asked[follow]))


def forest(tree: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``tree`` and ``queries`` reduced to ``(fingerprint, root)`` of each group."""
    everything, place = np.unique(np.concatenate((tree, queries)), return_inverse=True)
    of_tree, of_query = place[: len(tree)], place[len(tree) :]
    label = np.arange(len(everything))
    for node, near in Tree(tree).within(queries, radius):
        met = np.unique(label[np.append(of_query[near], of_tree[node])])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return everything[moved], everything[label[moved]]


# ---- Groups


def shards(prints: DataFrame, bits: str, radius: int, parts: int) -> DataFrame:
    """``tree, queries`` arrays of fingerprints that cover every pair within the radius."""
    edges = [round(i * BITS / parts) for i in range(parts + 1)]
    masks = [
        sum(((1 << (edges[p + 1] - edges[p])) - 1) << edges[p] for p in chosen)
        for chosen in combinations(range(parts), parts - radius)
    ]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(
        *[F.struct(F.lit(i).alias("t"), F.col(bits).bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)]
    )
    keyed = prints.select(bits, F.explode(keys).alias("s")).select(bits, "s.t", "s.k")
    return dealt_shards(keyed, bits)


def dealt_shards(keyed: DataFrame, bits: str, *more: str) -> DataFrame:
    """``tree, queries``: fingerprints, and ``more`` of them, that share a key ``t, k``.

    A key of more than ``SHARD`` rows is cut into blocks, every two of which meet in a row.
    """
    shared = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    entry = F.struct(F.col(bits).alias("bits"), *more) if more else F.col(bits)
    return (
        keyed.join(dealt(shared), ["t", "k"])
        .withColumn("blocks", F.ceil(F.col("n") / F.lit(SHARD)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64(bits, *more, F.lit(SEED)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        # Without this exchange the blocks of a key would stay in the task of the join on the key.
        .repartition("t", "k", "low", "high")
        .groupBy("t", "k", "low", "high")
        .agg(
            F.collect_list(F.when(F.col("block") <= F.col("other"), entry)).alias("tree"),
            F.collect_list(F.when(F.col("block") >= F.col("other"), entry)).alias("queries"),
        )
        .select("tree", "queries")
    )


def links(prints: DataFrame, bits: str, radius: int = RADIUS, parts: int = PARTS) -> DataFrame:
    """``a, b``: enough links between distinct fingerprints to connect all that are linked."""
    if not 0 <= radius < parts:
        raise ValueError("parts must exceed the radius")

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def search(trees: pd.Series, queries: pd.Series) -> pd.Series:
        out = []
        for tree, asked in zip(trees, queries, strict=True):
            tree, asked = (np.asarray(x, np.int64).view(np.uint64) for x in (tree, asked))
            a, b = forest(tree, asked, radius)
            out.append([{"a": x, "b": y} for x, y in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist())])
        return pd.Series(out)

    found = shards(prints, bits, radius, parts).select(F.explode(search("tree", "queries")).alias("e"))
    return found.select("e.*").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, bits, fingerprint, component_id`` with one row per row of ``docs``.

    ``component_id`` is the least ``doc_id`` reachable over links. Rows with a NULL
    ``doc_id`` link like others and never name a component that has another row.
    """
    hashed = stage(docs.select("doc_id", fingerprint(docs["text"], shingle).alias("bits")), "simhash")
    prints = stage(hashed.groupBy("bits").agg(F.min("doc_id").alias("least")), "prints")
    groups = components(links(prints, "bits", radius), "a", "b")
    named = (
        prints.join(dealt(groups), F.col("bits") == F.col("node"), "left")
        .select("bits", "least", F.coalesce("component", "bits").alias("root"))
    )
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(named.join(dealt(names), "root").select("bits", "component_id"), "classes")
    return hashed.join(classes, "bits").select("doc_id", "bits", as_hex(F.col("bits")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The row with the least ``doc_id`` of every group, all columns kept; the others go.

    Of several rows with that ``doc_id`` the first in the order of their plain columns stays. Rows
    with a NULL ``doc_id`` cannot be named, so they take no part and stay.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    firsts = near_duplicates(named, radius, shingle).filter("doc_id = component_id").select("doc_id").distinct()
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    order = F.struct(*[F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, nested)])
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("row")
    kept = named.join(dealt(firsts), "doc_id", "left_semi").groupBy("doc_id").agg(row)
    return kept.select("row.*").unionByName(docs.filter(F.col("doc_id").isNull()))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
