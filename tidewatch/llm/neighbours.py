"""Near-duplicate vectors by NN-descent over a neighbour graph.

Equal vectors of a label are one class and are compared once. Each class keeps a list of its
nearest classes. Sign codes of random directions seed the lists; then neighbours meet
their neighbours' neighbours at the class that they share, and better ones replace worse ones
until the links found no longer grow. A list that is full of links may hide more of
them, so wherever classes meet, links that connect all the linked ones are kept beside the lists;
whole components are then compared block by block and their links only counted. For each vector
length a sample is held against all others; where links were missed, seeding and descent go on
with other directions, and at last all vectors of a label are compared block by block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import dealt, table
from tidewatch.llm.components import components
from tidewatch.plans import stage

LEAST = 0.98
LIST = 8  # neighbours that a class keeps
TABLES = 8  # sign codes a round of seeding
BUCKET = 64  # classes of a code, about
GROUP = 256  # classes that meet in one task at once; larger groups are dealt out
ROUNDS = 8  # of descent at most
AUDIT = 256  # vectors held against all others
RECALL, RETRIES = 0.995, 4

# ---- Classes


def usable(vector: Column, label: Column) -> Column:
    """True for a labelled vector with a direction: finite components, not all zero."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & whole & some, F.lit(False))


def classes(rows: DataFrame) -> DataFrame:
    """``label, v, id, n``: distinct vectors of a label, their least ``vec_id`` and number."""
    return rows.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))


def _units(flat: np.ndarray, n: int) -> np.ndarray:
    x = np.asarray(flat, np.float64).reshape(n, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow on the way to the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _gathered(rows: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """``ids``, their vectors end to end in ``flat``, and further arrays, a row per group.

    The exchange is an explicit one: rows that a join has dealt by some of the keys would stay
    as they are, and all parts of a large group would be one task's.
    """
    found = rows.repartition(*keys).groupBy(*keys).agg(F.collect_list(F.struct("id", "v", *more)).alias("m"))
    return found.select(
        F.col("m.id").alias("ids"),
        F.flatten("m.v").alias("flat"),
        *[F.col(f"m.{c}").alias(c) for c in more],
    )


def _dealt_out(rows: DataFrame, keys: list[str], *seeds: int) -> DataFrame:
    """``salt`` such that no group of ``keys`` and salt is much over ``GROUP`` rows.

    The salt depends on the keys and ``seeds``, so other members meet each time, and the least
    id of a group has every salt, so its links hold the parts of a tight group together.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("shared"))
    parts = F.coalesce(F.ceil(F.col("members") / GROUP), F.lit(1)).cast("long")
    one = F.array(F.pmod(F.xxhash64("id", *keys, *map(F.lit, seeds)), parts))
    salts = F.when(F.col("id") == F.col("shared"), F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(one)
    joined = rows.join(dealt(sizes.filter(F.col("members") > GROUP)), keys, "left")
    return joined.withColumn("salt", F.explode(salts)).drop("members", "shared")


# ---- Neighbour lists

_PAIRS = "struct<a:array<long>,b:array<long>,s:array<double>>"


def _forest(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of links that connect all that a symmetric matrix of links connects."""
    new, a, b = np.ones(len(linked), bool), [], []
    for start in range(len(linked)):
        pending = [start] if new[start] else []
        new[start] = False
        while pending:
            at = pending.pop()
            near = np.flatnonzero(linked[at] & new).tolist()
            new[near] = False
            a += [at] * len(near)
            b += near
            pending += near
    return a, b


def _met(groups: DataFrame, keep: int, least: float) -> DataFrame:
    """``a, b, s``: for each member its ``keep`` most alike members that beat its ``bar``, and
    enough pairs that are ``least`` alike to connect all such members of the group."""

    @F.pandas_udf(_PAIRS)
    def meet(ids: pd.Series, flats: pd.Series, bars: pd.Series) -> pd.DataFrame:
        out = []
        for one, flat, bar in zip(ids, flats, bars, strict=True):
            one = np.asarray(one, np.int64)
            x = _units(flat, len(one))
            likeness = x @ x.T
            likeness[one[:, None] == one] = -2.0
            if len(one) > keep:
                best = np.argpartition(-likeness, keep - 1, axis=1)[:, :keep]
            else:
                best = np.tile(np.arange(len(one)), (len(one), 1))
            s = np.take_along_axis(likeness, best, axis=1)
            good = (s > np.asarray(bar, float)[:, None]) & (s > -1.5)
            i, j = _forest(likeness >= least)
            rows = np.append(np.nonzero(good)[0], np.array(i, np.int64))
            near = np.append(best[good], np.array(j, np.int64))
            out.append((one[rows], one[near], likeness[rows, near]))
        return pd.DataFrame(out, columns=["a", "b", "s"])

    found = groups.filter(F.size("ids") > 1).select(meet("ids", "flat", "bar").alias("p"))
    zipped = F.explode(F.arrays_zip("p.a", "p.b", "p.s"))
    return found.select(zipped.alias("p")).select("p.*")


def _lists(pairs: DataFrame) -> DataFrame:
    """``a, near``: the ``LIST`` best partners of each class, best first."""
    entry = F.struct(F.round(-F.col("s"), 12).alias("d"), F.col("b"))
    best = pairs.groupBy("a", "b").agg(F.max("s").alias("s")).groupBy("a").agg(F.array_sort(F.collect_list(entry)).alias("near"))
    return best.select("a", F.slice("near", 1, LIST).alias("near"))


def _edges(lists: DataFrame) -> DataFrame:
    return lists.select("a", F.explode("near").alias("e")).select("a", F.col("e.b").alias("b"), (-F.col("e.d")).alias("s"))


def seeded(found: DataFrame, total: int, dims: int, seed: int, least: float) -> DataFrame:
    """Pairs ``a, b, s`` of classes with the same sign code, over ``TABLES`` codes."""
    bits = max(1, int(np.ceil(np.log2(max(2, total / BUCKET)))))
    planes = np.random.default_rng(seed).normal(size=(dims, TABLES * bits))
    weights = 1 << np.arange(bits, dtype=np.int64)

    @F.pandas_udf("array<long>")
    def codes(vectors: pd.Series) -> pd.Series:
        x = np.stack([np.asarray(v, float) for v in vectors])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        signs = (x @ planes > 0).reshape(len(x), TABLES, bits)
        return pd.Series(list((signs * weights).sum(axis=2)))

    keyed = found.select("id", "v", "label", F.posexplode(codes("v")).alias("t", "code"))
    groups = _dealt_out(keyed.withColumn("bar", F.lit(-1.0)), ["label", "t", "code"], seed)
    return _met(_gathered(groups, ["label", "t", "code", "salt"], "bar"), LIST, least)


def descend(found: DataFrame, lists: DataFrame, seed: int, turn: int, least: float) -> DataFrame:
    """One round: pairs ``a, b, s`` of the members of the lists around each class, which meet there."""
    full = F.when(F.size("near") >= LIST, -F.element_at("near", -1)["d"]).otherwise(-1.0)
    bars = lists.select(F.col("a").alias("id"), full.alias("bar"))
    edges = _edges(lists).select("a", "b")
    around = (
        edges.select(F.col("a").alias("pivot"), F.col("b").alias("id"))
        .unionByName(edges.select(F.col("b").alias("pivot"), F.col("a").alias("id")))
        .distinct()
    )
    members = _dealt_out(around, ["pivot"], seed, turn).join(found.select("id", "v"), "id").join(bars, "id", "left")
    return _met(_gathered(members.fillna(-1.0, ["bar"]), ["pivot", "salt"], "bar"), LIST, least)


def neighbour_lists(
    found: DataFrame, total: int, dims: int, seed: int, before: DataFrame | None, least: float
) -> tuple[DataFrame, DataFrame]:
    """Lists after seeding and as many rounds of descent as find new links, and ``a, b``: links
    that connect all the linked classes that met, also where a list has no place for them."""
    pairs = stage(seeded(found, total, dims, seed, least), "pairs")
    links = pairs.filter(F.col("s") >= least).select("a", "b")
    if before is not None:
        pairs = pairs.unionByName(_edges(before))
    lists = stage(_lists(pairs), "lists")
    known = -1
    for turn in range(ROUNDS):
        now = _edges(lists).filter(F.col("s") >= least).count()
        if now == known:
            break
        known = now
        pairs = stage(descend(found, lists, seed, turn, least), "pairs")
        links = links.unionByName(pairs.filter(F.col("s") >= least).select("a", "b"))
        lists = stage(_lists(_edges(lists).unionByName(pairs)), "lists")
    return lists, links


# ---- Links


def _held_together(members: DataFrame, least: float) -> DataFrame:
    """``id, links, a, b`` arrays: every two members ``id, v, n`` of a ``component`` are compared.

    Members of a component are dealt into blocks, and every two blocks meet in a row of
    their own, which gives the counts of each member's links, and links that connect all linked ones.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("blocks"))
    blocks = (
        members.join(dealt(sizes), "component")
        .withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )
    paired = _gathered(blocks, ["component", "low", "high"], "n", "block")

    @F.pandas_udf("struct<id:array<long>,links:array<long>,a:array<long>,b:array<long>>")
    def count(ids: pd.Series, flats: pd.Series, ns: pd.Series, of: pd.Series) -> pd.DataFrame:
        out = []
        for one, flat, n, block in zip(ids, flats, ns, of, strict=True):
            one, n, block = np.asarray(one), np.asarray(n), np.asarray(block)
            x = _units(flat, len(one))
            linked = x @ x.T >= least
            if block.min() != block.max():  # within a block they meet elsewhere
                linked &= block[:, None] != block
            linked &= one[:, None] != one
            i, j = _forest(linked)
            out.append((one, linked @ n, one[i], one[j]))
        return pd.DataFrame(out, columns=["id", "links", "a", "b"])

    return paired.select(count("ids", "flat", "n", "block").alias("c")).select("c.*")


def _summed(compared: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("id", "links"))
    return compared.select(zipped.alias("c")).select("c.*").groupBy("id").agg(F.sum("links").alias("links"))


def linked_counts(found: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """``id, links``: how many vectors of other classes in its component each class links."""
    members = found.join(groups, found["id"] == groups["node"]).select("id", "v", "n", "component")
    return _summed(_held_together(members, least))


def all_compared(found: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Groups ``node, component`` and counts ``id, links``, from every two classes of a label."""
    compared = stage(_held_together(found.select("id", "v", "n", F.col("label").alias("component")), least), "compared")
    links = compared.select(F.explode(F.arrays_zip("a", "b")).alias("e")).select("e.*")
    return stage(components(links, "a", "b"), "groups"), stage(_summed(compared), "counts")


def searched(found: DataFrame, total: int, dims: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Groups ``node, component`` and counts ``id, links`` of classes of one length.

    Where ``RETRIES`` searches stay short of the audit's links, all classes of a label are compared.
    """
    lists = links = None
    for attempt in range(RETRIES):
        lists, more = neighbour_lists(found, total, dims, 11 + attempt, lists, least)
        links = more if links is None else links.unionByName(more)
        groups = stage(components(links, "a", "b"), "groups")
        counts = stage(linked_counts(found, groups, least), "counts")
        known, there = audited(found, counts, least)
        if known >= RECALL * there:
            return groups, counts
    return all_compared(found, least)


def audited(found: DataFrame, counts: DataFrame, least: float) -> tuple[int, int]:
    """Links found and links there are, for a sample of classes held against all others."""
    asked = found.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(AUDIT).select("id", F.xxhash64("label").alias("label"), "v").collect()
    if not asked:
        return 0, 0
    ids = np.array([r["id"] for r in asked])
    labels = np.array([r["label"] for r in asked])
    x = _units(np.array([r["v"] for r in asked]).ravel(), len(asked))

    @F.pandas_udf("long")
    def count(other: pd.Series, label: pd.Series, vectors: pd.Series, n: pd.Series) -> pd.Series:
        y = _units(np.concatenate([np.asarray(v) for v in vectors]), len(vectors))
        linked = (y @ x.T >= least) & (label.to_numpy()[:, None] == labels)
        linked &= other.to_numpy()[:, None] != ids
        return pd.Series(linked.sum(axis=1) * n.to_numpy())

    there = found.agg(F.sum(count("id", F.xxhash64("label"), "v", "n"))).first()[0]
    known = counts.filter(F.col("id").isin([int(i) for i in ids])).agg(F.sum("links")).first()[0]
    return int(known or 0), int(there or 0)


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` with one row per row of ``vectors``.

    Vectors link when their labels are equal and not NULL and their cosine is at least
    ``least``; a NULL, zero or non-finite vector links with nothing, nor does one of another
    length. Rows with a NULL ``vec_id`` link with nothing and are not kept. Equal vectors link
    with each other; a ``vec_id`` that repeats is a vector of its own each time.
    """
    ok = usable(F.col("embedding"), F.col("label")) & F.col("vec_id").isNotNull()
    rows = vectors.select(
        "vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").alias("v"), ok.alias("ok")
    )
    rows = rows.withColumn("label", F.concat_ws(":", F.size("v"), "label"))  # only equal lengths meet
    good = rows.filter("ok").drop("ok")
    found = stage(classes(good), "classes")
    shape = found.groupBy(F.size("v").alias("dims")).count().collect()  # a row per vector length
    counts = groups = None
    for r in shape:
        mine, links = searched(found.filter(F.size("v") == r["dims"]), r["count"], r["dims"], least)
        groups = mine if groups is None else groups.unionByName(mine)
        counts = links if counts is None else counts.unionByName(links)
    if counts is None:
        named = found.select("label", "v", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    else:
        named = (
            found.join(counts, "id", "left")
            .join(groups.withColumnRenamed("node", "id"), "id", "left")
            .select(
                "label",
                "v",
                (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"),
            )
        )
    alone = rows.filter("NOT ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    together = good.join(stage(named, "named"), ["label", "v"]).select("vec_id", "n_links", "component_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return together.unionByName(alone).withColumn("kept", kept)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
