"""Mix sources to target weights by balanced sampling with the cube method.

Every document of a source is wanted ``rate`` times, the source's target over its size.
The whole part is taken outright; the fraction is an inclusion probability. The flight
phase moves the probabilities of a block of documents along vectors of the null space
of two constraints, the number of documents and the number of words, until all but
a few documents are decided; both totals stay as they were at every step.
Undecided documents of several blocks meet in the blocks of the next level, so a hot
source is never in one task. The last block of a source stops at a few undecided
documents, and the landing phase rounds these to the whole numbers that leave its words
nearest to the target.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, table
from tidewatch.plans import stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
BLOCK = 256  # documents per flight
REST = 6  # documents at most that other blocks leave undecided
LANDING = 12  # documents of a source at most that the landing rounds
_EPS = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: words of each whole text, 0 where it is NULL."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"))


def targets(
    sized: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """``source, source_size, target`` with one row per source.

    Sources in order of code points, NULL last, get the weights in turn. They share
    ``share`` times all words; a target stops at ``most`` times its source's size and
    the excess is shared by weight among the others. With sources ordered by size over
    weight the stopped ones come first, so one running sum finds them. The window runs
    over one row per source, never over documents.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    ratio = F.col("source_size") / F.col("weight")
    by_ratio = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(everything) - F.lit(most) * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    level = left / F.sum("weight").over(after)
    cap = F.lit(most) * F.col("source_size")
    return (
        total.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
        .withColumn("level", level)
        # Up to the first source whose cap lies above its level all are stopped; from
        # there on that level holds.
        .withColumn("free", cap > F.col("level") * F.col("weight"))
        .withColumn("first", F.min(F.when(F.col("free"), ratio)).over(everything))
        .withColumn("shared", F.min(F.when(F.col("free"), F.struct(ratio, "level"))).over(everything))
        .select(
            "source",
            "source_size",
            F.when(ratio < F.col("first"), cap)
            .when(F.col("first").isNull(), cap)
            .otherwise(F.least(cap, F.col("shared.level") * F.col("weight")))
            .cast("double")
            .alias("target"),
        )
    )


def mixed(docs: DataFrame, seed: int = 17, **aims) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per document.

    ``copies`` is how often the document enters the mix, ``taken`` its words there.
    Documents without words take part in no constraint and get 0 copies where their
    source's target is 0, else the whole part of the rate. Repeated rows are documents
    of their own. The result depends on the rows and the seed alone.
    """
    sized = stage(sizes(docs), "sizes")
    aim = stage(targets(sized, **aims), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = (
        sized.alias("d")
        .join(aim.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target")
        .withColumn("base", F.floor(rate + _EPS).cast("int"))
        .withColumn("p", F.greatest(rate - F.col("base"), F.lit(0.0)))
        .withColumn("p", F.when((F.col("p") < _EPS) | (F.col("size") == 0), 0.0).otherwise(F.col("p")))
    )
    # As text, ids pass through pandas with their NULLs and all their digits.
    rated = rated.withColumn("doc_id", F.col("doc_id").cast("string"))
    open_ = F.col("p") > 0
    fixed = rated.filter(~open_).withColumn("extra", F.lit(0)).drop("p")
    undecided = rated.filter(open_)
    counts = _waiting(undecided)
    decided = fixed
    level = 0
    while True:
        blocks = F.ceil(F.col("n") / BLOCK).cast("long")
        flown = stage(
            undecided.alias("u")
            .join(counts.alias("c"), F.col("u.source").eqNullSafe(F.col("c.source")))
            .withColumn(
                "block", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed + level)), blocks)
            )
            .select("u.*", "block", (F.col("n") <= BLOCK).alias("last"))
            .groupBy("source", "block")
            .applyInPandas(_flight(seed), _FLOWN),
            "flown",
        )
        decided = decided.unionByName(flown.filter("NOT open").select(*fixed.columns))
        undecided = flown.filter("open").drop("open", "extra")
        counts = _waiting(undecided)
        if counts.isEmpty():
            break
        level += 1
    copies = F.col("base") + F.col("extra")
    return decided.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "source",
        "size",
        "source_size",
        "target",
        copies.cast("int").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def _waiting(undecided: DataFrame) -> DataFrame:
    return stage(undecided.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "waiting")


_FLOWN = (
    "doc_id string, source string, size long, source_size long, target double, base int, "
    "p double, open boolean, extra int"
)


def _flight(seed: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        last = bool(block["last"].iloc[0])
        block = block.sort_values(["doc_id", "size", "p"], kind="stable", ignore_index=True)
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(block))
        size = block["size"].to_numpy(float)[order]
        p = fly(block["p"].to_numpy(float)[order], size, rng, LANDING if last else REST)
        if last:
            p = land(p, size)
        block.loc[order, "p"] = p
        block["open"] = (block["p"] > 0) & (block["p"] < 1)
        block["extra"] = np.where(block["p"] >= 1, 1, 0)
        return block[[f.split()[0] for f in _FLOWN.split(", ")]]

    return run


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, keep: int = 2) -> np.ndarray:
    """Flight phase for the totals of documents and words; at most ``keep`` stay undecided.

    Three undecided documents always have a direction that changes neither total. The
    probabilities move along it, forwards or backwards, until one of the three is 0 or 1;
    the way is drawn so that the expected move is nil and every document keeps its
    probability.
    """
    p = p.copy()
    waiting = list(np.flatnonzero((p > 0) & (p < 1)))[::-1]
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) + len(waiting) <= keep:
            return p
        a, b, c = active
        way = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]])
        if not way.any():  # equal sizes: shift between two of them
            way = np.array([1.0, -1.0, 0.0])
        now = p[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(way > 0, (1 - now) / way, np.where(way < 0, -now / way, np.inf)).min()
            down = np.where(way > 0, now / way, np.where(way < 0, (now - 1) / way, np.inf)).min()
        now = now + way * (up if rng.random() * (up + down) < down else -down)
        now[now < _EPS] = 0.0
        now[now > 1 - _EPS] = 1.0
        p[active] = now
        active = [i for i in active if 0 < p[i] < 1]


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round what the flight left so that first the words, then the documents come nearest
    to their expected numbers; all roundings of these few are tried."""
    p = p.copy()
    rest = np.flatnonzero((p > 0) & (p < 1))
    choices = np.arange(1 << len(rest))[:, None] >> np.arange(len(rest)) & 1
    words = np.abs(choices @ size[rest] - p[rest] @ size[rest])
    documents = np.abs(choices.sum(axis=1) - p[rest].sum())
    p[rest] = choices[np.lexsort((documents, words))[0]]
    return p


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all its columns kept.

    Rows that agree in ``doc_id``, source and size are interchangeable; their copies are
    dealt to them in one order of the text.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    picks = (
        mixed(docs, **options)
        .groupBy("doc_id", "source", "size")
        .agg(F.sort_array(F.collect_list("copies")).alias("copies"))
    )
    left = docs.select(F.struct(*docs.columns).alias("row"), words.alias("size"))
    same = (
        left["row"]["doc_id"].eqNullSafe(picks["doc_id"])
        & left["row"]["source"].eqNullSafe(picks["source"])
        & (left["size"] == picks["size"])
    )
    joined = left.join(picks, same).select("row", "copies")
    single = joined.filter(F.size("copies") == 1).select("row", F.col("copies")[0].alias("n"))
    nth = F.row_number().over(
        Window.partitionBy("row.doc_id", "row.source", F.size("copies")).orderBy("row.text")
    )
    several = joined.filter(F.size("copies") > 1)
    several = several.select("row", F.element_at("copies", nth).alias("n"))
    return (
        single.unionByName(several)
        .filter(F.col("n") > 0)
        .select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))
        .select("row.*")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


