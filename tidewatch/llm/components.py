"""Connected components of a link table, by alternating star contractions.

Each round points every node at the least node it can see (first from larger
neighbours, then from smaller ones); the number of rounds grows with the logarithm of
the longest path. Links live in staged tables only, never on the driver. Minima are
aggregated before the shuffle, and the joins that hand them out have a plain exchange on
both sides, so adaptive execution can split the partition of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import dealt
from tidewatch.plans import stage

MAX_ROUNDS = 60


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node of a link between different nodes.

    ``component`` is the least node reachable. Loops and links with a NULL end are
    ignored; repeated links count once; an empty table gives an empty result.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = stage(
        links.filter(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        .distinct(),
        "links",
    )
    state = _checksum(edges)
    for _ in range(MAX_ROUNDS):
        edges = stage(_small_star(_large_star(edges)), "links")
        before, state = state, _checksum(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("v").alias("n"), F.col("v").alias("w")).unionByName(
        edges.select(F.col("u").alias("n"), F.col("v").alias("w"))
    )
    least = ends.groupBy("n").agg(F.min("w").alias("m"))
    moved = edges.join(dealt(least), F.col("v") == F.col("n"))
    return moved.select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    edges = stage(edges, "links")
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = (
        edges.join(dealt(least.withColumnRenamed("u", "n")), F.col("u") == F.col("n"))
        .filter(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return least.select("u", F.col("m").alias("v")).unionByName(others).distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
    )
