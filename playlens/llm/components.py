"""Connected components of an edge table, without moving edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are hung on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(least, "u").where(F.col("v") > F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(least.select("u", F.col("low").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``u``, ``v`` long): root is the component's smallest node.

    Alternating large and small stars until the edge table no longer
    changes.  The minimum of a node's neighbours is a partial aggregate and
    goes back by an equi-join, so a hub never sits in one task.  Each round
    is cut by a reliable checkpoint.  Self-loops and repeated edges are
    allowed; an empty edge table gives an empty result.
    """
    now = cut_lineage(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(now)
    while state[0]:
        now = cut_lineage(_small_star(_large_star(now).distinct()).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
