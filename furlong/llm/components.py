"""Connected components of an edge table, by alternating star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: link each node's larger (or smaller) neighbours to the least of its neighbourhood.

    The least neighbour is a partial aggregate and comes back by a join, so a
    node of very many neighbours is never one task's group.
    """
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    joined = near.join(least, F.col("a") == F.col("k"))
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("k"), F.col("m")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the least node that it is connected with.

    Edges in which both ends are equal are ignored; direction and repeats do
    not matter.  The lineage is cut by a checkpoint in the shared folder after
    each round; the driver sees a count and a hash.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("a", "b").where(F.col("a") != F.col("b")).distinct().checkpoint()
    state = _state(edges)
    while state[0]:
        edges = _star(_star(edges, True), False).checkpoint()
        after = _state(edges)
        if after == state:
            break
        state = after
    # Every node but the roots is now the larger end of one edge to its root.
    linked = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return linked.union(linked.select("root", "root").distinct())
