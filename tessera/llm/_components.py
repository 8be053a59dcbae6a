"""Connected components of an edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import release, write_through


def _star(both: DataFrame, moved, rows: int) -> DataFrame:
    """Every node, and those of its neighbours for which ``moved`` holds, tied to the least around it."""
    least = write_through(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
                          "least", rows)
    # both sides of the join are plain tables, so AQE can split a node with very many neighbours
    tied = both.where(moved).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = write_through(tied.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "edges",
                        rows)
    release(least)
    return out


def _left_to_do(state: DataFrame) -> tuple[int, bool]:
    """How many edges there are, and whether a node has two smaller neighbours, or one beside a larger one."""
    ends = state.select(F.col("a").alias("node"), F.lit(1).alias("less"), F.lit(0).alias("more")).unionByName(
        state.select(F.col("b").alias("node"), F.lit(0).alias("less"), F.lit(1).alias("more")))
    nodes = ends.groupBy("node").agg(F.sum("less").alias("less"), F.max("more").alias("more"))
    rows, open_ = nodes.agg(F.sum("less"), F.max((F.col("less") > 1) | ((F.col("less") > 0) & (F.col("more") > 0)))).first()
    return rows or 0, bool(open_)


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` of every node of ``a, b``: ``root`` is the least node that can be reached.

    Each round ties every node's larger neighbours, then its smaller ones, to the least neighbour; the
    edges become stars around the roots, and it ends when all are.  A round writes its edges; the rounds grow with
    the logarithm of the longest chain.  ``rows``: about how many edges there are, if that is known."""
    # from the larger node to the smaller one
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    state = write_through(pairs.distinct(), "edges", rows)
    while True:
        rows, open_ = _left_to_do(state)
        if not open_:
            break
        large = _star(state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b"))), F.col("b") > F.col("a"),
                      rows)
        following = _star(large, F.lit(True), rows)
        release(state)
        release(large)
        state = following
    found = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
