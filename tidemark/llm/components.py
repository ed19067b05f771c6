"""Connected components by repeated contraction, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the edges (columns ``a`` and ``b``).

    In each round a node goes to the least of its neighbours and itself, in an order
    shuffled anew by a hash, and edges are redrawn between where their ends went. Each
    round leaves a fraction of the nodes, so there are few; a node of very many edges
    sends one row per task, as minima combine before the shuffle. Rounds are stored, so
    no plan grows and a lost executor costs one round at most. At the end nodes follow
    the rounds back to what they became.
    """
    edges = stored(_clean(edges), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves))).alias("h"), F.col(c).alias("node"))
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
        move = stored(least.select(F.col("a").alias("node"), F.least("best", rank("a"))["node"].alias("to")), "move")
        edges = stored(_clean(
            edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .select(F.col("ta").alias("a"), F.col("tb").alias("b"))), "edges")
        moves.append(move)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    *earlier, last = moves
    found = last.withColumnRenamed("to", "root")
    for move in reversed(earlier):
        on = found.select(F.col("node").alias("to"), "root")
        found = move.join(on, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return found


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, in one direction, none to itself."""
    return (
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
