"""Connected components of an undirected graph by repeated contraction.

Defined results: loops and repeated edges, in either direction, change nothing;
an edge with a null end is no edge; a root is one of its component's vertices,
the same one for the same edges; without edges there is no table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import staged


def connected(edges: DataFrame) -> DataFrame | None:
    """(a, b) longs to (vertex, root) for every vertex with an edge; None without edges.

    In each round every vertex moves to the neighbour (or itself) of the lowest
    pseudorandom priority and edges move along, so that the graph shrinks by a
    constant share; the moves are then followed one after the other.  Minima
    are taken per task before the shuffle, so a vertex with many edges is no
    large group.  The driver only learns whether edges are left.
    """
    edges = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("priority"), F.col("b").alias("to"))).alias("low"))
        own = F.struct(F.xxhash64("a").alias("priority"), F.col("a").alias("to"))
        move = staged(lowest.select("a", F.least("low", own)["to"].alias("to")), "moves")
        moves.append(move)
        ends = edges.join(move, "a").select(F.col("to").alias("x"), F.col("b").alias("a")).join(move, "a")
        edges = staged(
            ends.select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b")).where("a <> b").distinct(),
            "edges",
        )
    if not moves:
        return None
    labels = moves[0].select(F.col("a").alias("vertex"), F.col("to").alias("root"))
    for move in moves[1:]:
        labels = labels.join(move.withColumnRenamed("a", "root"), "root", "left").select(
            "vertex", F.coalesce("to", "root").alias("root")
        )
    return labels
