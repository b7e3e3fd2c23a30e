"""Connected components of a graph as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.tables import spread_join, stored


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "to"))).first()
    return tuple(row)


def _star(edges: DataFrame, pairs: DataFrame, itself: bool = False) -> DataFrame:
    """For each centre, its smallest neighbour (or itself), linked to what it is paired with.

    edges: (node, to); pairs: those of them that get the minimum in place of the node;
    with ``itself``, the centre is paired with itself, too.
    """
    least = stored(
        edges.groupBy("node").agg(
            F.least(F.min("to"), F.col("node")).alias("least"), F.count("*").alias("n")
        )
    )
    moved = spread_join(pairs, least, ["node"], "n")
    moved = moved.select(F.col("to").alias("node"), F.col("least").alias("to"))
    return moved.unionByName(least.select("node", F.col("least").alias("to"))) if itself else moved


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of an edge list can reach.

    ``edges`` has the columns node and to, which are not null. Alternates large
    stars (larger neighbours move to the smallest one) and small stars (smaller
    neighbours do) until every node but the smallest links to that one alone.
    Rounds grow with the logarithm of a component's size; each is written to the
    shared folder. Nodes with many links are broadcast in the joins, whose number
    is bounded by the number of partitions. An empty edge list gives an empty table.
    """
    now = stored(
        edges.where("node <> to")
        .select(F.greatest("node", "to").alias("node"), F.least("node", "to").alias("to"))
        .distinct()
    )
    seen = _digest(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("to").alias("node"), F.col("node").alias("to")))
        # no more rows than before, as each link moves once; what is equal goes with the small star
        large = stored(_star(both, both.where("to > node")).where("node <> to"))
        # small star: the smaller neighbours, and the node itself
        small = _star(large, large, itself=True)
        now = stored(small.where("node <> to").distinct())
        found = _digest(now)
        if found == seen:
            break
        seen = found
    firsts = now.select("to", F.col("to").alias("node")).distinct()
    return now.unionByName(firsts).select("node", F.col("to").alias("component"))
