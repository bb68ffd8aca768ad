"""Connected components of a graph by alternating star contractions, entirely in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import stored


def spread_join(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows with one row per key, on columns of the same name.

    The groups come out of an aggregation by the key. A second key makes both sides shuffle
    for the join itself; only then can a hot key's rows be split over several tasks.
    """
    groups = groups.withColumnRenamed(key, "_of").withColumn("_spread", F.xxhash64("_of"))
    both = (rows[key] == groups["_of"]) & (F.xxhash64(rows[key]) == groups["_spread"])
    return rows.join(groups, both, how).drop("_of", "_spread")


def stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the smallest of them and itself: the larger ones, or the others and the node."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    linked = spread_join(both, least, "a")
    if large:
        found = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return found.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node with an edge a-b to another one.

    Alternates stars to larger and to smaller neighbours until nothing changes; the number
    of rounds grows with the logarithm of the nodes. Each round's edges are stored.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        now = stored(stars(stars(now, large=True), large=False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
