"""Connected components of an edge table, each node with the smallest node it reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.tables import stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(a, b) bigint edges -> (node, root) for every node of an edge between two different nodes.

    Alternating large-star and small-star: each round joins edges to the smallest neighbour of their
    end and writes the new edges to the shared folder, until nothing changes; the edges are then stars.
    Rounds grow with the logarithm of the longest path. No node's neighbours are gathered anywhere.
    """
    current = stored(spark, edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if tuple(state) == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = tuple(state)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        new = small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct()
        current = stored(spark, new, "edges")
