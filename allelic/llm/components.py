"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.llm.common import materialise


def _stars(edges: DataFrame) -> bool:
    """Whether each vertex hangs on one root, and no root on another."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.where("up > 1 or up = 1 and down = 1").head(1)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every vertex of ``edges(a, b)`` but the roots:
    ``component`` is the smallest vertex reachable.

    Large stars hang each larger neighbour on the smallest one, small stars
    each smaller one; minima combine before the shuffle, edges stay a table.
    Loops and repeated edges are ignored; the number of rounds grows with the
    logarithm of the longest path.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = materialise(spark, e, "cc")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b")))).where("a <> b").distinct()
        e = materialise(spark, small, "cc")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
