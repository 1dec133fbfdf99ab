"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanflow.llm.common import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex is either the end of one edge to its root or a root itself."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b: of one orderable type) to (a, root): each vertex of an edge with the smallest vertex that it reaches.

    Loops and repeated edges do no harm; an empty table gives an empty table. Every round is a minimum by vertex
    (combined before the shuffle) joined back to the edges of a written table, where Spark splits the edges of a hub among
    tasks (AQE's skew join), and is written to the shared folder. The number of rounds grows with the logarithm of the
    vertex count; they end when all that is left are stars.
    """
    cur = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    while not _are_stars(cur):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "cc")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "cc")
    return cur.groupBy("a").agg(F.min("b").alias("root")).unionByName(cur.select(F.col("b").alias("a"), F.col("b").alias("root")).distinct())
