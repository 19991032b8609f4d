"""Connected components of an edge table, by alternating large and small stars.

Each step hangs every node on the least node it knows; components become stars in a number of
steps that grows with the logarithm of their size. Nothing but two numbers a step reaches the
driver. Intermediate edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that is not the least of its component; edges from a node to itself count nothing."""
    spark = edges.sparkSession
    known = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    before = None
    while True:
        path = scratch_path(spark, "stars")
        known.write.parquet(path)
        known = spark.read.parquet(path)
        mark = known.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return known.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        known = _small_star(_large_star(known))
