"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.sources.storage import new_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    spark: SparkSession = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for linked nodes.

    Alternates large and small stars (Kiveris et al., 2014) until every edge leads to a
    root; the number of rounds grows with the logarithm of the nodes. A node with very
    many neighbours only ever meets an aggregate or a join that may be split.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stored(edges.where("u <> v").distinct(), "links")
    while not _is_settled(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(roots).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether each node has one edge down at most, and then none that leads to it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return sums.where((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("up") == 1))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m")
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

