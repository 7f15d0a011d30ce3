"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.session import scratch_path


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it can reach) of each node that has a link.

    ``links`` has columns ``a`` and ``b`` of type long. Each round links every larger
    neighbour of a node to the node's smallest one, then every smaller neighbour, which
    ends in stars around the smallest nodes after a number of rounds logarithmic in the
    longest chain. Links are written to the shared folder after each round, so a round
    reads files and no lineage grows; nothing but a count comes to the driver.
    """
    spark = links.sparkSession
    folder = scratch_path(spark, "components")
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state, number = None, 0
    while True:
        edges.write.parquet(f"{folder}/{number}")
        edges = spark.read.parquet(f"{folder}/{number}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state, number = tuple(now), number + 1
        edges = _small_star(_large_star(edges))
    label = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return label.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return larger.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
