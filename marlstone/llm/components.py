"""Connected components by alternating large-star and small-star steps; every round is cut off with a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, new_path


def components(edges: DataFrame) -> DataFrame:
    """(a, b) undirected edges -> (node, component): the smallest node of its component. Null ends and loops are ignored.

    A node with very many neighbours is no burden on one task: minima are combined before the shuffle, and the join
    back on the hot node is one that Spark splits: sort-merge at every size, so nothing of the graph is broadcast.
    """
    spark = edges.sparkSession
    old = None

    def keep(df: DataFrame) -> tuple[DataFrame, str]:
        path = new_path(spark, "edges")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    edges, path = keep(edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: every larger neighbour of u hangs on the smallest node around u.
        large = both.where("v > u").join(least.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours hang on the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        old, (edges, path) = path, keep(small)
        drop_path(spark, old)
        # Settled when the edges are the same as a round ago: stars whose centres are minima.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.groupBy("u").agg(F.min("v").alias("c")).select(F.col("u").alias("node"), F.col("c").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
