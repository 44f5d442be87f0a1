"""Intermediate tables that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local master without it (tests) gets a temporary folder, a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where the written tables of this application are."""
    return f"{folder(spark)}/marlstone/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes the written tables of this application: for its end, when nothing that was made of them is read any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """`df` as a written table: cuts the lineage, is computed once, and outlives any executor. `clear` deletes it."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """`df` with a column `name`: 0, 1, ... in order. No task sees all rows: ranks are counts of ranges, then places inside.

    The ranges are written once, so that both steps see the same.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    spread = keep(spread, "ranges")
    sizes = spread.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    n = F.col("_row") - F.col("_first") + F.col("_before")
    return spread.join(F.broadcast(before), "_part").withColumn(name, n.cast("long")).drop("_part", "_row", "_first", "_before")
