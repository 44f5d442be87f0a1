"""Shared pieces of the text operators: shared folders, written intermediate tables and joins that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a local master (tests) gets
    a temporary one; on a cluster, whose machines would each see their own, that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/marlstone/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts the lineage, and outlives any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a written table through Hadoop's file system, whichever store holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Copies of a small side's row in a salted join: a key with a third of all rows spreads over so many tasks.
SALTS = 32


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salt_by: Column, how: str = "left", salts: int = SALTS) -> DataFrame:
    """Equi-join in which each key of `big` is dealt over `salts` partitions; `small` holds at most one row a key.

    It is a sort-merge join at every size: Spark's estimate of `small` leaves out its copies, so a broadcast would take
    `salts` times the memory that its threshold allows, of the driver as well.
    """
    (salt,) = unused(big, "_salt")
    left = big.withColumn(salt, F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*keys, salt], how).drop(salt)


def unused(df: DataFrame, *names: str) -> list[str]:
    """`names`, each with so many underscores in front that no column of `df` (whose names ignore case) has it."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def row_keys(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Three longs, none of them null, that rows share when doc_id and text are the same: what tells rows apart when
    ids are null or repeat."""
    whole, known = F.coalesce(F.col(text).cast("string"), F.lit("")), F.col(doc_id).isNotNull()
    null = F.col(text).isNull()
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")), F.xxhash64(known, null, whole), F.xxhash64(null, whole, known, F.lit(1))]


def once(values: Column, f) -> Column:
    """f(values) with `values` computed a single time, however often f refers to them."""
    return F.element_at(F.transform(F.array(values), f), 1)
