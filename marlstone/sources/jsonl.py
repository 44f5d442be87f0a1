"""JSON-lines tables. Order has meaning, so rows carry `pos`; null and absent keys can be told apart where that matters."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def unique() -> str:
    return uuid.uuid4().hex


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, place, value) of a text file or folder; lines count from 1, blank ones included. `place` goes on from
    file to file in order of their names, as `line` does in one.

    Large files are read in blocks. A line's number is its place in the block, after the lines of the blocks before it;
    these are counted first, a small row a block.
    """
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")]
    rows = spark.read.text(path).select(*block, "value", F.monotonically_increasing_id().alias("n"))
    blocks = rows.groupBy("file", "at").agg(F.min("n").alias("first"), F.count("*").alias("lines"))
    before = lambda w: F.coalesce(F.sum("lines").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "at", "first", before(Window.partitionBy("file").orderBy("at")).alias("before"), before(Window.orderBy("file", "at")).alias("above"))
    nth = F.col("n") - F.col("first") + 1
    return rows.join(F.broadcast(blocks), ["file", "at"]).select("file", (nth + F.col("before")).alias("line"), (nth + F.col("above")).alias("place"), "value")


def read(spark: SparkSession, path: str, schema: StructType, missing: str = "empty") -> tuple[DataFrame, DataFrame]:
    """(rows, errors): rows of `schema` with `pos` (the place in the table), and (file, line) of each line that isn't an object.

    missing: "empty" for no rows where nothing is at the path, "error" for Spark's own.
    """
    if missing == "empty" and not exists(spark, path):
        empty = StructType([*schema.fields, StructField("pos", StringType())])
        return spark.createDataFrame([], empty).withColumn("pos", F.col("pos").cast("bigint")), spark.createDataFrame([], "file string, line int")
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    raw = lines(spark, path).where(F.trim("value") != "")
    parsed = raw.withColumn("r", F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    rows = parsed.where(~bad).select(*(f"r.{f}" for f in schema.fieldNames()), F.col("place").cast("bigint").alias("pos"), keys.alias("_keys"))
    return rows, parsed.where(bad).select("file", "line")


def read_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows, or an error that names every bad line."""
    rows, errors = read(spark, path, schema, "error")
    if found := errors.orderBy("file", "line").limit(40).collect():
        raise ValueError("unreadable lines: " + ", ".join(f"{r['file']}:{r['line']}" for r in found))
    return rows


def read_lenient(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Bad lines are left out; the scan splits large files."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_first(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """The first path at which something is."""
    for path in paths:
        if exists(spark, path):
            return read_lenient(spark, path, schema)
    raise AnalysisException(f"nothing at any of {paths}")
