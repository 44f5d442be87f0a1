"""Seed lists, removal logs and batch files: text whose place or name carries meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jsonl import lines
from .scratch import ranked


def seeds(spark: SparkSession, folder: str, sector: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(seeds, errors) of FOLDER/SECTOR.txt: comments from # on are stripped (fragments too), what isn't http(s) is an error.

    A given sector is a file name, so other files are not read.
    """
    raw = lines(spark, f"{folder}/{sector or '*'}.txt")
    name = F.regexp_extract("file", r"([^/]+)\.txt$", 1)
    rows = raw.select(F.concat(name, F.lit(".txt")).alias("file"), "line", name.alias("sector"), F.trim(F.regexp_replace("value", r"#.*$", "")).alias("url")).where("url != ''")
    good = F.coalesce(F.try_parse_url("url", F.lit("HOST")).isNotNull() & F.col("url").rlike(r"^(?i)https?://"), F.lit(False))
    return ranked(rows.where(good).select("url", "sector", "line"), ["sector", "line"], "pos").select("url", "sector", "pos"), rows.where(~good).select("file", "line", "url")


def removal_log(raw: DataFrame) -> DataFrame:
    """(name, reason) of lines (line, value); the last entry of a name counts."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = raw.where((F.trim("value") != "") & ~F.trim("value").startswith("#")).select("line", parts[0].alias("name"), F.coalesce(F.get(parts, F.lit(1)), F.lit("unknown")).alias("reason"))
    return rows.groupBy("name").agg(F.max_by("reason", "line").alias("reason"))


def read_removal_log(spark: SparkSession, path: str) -> DataFrame:
    return removal_log(lines(spark, path))


def batches(spark: SparkSession, pattern: str) -> DataFrame:
    """(batch, kind, file) of batch-NN.jsonl (kind verdicts), batch-NN-input.jsonl (input) and batch-NN-prompt.md (prompt);
    tables may be files or folders. Batches are few: their names are listed, not read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    files = spark.createDataFrame([(x.getPath().toString(),) for x in found or []], "file string")
    number = F.regexp_extract("file", r"batch-0*(\d+)(-input\.jsonl|-prompt\.md|\.jsonl)$", 1)
    kind = F.when(F.col("file").rlike(r"-input\.jsonl$"), "input").when(F.col("file").rlike(r"-prompt\.md$"), "prompt").otherwise("verdicts")
    return files.where(number != "").select(number.cast("int").alias("batch"), kind.alias("kind"), "file")


def next_batch(found: DataFrame) -> int:
    return (found.agg(F.max("batch")).first()[0] or 0) + 1


def last_input(found: DataFrame) -> int | None:
    """The last batch that was frozen, judged or not."""
    return found.where("kind = 'input'").agg(F.max("batch")).first()[0]


def pending_batch(found: DataFrame) -> int | None:
    """The last batch whose input waits for verdicts; none waits where null comes out."""
    done = found.where("kind = 'verdicts'").select("batch")
    return found.where("kind = 'input'").join(done, "batch", "left_anti").agg(F.max("batch")).first()[0]
