"""The pool as a stream: pages arrive, and only candidates that the pool doesn't have are appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators import extract, pool
from marlstone.plans.schemas import ITEM
from marlstone.sources import jsonl, sinks
from marlstone.sources.scratch import keep
from marlstone.streaming import stateful

#: What lands of a page: its candidates, where they stand, and the key by which the pool knows them.
LANDED = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("key", T.StringType()), *ITEM.fields])
ORDER = ["page_id", "pos"]


def key() -> Column:
    """The pool's key as one short text."""
    return F.sha2(F.to_json(F.struct(*pool.KEY), {"ignoreNullFields": "false"}), 256)


def land(pages: DataFrame, path: str, checkpoint: str, sector: str = "webapp", retrieved: str = "1970-01-01") -> StreamingQuery:
    """Candidates of a stream (page_id, url, html), a folder a batch; a batch that runs again writes its folder again."""

    def batch(df: DataFrame, n: int) -> None:
        found = pool.keyed(extract.candidates(df, F.lit(sector), retrieved)).withColumn("key", key())
        rows = pool.firsts(found, ["key"], ORDER).select(*LANDED.fieldNames())
        rows.write.mode("overwrite").parquet(f"{path}/batch={n}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def take_in(spark: SparkSession, landed: str, pool_path: str, checkpoint: str) -> StreamingQuery:
    """Appends what has landed and the pool lacks, with the next ids.

    Keys that were seen are state, so a batch costs what is in it; the pool is read once, when the query starts for the
    first time: its keys come as a stream beside what has landed. The state tells new keys and where they landed first; the
    rows are then read from there. Each batch notes its last number for the next one, and owns its files, so one that runs
    again adds nothing twice.
    """
    first, have = not jsonl.exists(spark, f"{checkpoint}/offsets"), None
    if first and jsonl.exists(spark, pool_path):
        have = jsonl.read(spark, pool_path, ITEM)[0]
    last = pool.last_number(have) if have is not None else 0
    if first:
        keys = pool.keyed(have).select(key().alias("key")).distinct() if have is not None else spark.createDataFrame([], "key string")
        keys.write.mode("overwrite").parquet(f"{checkpoint}/known")
    schema = T.StructType([*LANDED.fields, T.StructField("batch", T.IntegerType())])
    place = [*ORDER, "batch"]
    rows = spark.readStream.schema(schema).parquet(landed).select("key", F.lit(True).alias("fresh"), *place)
    known = spark.readStream.schema("key string").parquet(f"{checkpoint}/known").select("key", F.lit(False).alias("fresh"), *(F.lit(None).cast(schema[c].dataType).alias(c) for c in place))
    note = T.StructType([T.StructField("last", T.LongType())])

    def batch(df: DataFrame, n: int) -> None:
        session = df.sparkSession
        before = session.read.schema(note).json(f"{checkpoint}/numbers/{n - 1}").first()["last"] if n else last
        new = keep(df.where("first.fresh").select("key", "first.batch"), "fresh")  # written first: what holds state runs once
        folders, count = [r["batch"] for r in new.select("batch").distinct().collect()], 0
        if folders:
            found = session.read.schema(schema).option("basePath", landed).parquet(*(f"{landed}/batch={k}" for k in sorted(folders))).join(new, ["key", "batch"])
            count = sinks.append_batch(pool.number(found, before, ORDER).select(*ITEM.fieldNames()), pool_path, n)
        session.range(1).select(F.lit(before + count).alias("last")).write.mode("overwrite").json(f"{checkpoint}/numbers/{n}")

    with stateful.state_store(spark):
        told = stateful.unseen(rows.unionByName(known), "key", ["fresh", *place])
        return told.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_new(pages: DataFrame, pool_path: str, checkpoint: str, sector: str = "webapp", retrieved: str = "1970-01-01") -> StreamingQuery:
    """Both steps for what a stream (page_id, url, html) has now: the second one's query."""
    land(pages, f"{checkpoint}/landed", f"{checkpoint}/pages", sector, retrieved).awaitTermination()
    return take_in(pages.sparkSession, f"{checkpoint}/landed", pool_path, f"{checkpoint}/pool")


def sessions(decisions: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """A stream of decisions (session_id, status, timestamp) -> counts by session window, late rows dropped after `late`."""
    return (
        decisions.withWatermark("timestamp", late)
        .groupBy("session_id", F.session_window("timestamp", gap).alias("w"))
        .agg(F.count("*").alias("reviewed"), F.count_if(F.col("status") == "accepted").alias("accepted"))
        .select("session_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "reviewed", "accepted")
    )


def rollup(events: DataFrame, ts: str, window: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts of an event stream by tumbling or sliding window."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return events.withWatermark(ts, late).groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
