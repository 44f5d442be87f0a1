"""Queries that run as streams: the given tables arrive in batches, and what comes out is compared as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.plans.registry import query, read
from marlstone.sources import jsonl
from marlstone.sources.scratch import folder
from marlstone.streaming import stateful


def in_batches(rows: DataFrame, batches: list, path: str) -> DataFrame:
    """`rows` as a stream of files: those for which each condition holds are a batch, in turn."""
    for when in batches:
        rows.where(when).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def through(stream: DataFrame, path: str) -> DataFrame:
    """What a stream gives until its source is read, as a table."""
    with stateful.state_store(stream.sparkSession):
        started = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    started.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def place(spark) -> str:
    return f"{folder(spark)}/marlstone/stream-{jsonl.unique()}"


@query("""
WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 3600000000 AS steps FROM events)
SELECT event_id, user_id, make_timestamp(max(us - steps) OVER (PARTITION BY user_id ORDER BY steps) + steps) AS release FROM e
""")
def spaced_requests(spark, sf_dir):
    """Every user's events, an hour apart at least; they arrive in three batches."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    third, at, path = (high - low) // 3, F.unix_micros("ts"), place(spark)
    stream = in_batches(events, [at < low + third, (at >= low + third) & (at < low + 2 * third), at >= low + 2 * third], path)
    out = through(stateful.spaced(stream, "user_id", "ts", "event_id", 3600.0, "1 day"), path)
    return out.select("event_id", "user_id", F.col("release").cast("timestamp_ntz").alias("release"))


@query("""
WITH c AS (SELECT conv_id, turn, role, length(text) % 2 = 0 AS even FROM conversations WHERE conv_id % 5 <> 0 AND NOT (conv_id % 3 = 0 AND turn > 4)),
p AS (SELECT *, lag(role, 1, '') OVER w AS before, sum(CASE WHEN role <> 'user' THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
chosen AS (SELECT conv_id, coalesce(island, 0) AS island, first(even ORDER BY turn) AS accepted FROM p WHERE role = 'user' GROUP BY ALL),
d AS (SELECT p.conv_id, p.turn, k.accepted, row_number() OVER (PARTITION BY p.conv_id ORDER BY p.turn) AS nth FROM p JOIN chosen k ON p.conv_id = k.conv_id AND coalesce(p.island, 0) = k.island WHERE role = 'assistant' AND before = 'user'),
n AS (SELECT conv_id, count(*) AS cursor, count(*) FILTER (WHERE accepted) AS accepted FROM d WHERE nth <= 3 GROUP BY conv_id)
SELECT s.conv_id::VARCHAR AS session_id, coalesce(n.cursor, 0) AS cursor, coalesce(n.accepted, 0) AS accepted, coalesce(n.cursor, 0) - coalesce(n.accepted, 0) AS rejected, NOT (s.conv_id % 3 = 0) AS open
FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 5 <> 0) s LEFT JOIN n ON s.conv_id = n.conv_id
""")
def review_sessions(spark, sf_dir):
    """Conversations as sessions: users choose, assistants submit, systems cancel; one in five never starts, one in three
    ends after the fifth turn. Three items, turns arrive in three batches."""
    c = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("n"), "role", F.length("text").alias("size"))
    action = F.when(F.col("role") == "user", "choose").when(F.col("role") == "assistant", "submit").otherwise("cancel")
    rows = c.select("conv_id", F.col("n") * 2 + 1, action.alias("action"), F.when(F.col("size") % 2 == 0, "accepted").otherwise("rejected").alias("status")).toDF("conv_id", "n", "action", "status")
    ids, none = c.select("conv_id").distinct(), F.lit(None).cast("string")
    rows = rows.unionByName(ids.where("conv_id % 5 != 0").select("conv_id", F.lit(-1).cast("long").alias("n"), F.lit("start").alias("action"), none.alias("status")))
    rows = rows.unionByName(ids.where("conv_id % 3 = 0").select("conv_id", F.lit(10).cast("long").alias("n"), F.lit("end").alias("action"), none.alias("status")))
    events = rows.select(F.col("conv_id").cast("string").alias("session_id"), "n", "action", "status", none.alias("reason"), F.timestamp_seconds(F.col("n") + 1_700_000_000).alias("at"))
    path = place(spark)
    stream = in_batches(events, [F.col("n") < 4, (F.col("n") >= 4) & (F.col("n") < 9), F.col("n") >= 9], path)
    return stateful.sessions(through(stateful.reviewed(stream, 3), path))
