"""Validation sessions: what a judge is shown, and what came of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import percent
from marlstone.plans.schemas import EMPTY_ALT, NO_ALT, OTHER_SOURCE, SOURCE_LABELS
from marlstone.sources.scratch import ranked


def announced_name() -> Column:
    return F.coalesce(F.nullif("accessible_name", F.lit("")), F.col("observed_alt"), F.lit(""))


def source_label() -> Column:
    labels = F.create_map(*(F.lit(x) for pair in SOURCE_LABELS.items() for x in pair))
    return F.coalesce(F.try_element_at(labels, F.col("accessible_name_source")), F.lit(OTHER_SOURCE))


def alt_label() -> Column:
    alt = F.col("observed_alt")
    return F.when(alt.isNull(), NO_ALT).when(alt == "", EMPTY_ALT).otherwise(alt)


def shown(items: DataFrame) -> DataFrame:
    return items.select("id", announced_name().alias("announced"), source_label().alias("source"), alt_label().alias("alt"))


def new_session_id() -> Column:
    """Not deterministic: v-, the time and five random signs in base 36."""
    return F.lower(F.concat(F.lit("v-"), F.conv(F.unix_millis(F.current_timestamp()).cast("string"), 10, 36), F.lit("-"), F.lpad(F.conv(F.floor(F.rand() * 36**5).cast("string"), 10, 36), 5, "0")))


def results(decisions: DataFrame, corpus_size: int) -> DataFrame:
    """Events (session_id, id, status, reason, timestamp) -> one row a session; the last decision on an item counts."""
    last = decisions.groupBy("session_id", "id").agg(F.max_by(F.struct("status", "reason", "timestamp"), "timestamp").alias("d"))
    rows = last.groupBy("session_id").agg(
        F.count("*").alias("reviewed"),
        F.count_if(F.col("d.status") == "accepted").alias("accepted"),
        F.count_if(F.col("d.status") == "rejected").alias("rejected"),
        F.array_sort(F.collect_list(F.struct("d.timestamp", "id", "d.status", "d.reason"))).alias("results"),
    )
    return rows.withColumn("corpus_size", F.lit(corpus_size)).withColumn("percent", percent(F.col("reviewed"), F.lit(corpus_size)))


def decide(session_id: str, decisions: DataFrame) -> DataFrame:
    """Decisions (id, status, reason) as events of a session: now, with reasons trimmed and blank ones null; a status is
    accepted or rejected, other rows are no decisions."""
    made = decisions.where(F.col("status").isin("accepted", "rejected"))
    reason = F.nullif(F.trim("reason"), F.lit(""))
    return made.select(F.lit(session_id).alias("session_id"), "id", "status", reason.alias("reason"), F.current_timestamp().alias("timestamp"))


def cursor(items: DataFrame, decisions: DataFrame, sessions: DataFrame) -> DataFrame:
    """(session_id, next_id, left): sessions go through the items in order of `pos`, so the next one follows as many as
    are decided. A session that is through has a null and none left."""
    queue = ranked(items.select("id", "pos"), ["pos"], "nth").select("id", "nth")
    done = decisions.groupBy("session_id").agg(F.count("*").alias("done"))
    at = sessions.select("session_id").distinct().join(done, "session_id", "left").withColumn("nth", F.coalesce("done", F.lit(0)))
    total = items.agg(F.count("*").alias("total")).withColumn("one", F.lit(1))
    at = at.join(queue, "nth", "left").withColumn("one", F.lit(1)).join(F.broadcast(total), "one")
    return at.select("session_id", F.col("id").alias("next_id"), F.greatest(F.col("total") - F.col("nth"), F.lit(0)).alias("left"))


def report(results: DataFrame) -> DataFrame:
    """(session_id, report): each session's results as the JSON document that a judge sends in."""
    event = F.transform("results", lambda r: F.struct(r["id"].alias("id"), r["status"].alias("status"), r["reason"].alias("reason"), r["timestamp"].alias("timestamp")))
    body = F.struct("session_id", F.current_timestamp().alias("timestamp"), "corpus_size", "reviewed", "accepted", "rejected", event.alias("results"))
    return results.select("session_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("report"))


def gaps(requests: DataFrame, key: str, ts: str, tie: str, least_s: float) -> DataFrame:
    """Requests that came sooner after the previous one of their key than `least_s`.

    The previous one is then in the same stretch of time or in the one before, so keys are cut into stretches, and a
    busy key is spread over many tasks.
    """
    micros, wide = F.unix_micros(F.col(ts).cast("timestamp")), max(int(least_s * 1e6), 60_000_000)
    rows = requests.withColumn("_at", micros).withColumn("_stretch", F.floor(F.col("_at") / wide))
    inside = F.lag("_at").over(Window.partitionBy(key, "_stretch").orderBy(ts, tie))
    last = rows.groupBy(F.col(key).alias("_key"), (F.col("_stretch") + 1).alias("_next")).agg(F.max("_at").alias("_last"))
    rows = rows.withColumn("_before", inside).join(last, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_stretch") == F.col("_next")), "left")
    gap = (F.col("_at") - F.coalesce("_before", "_last")) / 1e6
    return rows.withColumn("gap_s", gap).where(F.col("gap_s") < least_s).select(*requests.columns, "gap_s")
