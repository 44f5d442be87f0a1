"""Streams with keyed state: requests that keep their distance, records seen before, review sessions.

State lives in Spark's state store (RocksDB) under the query's checkpoint: it survives restarts and lost executors, and a
batch costs what is in it, however much came before. Processors see one key at a time; their rows come in portions.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries that are started here keep their state in RocksDB, which the processors of this module need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class Distance(StatefulProcessor):
    """Release times of one key's requests: the last one is the state. Where `timers` are set, one forgets it when no request
    in time can come too close to it any more."""

    def __init__(self, delay_us: int, columns: list[str], timers: bool):
        self.delay_us, self.columns, self.timers = delay_us, columns, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("released", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows)).sort_values(["requested_us", "request_tie"], kind="stable")
        # The k-th is released at the largest of (time of the j-th + (k - j) delays): a running maximum.
        steps = np.arange(len(got), dtype=np.int64) * self.delay_us
        due = got["requested_us"].to_numpy() - steps
        if self.last.exists():
            due[0] = max(due[0], self.last.get()[0] + self.delay_us)
        released = np.maximum.accumulate(due) + steps
        self.last.update((int(released[-1]),))
        if self.timers:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer((int(released[-1]) + self.delay_us) // 1000 + 1)
        yield got.assign(released_us=released)[[*self.columns, "released_us"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def spaced(requests: DataFrame, key: str, ts: str, tie: str, delay_s: float = 1.0, late: str | None = None) -> DataFrame:
    """A stream of requests with `release`: max(ts, the previous release of the key + `delay_s`).

    Requests of one batch are taken in order of time, then `tie`; a later batch goes on from the last release. A null key
    is a key. Without `late` every key's last release is kept, and nothing is dropped. With it, a key is forgotten once the
    stream's time is past what its last release holds back, and a request that is more than `late` behind the stream is
    dropped.
    """
    columns = requests.columns
    rows = requests.withColumn("requested_us", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("request_tie", F.col(tie)).withColumn("request_key", F.col(key))
    rows = rows.withWatermark(ts, late) if late else rows
    schema = T.StructType([*requests.schema.fields, T.StructField("released_us", T.LongType())])
    out = rows.groupBy("request_key").transformWithStateInPandas(Distance(int(delay_s * 1e6), columns, late is not None), schema, "Append", "EventTime" if late else "None")
    return out.select(*columns, F.timestamp_micros("released_us").alias("release"))


def unseen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of a stream's rows, each `key` that no earlier batch had, with `first`: its smallest struct of `order`. For mode "update".

    It is an aggregation of Spark's own, so no key costs a call of Python. Its state is narrow: a key's `first`, and the
    times of the first and the last batch that had it, which are the same where it is new. A batch that runs again has the
    time it had.
    """
    at = rows.withColumn("at", F.current_timestamp()).groupBy(key)
    return at.agg(F.min(F.struct(*order)).alias("first"), F.min("at").alias("since"), F.max("at").alias("last")).where("since = last").select(key, "first")


SESSION = T.StructType([T.StructField("active", T.BooleanType()), T.StructField("cursor", T.IntegerType()), T.StructField("pending", T.StringType())])
LOG = "session_id string, kind string, nth int, status string, reason string, at timestamp"
TOLD = Row("session_id", "kind", "nth", "status", "reason", "at_us")


class Session(StatefulProcessor):
    """One judge's session: start, choose, cancel, submit, end. What can't be done at its moment is ignored.

    A choice waits for its reason; a second one is not possible until it is submitted or cancelled. Choices end with the
    items. A session without an event for `idle_ms` of event time expires.
    """

    def __init__(self, items: int, idle_ms: int):
        self.items, self.idle_ms = items, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", SESSION)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        active, cursor, pending = self.state.get() if self.state.exists() else (None, 0, None)
        before, log = (active, cursor, pending), []
        got = sorted(rows, key=lambda r: (r["at_us"] is None, r["at_us"] or 0, r["n"] is None, r["n"] or 0))
        for r in got:
            action, status = r["action"], r["status"]
            tell = lambda kind, s=None, why=None: log.append(TOLD(key[0], kind, cursor, s, why, r["at_us"]))  # noqa: E731, B023
            if action == "start" and active is None:
                active = True
                tell("started")
            elif not active:
                continue
            elif action == "choose" and pending is None and cursor < self.items and status in ("accepted", "rejected"):
                pending = status
            elif action == "cancel":
                pending = None
            elif action == "submit" and pending is not None:
                cursor += 1
                tell("decided", pending, (r["reason"] or "").strip() or None)
                pending = None
            elif action == "end":
                active, pending = False, None
                tell("ended")
        if active is not None and (active, cursor, pending) != before:
            self.state.update((active, cursor, pending))
        # Only an active session has a timer: each call of the state store costs more than the rows do.
        if before[0]:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        if active:
            self.handle.registerTimer(max(r["at_us"] for r in got if r["at_us"] is not None) // 1000 + self.idle_ms)
        yield from log

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, cursor, _ = self.state.get()
        self.state.update((False, cursor, None))
        yield TOLD(key[0], "expired", cursor, None, None, expiredTimerInfo.getExpiryTimeInMs() * 1000)

    def close(self) -> None:
        pass


def reviewed(events: DataFrame, items: int, idle_ms: int = 30 * 60_000, late: str = "10 minutes") -> DataFrame:
    """A stream (session_id, n, action, status, reason, at) -> the log of what happened: LOG.

    Events of a batch are taken in order of time, then n. Those that are more than `late` behind the stream are too late.
    Sessions are small and many, so they are rows, not frames; times are microseconds on the way.
    """
    rows = events.select(F.col("session_id").cast("string").alias("session_id"), "n", "action", "status", "reason", "at", F.unix_micros("at").alias("at_us")).withWatermark("at", late)
    out = rows.groupBy("session_id").transformWithState(Session(items, idle_ms), LOG.replace("at timestamp", "at_us long"), "Append", "EventTime")
    return out.select("session_id", "kind", "nth", "status", "reason", F.timestamp_micros("at_us").alias("at"))


def sessions(log: DataFrame) -> DataFrame:
    """A log (as a table) -> session_id, cursor, accepted, rejected, open."""
    return log.groupBy("session_id").agg(
        F.count_if(F.col("kind") == "decided").alias("cursor"),
        F.count_if(F.col("status") == "accepted").alias("accepted"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        (F.count_if(F.col("kind").isin("ended", "expired")) == 0).alias("open"),
    )
