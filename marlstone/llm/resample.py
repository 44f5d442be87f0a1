"""Importance resampling towards a target distribution, over hashed n-grams.

Words are runs of a-z, 0-9 and all characters beyond ASCII, after A-Z are lower-cased. Features are all runs of 1 to
`n` consecutive words, repeats counted; a feature's bucket is its crc32 modulo `buckets`. A bucket's gain is the
logarithm of how much likelier it is in the target than in the documents (add-one counts); a document's weight is the mean gain
of its features. A keyed Gumbel number is added to it, and the highest scores are drawn: a sample without replacement
with probabilities in proportion to the exponential of the weights.

Skewed long texts: a text of more than `chunk` bytes is split at word boundaries. A chunk owns the features that start
in it, and carries the n-1 words behind it, so that each feature is owned once and none is lost between chunks. Chunks
are dealt over all tasks; their counts and gains are summed by document. A word is never cut, so a chunk can be longer
by one word.

The documents are read three times (long texts are cut, features are counted, weights are taken); what is held by the driver and
the tasks is `buckets` numbers. Ranks are numbered by ranges of scores.

Results: one row for each given row. Null, empty and wordless texts have no features and weight 0. A null doc_id takes
part like others (its key is the seed alone) and comes after all others among equal scores; rows that tie in score and
doc_id are ranked in any order. Repeated rows are rows of their own. An empty table gives an empty result, an empty
target one in which all that is rare in the documents counts more. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.sources.scratch import ranked

from .common import written
from .words import Texts, runs, slices, tidied

N_GRAMS, BUCKETS, CHUNK = 2, 10_000, 1 << 18
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
#: Words of more bytes are hashed one by one, others all together, byte by byte.
LONG_WORD = 48
GAIN = 1000


def letters() -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return lut


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)


def crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1)).astype(np.uint32)
    return out


def crc_of(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The crc registers `state` after the bytes of each range."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    at, length, now = starts[order], length[order], state[order]
    begun = int(np.searchsorted(-length, -LONG_WORD, side="left"))
    for i in range(begun):
        now[i] = zlib.crc32(data[at[i] : at[i] + length[i]].tobytes(), int(now[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    at, length, rest = at[begun:], length[begun:], now[begun:]
    for k in range(int(length[0]) if len(length) else 0):
        m = int(np.searchsorted(-length, -k, side="left"))
        rest[:m] = table[(rest[:m] ^ data[at[:m] + k]) & np.uint32(255)] ^ (rest[:m] >> np.uint32(8))
    out = np.empty_like(now)
    out[order] = now
    return out


def features(t: Texts, own: np.ndarray | None, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of every feature, and each text's number of words. own: so many words of each text are its own."""
    data, table = lowered(t.data), crc_table()
    starts, ends, doc = runs(letters()[data], t.offsets)
    count = np.bincount(doc, minlength=len(t))
    place = np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    owned = np.ones(len(doc), bool) if own is None else place < own[doc]
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    found, owners = [], []
    for k in range(n):
        m = max(len(starts) - k, 0)
        if k:  # a blank, and the word k places on
            state = state[:m]
            state = table[(state ^ np.uint32(0x20)) & np.uint32(255)] ^ (state >> np.uint32(8))
        state = crc_of(state, data, starts[k:], ends[k:], table)
        inside = owned[:m] & (doc[:m] == doc[k:])
        found.append(((state[inside] ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64))
        owners.append(doc[:m][inside])
    return np.concatenate(found), np.concatenate(owners), count if own is None else np.minimum(count, own)


def _cut(batches: Iterator[pa.RecordBatch], n: int, chunk: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for t in slices(b.column("text"), 1):  # a text at a time
            starts, ends, _ = runs(letters()[lowered(t.data)], t.offsets)
            first = np.flatnonzero(np.diff(starts // chunk, prepend=-1))
            last = np.append(first[1:], len(starts))
            if not len(first):
                first, last = np.zeros(1, np.int64), np.zeros(1, np.int64)
            for a, z in zip(first, last, strict=True):
                piece = bytes(t.data[starts[a] : ends[min(z + n - 1, len(ends)) - 1]]) if z > a else b""
                keys = [b.column(c).slice(t.first, 1) for c in b.schema.names if c != "text"]
                yield pa.record_batch([*keys, pa.array([z - a], pa.int64()), pa.array([piece], pa.binary()).cast(pa.string())], [*(c for c in b.schema.names if c != "text"), "own", "text"])


def _counts(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for b in batches:
        own = b.column("own").to_numpy(zero_copy_only=False) if "own" in b.schema.names else None
        for t in slices(b.column("text")):
            found, _, _ = features(t, None if own is None else own[t.first : t.first + len(t)], n, buckets)
            total += np.bincount(found, minlength=buckets)
    has = np.flatnonzero(total)
    yield pa.record_batch([pa.array(has), pa.array(total[has])], ["bucket", "n"])


def _sums(batches: Iterator[pa.RecordBatch], n: int, gains) -> Iterator[pa.RecordBatch]:
    gain = gains.value
    for b in batches:
        own = b.column("own").to_numpy(zero_copy_only=False) if "own" in b.schema.names else None
        for t in slices(b.column("text")):
            found, doc, words = features(t, None if own is None else own[t.first : t.first + len(t)], n, len(gain))
            size = np.bincount(doc, minlength=len(t))
            added = np.zeros(len(t), np.int64)
            np.add.at(added, doc, gain[found])
            keys = [c for c in b.schema.names if c not in ("text", "own")]
            yield pa.record_batch([*(b.column(c).slice(t.first, len(t)) for c in keys), *map(pa.array, (words.astype(np.int64), size, added))], [*keys, "n_words", "n_features", "gain"])


def _task(f: Callable, **settings) -> Callable:
    return lambda batches: tidied(partial(f, **settings)(batches))


def in_pieces(docs: DataFrame, n: int = N_GRAMS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) as rows of short texts, and (row, doc_id, own, text) as chunks of long ones, dealt over tasks."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > chunk
    # Row numbers are those of the rows in their files: the same when a lost task runs again.
    rows = docs.withColumn("row", F.monotonically_increasing_id()).where(long).select("row", "doc_id", "text")
    schema = T.StructType([rows.schema["row"], rows.schema["doc_id"], T.StructField("own", T.LongType()), rows.schema["text"]])
    chunks = rows.mapInArrow(_task(_cut, n=n, chunk=chunk), schema).repartition(F.xxhash64("row", "text"))
    return docs.where(~long), written(chunks, "chunks")


def bucket_counts(parts: tuple[DataFrame, ...], n: int = N_GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features fall into each bucket that has any."""
    found = [p.mapInArrow(_task(_counts, n=n, buckets=buckets), "bucket long, n long") for p in parts]
    return found[0].unionAll(found[1]).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths, rounded down, from the counts of both sides."""
    table = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    table = table.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    rows = table.collect()  # `buckets` rows
    s, t = (sum(r[c] for r in rows) for c in "st")
    out = np.zeros(buckets, np.int64)
    for r in rows:
        ratio = (r["t"] + 1.0) * (s + buckets) / ((r["s"] + 1.0) * (t + buckets))
        out[r["bucket"]] = np.floor(GAIN * np.log(ratio))
    return out


def floor_mean(total: Column, n: Column) -> Column:
    """total / n rounded down, in whole numbers; 0 where n is."""
    return F.when(n > 0, ((total - F.pmod(total, n)) / n).cast("long")).otherwise(F.lit(0).cast("long"))


def weigh(docs: DataFrame, target: DataFrame, n: int = N_GRAMS, buckets: int = BUCKETS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_words, n_features and weight of each row of `docs` (doc_id, text), for a `target` with a column text."""
    short, chunks = in_pieces(docs, n, chunk)
    wanted = in_pieces(target.select(F.lit(0).alias("doc_id"), "text"), n, chunk)
    shared = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts((short, chunks), n, buckets), bucket_counts(wanted, n, buckets), buckets))
    of = lambda df, keys: df.mapInArrow(_task(_sums, n=n, gains=shared), T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL("n_words long, n_features long, gain long")]))
    summed = of(chunks, ["row", "doc_id"]).groupBy("row").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_words", "n_features", "gain"))).drop("row")
    both = of(short, ["doc_id"]).unionByName(summed)
    return both.select("doc_id", "n_words", "n_features", floor_mean(F.col("gain"), F.col("n_features")).alias("weight"))


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """`weighed` with score, and rank: 1, 2, ... for the `percent` % highest scores of rows with `least_words`, else null."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-GAIN * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = written(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "weights")
    enough = F.col("n_words") >= least_words
    most = rows.where(enough).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    drawn = ranked(rows.where(enough).withColumn("row", F.monotonically_increasing_id()), order, "rank").drop("row")
    place = F.col("rank") + 1
    return drawn.withColumn("rank", F.when(place <= most, place)).unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    return draw(weigh(docs, target), percent, least_words, seed)
