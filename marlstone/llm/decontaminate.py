"""Benchmark decontamination: rare word pairs join passages to test items, Smith-Waterman alignment scores them.

Words are runs of letters and digits in lower case; punctuation and blanks beyond ASCII part them too. The score of a
document is that of its best local alignment with the item by words (match 1, mismatch and gap -1), over the item's
number of words; SCORE and more is a leak. Edited copies lose 2 points a changed word.

Seeds lose none of them. An alignment of score s is made of runs of matches with an edit at least between two of them,
so it holds s-1 of the item's m-1 pairs of neighbouring words. Any m-s+1 pairs of the item thus have one in every leak:
the seeds are those that the fewest documents hold, and how often an item leaked doesn't matter. Where a seed stands,
the passage around it is aligned if it holds s-1 of the pairs.

The items are a stated query set: they are broadcast in blocks of at most BLOCK_BYTES of text, and each block is held
against all documents. Results: one row for each document and leaked item, with score and the code points (start, end)
of the passage that was aligned. Of equally good passages in a document the last is given, of equally rare pairs those
with the smallest hashes are seeds. Items of fewer than SEED_WORDS words are found as one gram of all their words; an
item that repeats is one. Null and empty texts match nothing; very long texts are searched whole, in which only the
surroundings of seeds are aligned. Repeated rows, and rows that share a doc_id, give one result for each item, the best;
null doc_ids count as one, and so do null item_ids for each document: such items are searched like others. Empty tables of documents or items give an empty result. `leaks` ignores extra columns,
`clean` returns them whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import written

SEED_WORDS = 3
SCORE = 0.5
BLOCK_BYTES = 8 << 20
#: Stands for a null item_id inside tasks.
NO_ID = -(1 << 63)
LEAKS = "doc_id long, item_id long, score double, start long, end long"
#: Bits of the filter that most n-grams of a text fail at once.
FILTER_BITS = 20


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes of lower-cased UTF-8 belong to words: a-z, 0-9, and all beyond ASCII but punctuation and blanks, which
    are U+0080-U+00BF (without the letters ª, µ, º), U+2000-U+206F and U+3000-U+303F."""
    lut = np.zeros(256, bool)
    lut[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    inside = lut[data]
    two = np.flatnonzero(data[:-1] == 0xC2)
    two = two[~np.isin(data[two + 1], (0xAA, 0xB5, 0xBA))]
    lead = np.flatnonzero((data[:-2] == 0xE2) | (data[:-2] == 0xE3))
    second = data[lead + 1]
    three = lead[((data[lead] == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((data[lead] == 0xE3) & (second == 0x80))]
    for at in (two, two + 1, three, three + 1, three + 2):
        inside[at] = False
    return inside


def tokens(t: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, doc = W.runs(letters(t.data), t.offsets)
    return starts, ends, doc, W.hashes(W.prefix(t.data), starts, ends)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


@dataclass
class Items:
    """A block of items: words of each, and for each n-gram (sorted) the items and places where it stands."""

    ids: np.ndarray
    words: list[np.ndarray]
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def filter(self) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return bits

    def parts(self) -> tuple:
        """For a broadcast, which needs nothing of this package to be read."""
        return self.ids, self.words, self.grams, self.item, self.place

    def needed(self, n: int, least: float) -> np.ndarray:
        """How many of its grams a leak of each item holds at least."""
        size = np.array([len(w) for w in self.words], np.int64)
        return np.where(size < n, 1, np.maximum(np.ceil(least * size - 1e-9).astype(np.int64) - 1, 0))

    def only(self, keep: np.ndarray) -> Items:
        return Items(self.ids, self.words, self.grams[keep], self.item[keep], self.place[keep])


def _size(words: np.ndarray, n: int) -> int:
    """Words in a gram of an item: a pair, or all words of a short item."""
    return len(words) if len(words) < n else min(2, len(words))


def items_of(ids: list[int], texts: list[str], n: int = SEED_WORDS) -> Items:
    words: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(ids)
    for t in W.slices(lowered(pa.array(texts, pa.large_string()))):
        _, _, doc, h = tokens(t)
        edges = np.searchsorted(doc, np.arange(len(t) + 1))
        for k in range(len(t)):
            words[t.first + k] = h[edges[k] : edges[k + 1]].copy()
    grams, item, place = [], [], []
    for k, w in enumerate(words):
        if len(w):
            at, h = W.windows(w, np.zeros(len(w), np.int64), _size(w, n))
            grams.append(h)
            item.append(np.full(len(h), k))
            place.append(at)
    if not grams:
        e = np.zeros(0, np.int64)
        return Items(np.array(ids, np.int64), words, np.zeros(0, np.uint64), e, e)
    g, i, p = np.concatenate(grams), np.concatenate(item), np.concatenate(place)
    o = np.argsort(g, kind="stable")
    return Items(np.array(ids, np.int64), words, g[o], i[o], p[o])


def _sizes(items: Items, n: int) -> list[int]:
    """The lengths of grams that occur."""
    return sorted({_size(w, n) for w in items.words if len(w)})


def _hits(items: Items, bits: np.ndarray, doc: np.ndarray, wh: np.ndarray, n: int, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places in the slice's words where a gram of the items stands, and its first row in `items.grams`."""
    ats, rows = [], []
    for size in sizes:
        at, h = W.windows(wh, doc, size)
        maybe = bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
        at, h = at[maybe], h[maybe]
        row = np.searchsorted(items.grams, h)
        row[row == len(items.grams)] = 0
        ok = items.grams[row] == h if len(h) else np.zeros(0, bool)
        ats.append(at[ok])
        rows.append(row[ok])
    return np.concatenate(ats), np.concatenate(rows)


def _count(batches: Iterator[pa.RecordBatch], shared, n: int) -> Iterator[pa.RecordBatch]:
    items = Items(*shared.value)
    bits, sizes = items.filter(), _sizes(items, n)
    total = np.zeros(len(items.grams), np.int64)
    for b in batches:
        for t in W.slices(lowered(b.column("text"))):
            _, _, doc, wh = tokens(t)
            at, row = _hits(items, bits, doc, wh, n, sizes)
            both = np.unique(doc[at] * np.int64(len(items.grams)) + row)
            np.add.at(total, both % max(len(items.grams), 1), 1)
    found = np.flatnonzero(total)
    yield pa.record_batch([pa.array(found), pa.array(total[found])], ["row", "n"])


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment of two word sequences: score, and the end of it in `text`."""
    m = len(text)
    steps = np.arange(m + 1, dtype=np.int32)
    row = np.zeros(m + 1, np.int32)
    best, end = 0, 0
    for w in item:
        new = np.zeros(m + 1, np.int32)
        np.maximum(row[:-1] + np.where(text == w, 1, -1), row[1:] - 1, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def _pairs(words: np.ndarray) -> np.ndarray:
    return W.windows(words, np.zeros(len(words), np.int64), 2)[1]


def _leaks(items: Items, t: W.Texts, bits: np.ndarray, n: int, sizes: list[int], least: float) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, start, end) of each leak in a slice; bytes of the slice."""
    starts, ends, doc, wh = tokens(t)
    at, row = _hits(items, bits, doc, wh, n, sizes)
    if not len(at):
        return []
    # A gram may stand in several items and places: all rows with its hash.
    last = np.searchsorted(items.grams, items.grams[row], side="right")
    times = last - row
    at, row = np.repeat(at, times), np.repeat(row, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    item, place = items.item[row], items.place[row]
    order = np.lexsort((at, item, doc[at]))
    at, item, place = at[order], item[order], place[order]
    edges = np.searchsorted(doc, np.arange(len(t) + 1))
    out: dict[tuple[int, int], tuple[float, int, int]] = {}
    lengths, needed = np.array([len(w) for w in items.words]), items.needed(n, least)
    pairs: dict[int, np.ndarray] = {}
    far = np.flatnonzero((doc[at][1:] != doc[at][:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] > 2 * lengths[item[1:]])) + 1
    for lo, hi in zip(np.r_[0, far], np.r_[far, len(at)], strict=True):
        k, d = int(item[lo]), int(doc[at[lo]])
        w = items.words[k]
        a = max(int(edges[d]), int(at[lo]) - 2 * len(w))
        z = min(int(edges[d + 1]), int(at[hi - 1]) + 2 * len(w))
        if len(w) >= n and needed[k] > 1:
            if k not in pairs:
                pairs[k] = _pairs(w)
            if np.isin(pairs[k], _pairs(wh[a:z])).sum() < needed[k]:
                continue
        score, end = align(w, wh[a:z])
        if score >= least * len(w):
            back, size = align(w[::-1], wh[a : a + end][::-1])
            found = (score / len(w), int(starts[a + end - size]), int(ends[a + end - 1]))
            if found > out.get((d, k), (0.0, 0, 0)):
                out[d, k] = found
    return [(d, k, *x) for (d, k), x in out.items()]


def _search(batches: Iterator[pa.RecordBatch], shared, n: int, least: float) -> Iterator[pa.RecordBatch]:
    items = Items(*shared.value)
    bits, sizes = items.filter(), _sizes(items, n)
    for b in batches:
        ids = b.column("doc_id")
        for t in W.slices(lowered(b.column("text"))):
            if found := _leaks(items, t, bits, n, sizes, least):
                rows = []
                for d, k, score, start, end in found:
                    own = t.data[t.offsets[d] : t.offsets[d + 1]]
                    point = lambda x, own=own, o=int(t.offsets[d]): int(((own[: x - o] & 0xC0) != 0x80).sum())
                    rows.append((ids[t.first + d].as_py(), None if items.ids[k] == NO_ID else int(items.ids[k]), score, point(start), point(end)))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, x) for c, x in zip(cols, types, strict=True)], ["doc_id", "item_id", "score", "start", "end"])


def rare(items: Items, counts: np.ndarray, n: int = SEED_WORDS, least: float = SCORE) -> np.ndarray:
    """Which rows of `items.grams` are seeds of their item: its rarest, so many that each leak holds one of them."""
    order = np.lexsort((items.grams, counts, items.item))
    own = items.item[order]
    size = np.bincount(own, minlength=len(items.words))
    rank = np.arange(len(own)) - (np.cumsum(size) - size)[own]
    keep = np.zeros(len(own), bool)
    keep[order] = rank < (size - items.needed(n, least) + 1)[own]
    return keep


def _seeds(docs: DataFrame, benchmark: DataFrame, n: int, least: float) -> Iterator:
    """A broadcast for each block of the benchmark: its items, with the grams that are seeds in these documents."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    bench = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    for block in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        items = items_of([NO_ID if r["item_id"] is None else r["item_id"] for r in rows], [r["text"] for r in rows], n)
        if not len(items.grams):
            continue
        shared = spark.sparkContext.broadcast(items.parts())
        counted = texts.mapInArrow(lambda it, s=shared: W.tidied(_count(it, s, n)), "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).toPandas()
        df = np.zeros(len(items.grams), np.int64)
        df[counted["row"]] = counted["n"]
        first = np.searchsorted(items.grams, items.grams)  # rows with one hash were counted at the first
        yield spark.sparkContext.broadcast(items.only(rare(items, df[first], n, least)).parts())


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = SEED_WORDS, least: float = SCORE) -> DataFrame:
    """See the module's docstring."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for chosen in _seeds(docs, benchmark, n, least):
        part = docs.mapInArrow(lambda it, s=chosen: W.tidied(_search(it, s, n, least)), LEAKS)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], LEAKS)
    best = F.max(F.struct("score", "start", "end")).alias("x")
    return written(found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.score", "x.start", "x.end"), "leaks")


def _without(batches: Iterator[pa.RecordBatch], shared, n: int, least: float) -> Iterator[pa.RecordBatch]:
    items = Items(*shared.value)
    bits, sizes = items.filter(), _sizes(items, n)
    for b in batches:
        stays = np.ones(b.num_rows, bool)
        for t in W.slices(lowered(b.column("text"))):
            for d, *_ in _leaks(items, t, bits, n, sizes, least):
                stays[t.first + d] = False
        yield b.filter(pa.array(stays))


def clean(docs: DataFrame, benchmark: DataFrame, n: int = SEED_WORDS, least: float = SCORE) -> DataFrame:
    """The rows of `docs` whose text holds no leaked item, whatever their doc_id is (null, or repeated)."""
    out = docs
    for chosen in _seeds(docs, benchmark, n, least):
        out = out.mapInArrow(lambda it, s=chosen: W.tidied(_without(it, s, n, least)), docs.schema)
    return out
