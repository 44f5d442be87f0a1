"""Phrases that occur more often than their parts let expect, per language.

Texts (A-Z lower-cased) are split at `.,;:!?` and line ends into pieces, pieces at blanks and tabs into words. Phrases
are two or three words that stand together in a piece.

1. Words are counted, and those with `least` occurrences in their language get an id: the dictionary. A phrase that is
   frequent holds no other words, so pieces are broken there.
2. Runs of ids are packed into keys of twelve bytes (three ids, most significant byte first; the third is 0 for pairs). A task sorts what
   it has packed and counts runs before anything is shuffled. Keys are dealt by ranges, sorted (Spark's radix sort works on the first eight
   bytes, which are the first two ids) and their runs are counted as they stream past. The ranges follow from the counts
   of the words, as if words stood side by side by chance, so no pass over the texts samples them; a word that begins a
   large part of all phrases is split over ranges by the word behind it.
3. Three words are packed only where both pairs in them are frequent. Pairs are looked up in a table of fixed size by
   hash; a pair that is in it by chance costs a row, which the count then drops.
4. Scores are whole numbers: floor(10**6 * a**2 / (l * r)) in decimals of 38 digits, enough for counts up to 10**15.

Of the dictionary the BROADCAST_WORDS most frequent words at most are broadcast (some 60 bytes each). The rest is told by a
table of fixed size by hash, and only phrases with such a word go through joins, with the hashes of the words to look up:
they are few, as these words are the rarest. A word that is in the table by chance finds nothing in the join.

Results: for each language the `most` best phrases by score, then a, both descending, then phrase in order of bytes: lang, rank, phrase, a (its
count), l and r (counts of its two parts, where the score is lowest), n (all words of the language), score. A phrase
inside a longer candidate that has `inside` % of its occurrences is left out. A null lang is `und`, null and empty texts hold nothing,
very long ones are counted whole, repeated rows count as often as they occur, doc_ids play no part. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.sources.scratch import ranked

from .common import written
from .resample import lowered
from .words import BASE, Texts, mix, powers, runs, slices, tidied

LEAST, MOST, INSIDE = 10, 2000, 50
BROADCAST_WORDS = 1_000_000
#: Bits of the tables of frequent pairs and of words that are not broadcast, and keys that a task sorts at a time.
PAIR_BITS, KEYS = 1 << 26, 3 << 19
#: Keys in a batch that a task sends: Spark holds a batch beside its own memory.
SENT = 1 << 17
#: Bytes of text whose words are counted together.
COUNTED = 1 << 20
BASE_2 = 0xC2B2AE3D27D4EB4F | 1
#: A place in the dictionary of words that are not in it, and of those that a join has to look up.
NONE, OPEN = 0, 0xFFFFFFFF
#: An open phrase's key: three times id and hashes. Others have twelve bytes.
SLOT = np.dtype([("id", ">u4"), ("h1", "<i8"), ("h2", "<i8")])


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes that end a piece, and bytes of words."""
    end = np.zeros(256, bool)
    end[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
    word = ~end
    word[[0x09, 0x20]] = False
    return end, word


def lang_hash(lang: str) -> tuple[int, int]:
    d = hashlib.blake2b(lang.encode(), digest_size=16).digest()
    return int.from_bytes(d[:8], "big"), int.from_bytes(d[8:], "big")


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of byte ranges; `data` are the bytes as 64-bit numbers."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers(base, len(data))[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(data))[starts] + (ends - starts).astype(np.uint64)


def words_of(t: Texts, langs: list[str]) -> tuple[np.ndarray, ...]:
    """Start, end, text, two hashes (of language and word), and whether the next word follows in the same piece; the lowered bytes last."""
    end, word = tables()
    data = lowered(t.data)
    starts, ends, doc = runs(word[data], t.offsets)
    known = {x: lang_hash(x) for x in set(langs)}
    of = [np.array([known[x][k] for x in langs], np.uint64) for k in (0, 1)]
    wide = data.astype(np.uint64) + np.uint64(1)
    h1 = mix(_hashes(wide, starts, ends, BASE) + of[0][doc])
    h2 = mix(_hashes(wide, starts, ends, BASE_2) + of[1][doc])
    piece = np.cumsum(end[data])[starts] if len(starts) else np.zeros(0, np.int64)
    follows = np.zeros(len(starts), bool)
    follows[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
    return starts, ends, doc, h1, h2, follows, data


def texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[Texts, list[str]]]:
    for b in batches:
        langs = b.column("lang").to_pylist()
        for t in slices(b.column("text"), most):
            yield t, langs[t.first : t.first + len(t)]


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as an array of texts."""
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))).cast(pa.string())


def sorted_runs(first: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts by `first`, then `second`; where each run of equal pairs begins in it, and how long the runs are."""
    order, new = np.argsort(first), np.ones(len(first), bool)
    there = first[order]
    np.not_equal(there[1:], there[:-1], out=new[1:])
    if second is not None:
        # The rank of `first` and (a rank of) `second` fit into one number: sorted once more. Portions are large, so it is made in place.
        both = there if there.dtype == np.uint64 else np.empty(len(first), np.uint64)
        both[order] = np.cumsum(new)
        both <<= np.uint64(32)
        both |= second if second.dtype == np.uint32 else np.unique(second, return_inverse=True)[1].astype(np.uint64)
        order = np.argsort(both)
        there = both[order]
        np.not_equal(there[1:], there[:-1], out=new[1:])
    at = np.flatnonzero(new)
    return order, at, np.diff(np.append(at, len(first)))


def by_hashes(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """sorted_runs by both hashes. The second is looked at where the first is the same, and sorted by only if it differs there."""
    order, at, n = sorted_runs(h1)
    if (h2[order] != np.repeat(h2[order[at]], n)).any():
        return sorted_runs(h1, h2)
    return order, at, n


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t, langs in texts(batches, COUNTED):
        starts, ends, doc, h1, h2, _, data = words_of(t, langs)
        if not len(starts):
            continue
        order, first, n = by_hashes(h1, h2)
        at = order[first]
        names = np.array(langs, object)
        total = {}
        for lang, k in zip(langs, np.bincount(doc, minlength=len(t)).tolist(), strict=True):
            total[lang] = total.get(lang, 0) + k
        cols = [pa.array(names[doc[at]], pa.string()), strings(data, starts[at], ends[at]), pa.array(h1[at].view(np.int64)), pa.array(h2[at].view(np.int64)), pa.array(n)]
        yield pa.record_batch(cols, ["lang", "word", "h1", "h2", "n"])
        none = pa.nulls(len(total))
        yield pa.record_batch([pa.array(list(total), pa.string()), none.cast(pa.string()), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(list(total.values()), pa.int64())], ["lang", "word", "h1", "h2", "n"])


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, word, h1, h2, n) of frequent words; and rows with a null word: all words of a language."""
    found = docs.mapInArrow(lambda it: tidied(_count_words(it)), "lang string, word string, h1 long, h2 long, n long")
    return written(found.groupBy("lang", "word", "h1", "h2").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.col("word").isNull()), "words")


def rarer(words: DataFrame, most: int) -> Column | None:
    """Whether a word is rarer than the `most` most frequent ones at most; None if there are no more words than that."""
    step = F.floor(F.log2("n") * 16)  # every count up to 22 is a step, then 16 steps for twice the count: some hundreds of them
    total, first = 0, None
    for s, n in sorted(words.where(F.col("word").isNotNull()).groupBy(step.alias("s")).count().collect(), reverse=True):
        total += n
        if total > most:
            return F.lit(True) if first is None else step < first
        first = s
    return None


def hash_table(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h1, h2, id) by place: the last bits of h1, or the next free place behind it. Half of the places at least are free (id NONE)."""
    size = 1 << max(4, int(2 * len(ids) - 1).bit_length())
    out = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, NONE, np.uint32)
    left, at = np.arange(len(ids)), (h1 & np.uint64(size - 1)).astype(np.int64)
    while len(left):
        free = out[2][at] == NONE
        _, first = np.unique(at[free], return_index=True)
        put = np.flatnonzero(free)[first]
        for column, values in zip(out, (h1, h2, ids), strict=True):
            column[at[put]] = values[left[put]]
        rest = np.ones(len(left), bool)
        rest[put] = False
        left, at = left[rest], (at[rest] + 1) & (size - 1)
    return out


def look_up(table: tuple[np.ndarray, np.ndarray, np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Ids of words by their hashes; NONE for others."""
    have1, have2, ids = table
    last = len(ids) - 1
    found, left, at = np.full(len(h1), NONE, np.uint32), np.arange(len(h1)), (h1 & np.uint64(last)).astype(np.int64)
    while len(left):
        here = ids[at]
        same = (have1[at] == h1[left]) & (have2[at] == h2[left]) & (here != NONE)
        found[left[same]] = here[same]
        rest = ~same & (here != NONE)
        left, at = left[rest], (at[rest] + 1) & last
    return found


def range_ends(n: np.ndarray, langs: np.ndarray, parts: int) -> np.ndarray:
    """Where ranges of (first id, second id) begin, but for the first: about as many pairs in each, were words independent.

    n and langs: count and language of the words 1, 2, ... in order.
    """
    if not len(n):
        return np.zeros(0, np.uint64)
    total = np.cumsum(n)
    want = total[-1] * np.arange(1, parts) / parts
    first = np.minimum(np.searchsorted(total, want, side="right"), len(n) - 1)
    part = (want - (total[first] - n[first])) / n[first]
    begin, end = np.searchsorted(langs, langs[first], side="left"), np.searchsorted(langs, langs[first], side="right") - 1
    before = total[begin] - n[begin]
    second = np.minimum(np.searchsorted(total, before + part * (total[end] - before), side="right"), end)
    return np.sort(((first + 1).astype(np.uint64) << np.uint64(32)) | (second + 1).astype(np.uint64))


def pair_place(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)) % np.uint64(PAIR_BITS)).astype(np.int64)


def has(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def word_place(h2: np.ndarray) -> np.ndarray:
    return (h2.astype(np.uint64) % np.uint64(PAIR_BITS)).astype(np.int64)


def packed(ids: np.ndarray, follows: np.ndarray, pairs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three ids of each phrase of two words; with a table of frequent `pairs`, of each one of three."""
    two = follows[:-1] & (ids[:-1] != NONE) & (ids[1:] != NONE) if len(ids) else np.zeros(0, bool)
    if pairs is None:
        at = np.flatnonzero(two)
        return ids[at], ids[at + 1], np.zeros(len(at), np.uint32)
    at = np.flatnonzero(two)
    place = pair_place(ids[at], ids[at + 1])
    frequent = np.zeros(len(ids), bool)
    frequent[at] = has(pairs, place)
    at = np.flatnonzero(frequent[:-1] & frequent[1:])
    return ids[at], ids[at + 1], ids[at + 2]


def opened(ids: np.ndarray, h1: np.ndarray, h2: np.ndarray, follows: np.ndarray, rest: np.ndarray, pairs: np.ndarray | None, parts: int) -> pa.RecordBatch:
    """Phrases like those of `packed`, but with a word at least that `rest` may hold: one row each, dealt by hash."""
    n = 2 if pairs is None else 3
    ids, unknown = ids.copy(), np.flatnonzero(ids == NONE)
    ids[unknown[has(rest, word_place(h2[unknown]))]] = OPEN
    size = max(len(ids) - n + 1, 0)
    span = lambda x, k: x[k : k + size]
    some = np.logical_or.reduce([span(ids, k) == OPEN for k in range(n)])
    at = np.flatnonzero(some & np.logical_and.reduce([span(ids, k) != NONE for k in range(n)] + [span(follows, k) for k in range(n - 1)]))
    for k in range(n - 1 if n == 3 else 0):
        a, b = ids[at + k], ids[at + k + 1]
        at = at[(a == OPEN) | (b == OPEN) | has(pairs, pair_place(a, b))]
    raw = np.zeros((len(at), 3), SLOT)
    for k in range(n):
        raw["id"][:, k] = ids[at + k]
        look = ids[at + k] == OPEN
        for name, h in (("h1", h1), ("h2", h2)):
            raw[name][look, k] = h[at[look] + k].view(np.int64)
    offsets = pa.py_buffer(np.arange(len(at) + 1, dtype=np.int32) * raw.dtype.itemsize * 3)
    key = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(raw.tobytes())])
    part = (mix(h1[at] ^ h2[at + 1]) % np.uint64(parts)).astype(np.int32)
    return pa.record_batch([key, pa.array(np.ones(len(at), np.int64)), pa.array(part)], ["key", "n", "part"])


def _keys(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys and how long they are, in order, and the range of each; what is in `found` goes, as it is large."""
    a, b, c = (np.concatenate(x) for x in zip(*found, strict=True))
    found.clear()
    high = a.astype(np.uint64)
    high <<= np.uint64(32)
    high |= b
    del a, b
    order, first, n = sorted_runs(high) if not c.any() else sorted_runs(high, c)
    at = order[first]
    del order, first
    for i in range(0, len(at), SENT):
        here = at[i : i + SENT]
        own = high[here]
        raw = np.stack([own >> np.uint64(32), own & np.uint64(0xFFFFFFFF), c[here]], 1).astype(">u4")
        offsets = pa.py_buffer(np.arange(len(here) + 1, dtype=np.int32) * 12)
        key = pa.BinaryArray.from_buffers(pa.binary(), len(here), [None, offsets, pa.py_buffer(raw.tobytes())])
        part = np.searchsorted(ends, own, side="right").astype(np.int32)
        yield pa.record_batch([key, pa.array(n[i : i + SENT]), pa.array(part)], ["key", "n", "part"])


def _combined(packs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray] | pa.RecordBatch], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for p in packs:
        if isinstance(p, pa.RecordBatch):  # open phrases: as they are
            yield p
            continue
        held.append(p)
        size += len(p[0])
        if size >= KEYS:
            yield from _keys(held, ends)
            size = 0
    if size:
        yield from _keys(held, ends)


def _encode(batches: Iterator[pa.RecordBatch], dictionary, pairs, parts: int) -> Iterator[pa.RecordBatch]:
    (words, ends, rest), table = dictionary.value, pairs.value if pairs else None

    def packs():
        for t, langs in texts(batches, COUNTED):
            _, _, _, h1, h2, follows, _ = words_of(t, langs)
            ids = look_up(words, h1, h2)
            yield packed(ids, follows, table)
            if rest is not None:
                yield opened(ids, h1, h2, follows, rest, table, parts)

    return _combined(packs(), ends)


#: Columns of what a slot has to look up.
_LOOK = [f"{c}{k}" for k in (1, 2, 3) for c in ("x", "y")]


def counted(keys: DataFrame, parts: int, least: int = LEAST) -> DataFrame:
    """(w1, w2, w3, a): keys with `least` occurrences, sorted range by range, and runs summed as they stream past. Open phrases
    pass as they are: a null for each word to look up, and its hashes."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0

        def out(k: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
            enough = a >= least
            k = k[enough].astype(np.int64)
            none = pa.nulls(len(k), pa.int64())
            return pa.record_batch([pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(k[:, 2]), pa.array(a[enough]), *[none] * 6], ["w1", "w2", "w3", "a", *_LOOK])

        for b in batches:
            short = pc.equal(pc.binary_length(b.column("key")), 12)
            long, b = b.filter(pc.invert(short)), b.filter(short)
            if long.num_rows:
                raw = np.frombuffer(b"".join(long.column("key").to_pylist()), SLOT).reshape(-1, 3)
                w, no = raw["id"].astype(np.int64), raw["id"] != OPEN
                look = [pa.array(raw[h][:, k], mask=no[:, k]) for k in range(3) for h in ("h1", "h2")]
                yield pa.record_batch([*(pa.array(w[:, k], mask=~no[:, k]) for k in range(3)), long.column("n"), *look], ["w1", "w2", "w3", "a", *_LOOK])
            if not b.num_rows:
                continue
            k = np.frombuffer(b"".join(b.column("key").to_pylist()), ">u4").reshape(-1, 3)
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]).any(1)
            first = np.flatnonzero(new)
            a = np.add.reduceat(b.column("n").to_numpy(), first)
            k = k[first]
            if last is not None:
                if (k[0] == last).all():
                    a[0] += n
                else:
                    yield out(last[None], np.array([n]))
            last, n = k[-1].copy(), int(a[-1])
            yield out(k[:-1], a[:-1])
        if last is not None:
            yield out(last[None], np.array([n]))

    dealt = keys.repartitionById(parts, F.col("part"))
    return dealt.select("key", "n").sortWithinPartitions("key").mapInArrow(lambda it: tidied(sums(it)), ", ".join(f"{c} long" for c in ("w1", "w2", "w3", "a", *_LOOK)))


def looked_up(phrases: DataFrame, rest: DataFrame, least: int) -> DataFrame:
    """(w1, w2, w3, a) of open phrases by the dictionary's `rest` (h1, h2, id); those with a word that is not in it are none."""
    for k in (1, 2, 3):
        x, y = f"x{k}", f"y{k}"
        # A slot with nothing to look up has a null in its key, which finds nothing, and a hash, so that such rows spread.
        phrases = phrases.withColumn(x, F.coalesce(x, F.xxhash64(*(c for c in phrases.columns if c != x))))
        phrases = phrases.join(rest.select(F.col("h1").alias(x), F.col("h2").alias(y), "id").hint("merge"), [x, y], "left")
        phrases = phrases.where(F.col(y).isNull() | F.col("id").isNotNull()).withColumn(f"w{k}", F.coalesce(f"w{k}", "id")).drop("id", x, y)
    return phrases.groupBy("w1", "w2", "w3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def bit_table(rows: DataFrame, place) -> np.ndarray:
    """PAIR_BITS bits, of which those at place(batch) are set."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = place(b)
            yield pa.record_batch([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["at", "bits"])

    out = np.zeros(PAIR_BITS >> 6, np.uint64)
    found = rows.mapInArrow(bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def pair_table(pairs: DataFrame) -> np.ndarray:
    return bit_table(pairs, lambda b: pair_place(b.column("w1").to_numpy(), b.column("w2").to_numpy()))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(10**6 * a * a / (left * right)), exactly."""
    whole = lambda c: c.cast("decimal(15,0)")
    top = (whole(a) * whole(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (whole(left) * whole(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, inside: int = INSIDE, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The best phrases of each language of `docs` (lang, text)."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = word_counts(docs, least)
    totals = words.where(F.col("word").isNull()).select("lang", F.col("n").alias("total"))
    frequent, rare = words.where(F.col("word").isNotNull()), rarer(words, min(broadcast_words, OPEN - 1))
    dictionary = frequent.withColumn("rest", F.lit(False) if rare is None else rare)
    dictionary = written(ranked(dictionary, ["rest", "lang", "word"], "id").withColumn("id", F.col("id") + 1), "dictionary")
    have = dictionary.where("not rest").orderBy("id").select("h1", "h2", "id", "n", "lang").toArrow()
    h1, h2, ids, n = (have.column(c).to_numpy() for c in ("h1", "h2", "id", "n"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ends = range_ends(n, have.column("lang").to_numpy().astype(str), parts)
    rest = None if rare is None else dictionary.where("rest").select("h1", "h2", "id")
    bits = None if rare is None else bit_table(rest, lambda b: word_place(b.column("h2").to_numpy().view(np.uint64)))
    shared = sc.broadcast((hash_table(h1.view(np.uint64), h2.view(np.uint64), ids.astype(np.uint32)), ends, bits))
    closed = F.col("w1").isNotNull() & F.col("w2").isNotNull() & F.col("w3").isNotNull()

    def phrases(pairs) -> tuple[DataFrame, DataFrame]:
        """Those of broadcast words, and all."""
        keys = docs.mapInArrow(lambda it: tidied(_encode(it, shared, pairs, parts)), "key binary, n long, part int")
        found = written(counted(keys, parts, least), "phrases")
        own = found.where(closed).drop(*_LOOK)
        return own, own if rest is None else own.unionAll(written(looked_up(found.where(~closed), rest, least), "looked-up"))

    own, two = phrases(None)
    _, three = phrases(sc.broadcast(pair_table(own)))
    return best(two, three, dictionary, totals, most, inside)


def best(two: DataFrame, three: DataFrame, dictionary: DataFrame, totals: DataFrame, most: int, inside: int) -> DataFrame:
    """Scores, drops what longer phrases hold, and ranks. A word that begins very many phrases makes a skewed join, which Spark splits."""
    word = lambda k: dictionary.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("n").alias(f"f{k}"), *(["lang"] if k == 1 else []))
    pair = lambda i, j: two.select(F.col("w1").alias(f"w{i}"), F.col("w2").alias(f"w{j}"), F.col("a").alias(f"f{i}{j}"))
    longer = three.select("w1", "w2", "a").unionAll(three.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    pairs = two.drop("w3").join(longer, ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    pairs = pairs.join(word(1), "w1").join(word(2), "w2")
    pairs = pairs.select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))
    triples = three.join(pair(1, 2), ["w1", "w2"]).join(pair(2, 3), ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    triples = triples.withColumn("s1", score(F.col("a"), F.col("f1"), F.col("f23"))).withColumn("s2", score(F.col("a"), F.col("f12"), F.col("f3")))
    early = F.col("s1") <= F.col("s2")
    parts = [F.when(early, F.col(x)).otherwise(F.col(y)).alias(name) for x, y, name in (("f1", "f12", "l"), ("f23", "f3", "r"), ("s1", "s2", "score"))]
    triples = triples.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", *parts)
    # Each task ranks what it has and passes on its best ones only, so a language with most of the phrases fits in one task.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase")))
    top = pairs.unionByName(triples).withColumn("rank", place.cast("int")).where(F.col("rank") <= most)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
