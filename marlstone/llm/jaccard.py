"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are sets of word shingles (five words; a text of fewer words has one shingle of them all). Two texts are
linked when the Jaccard similarity of their sets is at least `threshold`.

1. Rows with the same sequence of words form a class, a node of the graph of links. Only classes go on.
2. Each has MinHash values of 16 bits; bands of four of them are bucket keys. At similarity 0.8, 24 bands miss a pair
   with a probability of 3e-6, and less above.
3. A bucket is cut into chunks, of so many members and shingles at most on average, and the chunk pairs (tiles) are
   dealt over tasks, so no task holds a whole large bucket. Inside a tile, a pair belongs to the first band in which it
   agrees; its MinHash values are compared a few at a time, and it is dropped as soon as the posterior probability
   (uniform prior) of reaching the threshold falls below `tolerance`.
4. The shingle sets of the pairs that are left are compared exactly, tile by tile.
5. Tiles return link counts and a spanning forest, not pairs; connected components of the forests are the groups.

Results: one row for each given row, with the columns
    doc_id      as given
    class_id    smallest doc_id of its group of texts connected by links
    copy_id     smallest doc_id with the same words
    n_copies    rows with the same words, itself included
    n_links     other rows whose similarity with it is at least the threshold, exact copies included
Null, empty and all-blank texts have no shingles: each row is a group of its own without links. Null doc_ids are
compared like others, and are larger than any (class_id and copy_id are null where all ids are). Repeated rows, and
rows with different texts under one doc_id, are rows of their own. Very long texts are compared whole. There are no
ties but those between equal ids, which make no difference. An empty table gives an empty result. Columns other than
doc_id and text are ignored (`one_of_each` returns them whatever their names are).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import drop_path, new_path, row_keys, salted_join, unused, written
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
HASHES, ROWS, BANDS = 128, 4, 24
TOLERANCE = 1e-6
#: MinHash values compared between two looks at the posterior.
STEP = 16
#: Members of a chunk of a bucket, and their shingles; a tile compares two chunks.
CHUNK, CHUNK_SHINGLES = 512, 1 << 18
#: Bytes of text of the tiles that are verified at once (one tile at least), and postings looked at in one go.
PORTION_BYTES, POSTINGS = 2 << 20, 1 << 19


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = W.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(W.BASE))
    return (seeds[:n] & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((seeds[n:] & np.uint64(0xFFFFFFFF)) | np.uint64(1)).astype(np.uint32)


def signature(h: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of 16 bits of a non-empty set of 64-bit hashes."""
    x, a = _family(HASHES)
    low = (h >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 8192):
        part = (low[None, i : i + 8192] ^ x[:, None]) * a[:, None]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(least, part.min(axis=1), out=least)
    return (W.mix(least.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))) >> np.uint64(48)).astype(np.uint16)


def band_keys(sig: np.ndarray) -> np.ndarray:
    bands = np.ascontiguousarray(sig[:, : ROWS * BANDS]).view(np.uint64)
    return W.mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(W.BASE)).view(np.int64)


def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each number of compared values, the fewest agreements at which P(similarity >= threshold) is not below tolerance."""
    grid = (np.arange(20000) + 0.5) / 20000
    over = grid >= threshold
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(logs - logs.max())
            if p[over].sum() / p.sum() >= tolerance:
                out[n] = m
                break
    return out


def _sequence_keys(wh: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits in two for the sequence of words of each text."""
    k1, k2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if len(doc):
        pos = (np.arange(len(doc)) - np.searchsorted(doc, doc)).astype(np.uint64)
        has, first = np.unique(doc, return_index=True)
        k1[has] = np.add.reduceat(wh * W.mix(pos + np.uint64(1)), first)
        k2[has] = np.add.reduceat(W.mix(wh ^ W.mix(pos + np.uint64(77))), first)
    return k1, k2


_KEYS = ["t0", "t1", "t2"]
_SIGNED = "doc_id long, t0 long, t1 long, t2 long, k1 long, k2 long, n_sh int, sig binary, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = [b.column(c) for c in ("doc_id", *_KEYS)]
        for t in W.slices(b.column("text")):
            _, _, doc, wh = W.words(t)
            n = len(t)
            k1, k2 = _sequence_keys(wh, doc, n)
            sh, owner = W.shingles(wh, doc, n, n_words)
            count, sigs = np.zeros(n, np.int32), np.zeros((n, HASHES), np.uint16)
            edges = np.searchsorted(owner, np.arange(n + 1))
            for i in range(n):
                if edges[i] < edges[i + 1]:
                    own = np.unique(sh[edges[i] : edges[i + 1]])
                    count[i], sigs[i] = len(own), signature(own)
            keys = band_keys(sigs)
            full = count > 0
            yield pa.record_batch(
                [
                    *(c.slice(t.first, n) for c in ids),
                    pa.array(k1.view(np.int64)),
                    pa.array(k2.view(np.int64)),
                    pa.array(count),
                    pa.array([s.tobytes() for s in sigs], pa.binary()),
                    pa.array([keys[i] if full[i] else [] for i in range(n)], pa.list_(pa.int64())),
                ],
                ["doc_id", *_KEYS, "k1", "k2", "n_sh", "sig", "bands"],
            )


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of whole groups of a stream that is sorted by `key`: many small groups at once, never a part of one."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(k[1:] != k[:-1])
        if rest and rest[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*rest, b.slice(0, cut)])
            rest = [b.slice(cut)]
        else:
            rest.append(b)
    if rest:
        yield pa.Table.from_batches(rest)


def _candidates(tables: Iterator[pa.Table], threshold: float, least: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of tiles sorted by tile -> the members of each tile that still have partners, with the partners of each."""
    order = np.r_[np.arange(ROWS * BANDS, HASHES), np.arange(ROWS * BANDS)]
    for t in tables:
        tile = t.column("tile").to_numpy()
        n = len(tile)
        node, size, side = (t.column(c).to_numpy() for c in ("node", "n_sh", "side"))
        band = t.column("band").to_numpy()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(n, HASHES)
        own = np.ascontiguousarray(sig[:, : ROWS * BANDS]).view(np.uint64)
        found_i, found_j = [], []
        d, left = 1, np.arange(n - 1)
        while len(left):
            left = left[left + d < n]
            left = left[tile[left] == tile[left + d]]
            i = left
            j = i + d
            d += 1
            a, b = side[i], side[j]
            ok = ((a == 2) | (a != b)) & (node[i] != node[j])
            ok &= np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            same = own[i] == own[j]
            ok = same.argmax(axis=1) == band[i]
            i, j = i[ok], j[ok]
            m = np.zeros(len(i), np.int64)
            for s in range(0, HASHES, STEP):
                block = order[s : s + STEP]
                m += (sig[i[:, None], block] == sig[j[:, None], block]).sum(axis=1)
                ok = m >= least[s + STEP]
                i, j, m = i[ok], j[ok], m[ok]
                if not len(i):
                    break
            found_i.append(i)
            found_j.append(j)
        if not found_i:
            continue
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        o = np.argsort(i, kind="stable")
        i, j = i[o], j[o]
        members = np.union1d(i, j)
        for s in range(0, len(members), 4096):
            part = members[s : s + 4096]
            lo, hi = np.searchsorted(i, part), np.searchsorted(i, part, side="right")
            yield pa.record_batch(
                [
                    pa.array(tile[part]),
                    pa.array(node[part]),
                    *(pa.array(t.column(c).to_numpy()[part]) for c in ("copies", *_KEYS)),
                    pa.array([node[j[x:y]] for x, y in zip(lo, hi, strict=True)], pa.list_(pa.int64())),
                ],
                ["tile", "node", "copies", *_KEYS, "partners"],
            )


def _portions(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Whole tiles, many small ones at once."""
    for t in tables:
        tile = t.column("tile").to_numpy()
        ends = np.r_[np.flatnonzero(tile[1:] != tile[:-1]) + 1, len(tile)]
        size = np.cumsum(pc.binary_length(t.column("text")).to_numpy())
        at = 0
        while at < len(tile):
            before = size[at - 1] if at else 0
            fit = ends[(ends > at) & (size[ends - 1] - before <= PORTION_BYTES)]
            end = int(fit[-1]) if len(fit) else int(ends[np.searchsorted(ends, at, side="right")])
            yield t.slice(at, end - at)
            at = end


def _sets(texts: pa.ChunkedArray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, and whose they are, in order of the texts."""
    found, owners = [], []
    for x in W.slices(texts):
        _, _, doc, wh = W.words(x)
        sh, owner = W.shingles(wh, doc, len(x), n_words)
        order = np.lexsort((sh, owner))
        sh, owner = sh[order], owner[order]
        new = np.r_[True, (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])][: len(sh)]
        found.append(sh[new])
        owners.append(owner[new] + x.first)
    return np.concatenate(found), np.concatenate(owners)


def _verify(tables: Iterator[pa.Table], n_words: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Members of tiles with their texts -> links of each node in its tile, and its root in a spanning forest."""
    for t in _portions(tables):
        n = t.num_rows
        tile, node, copies = (t.column(c).to_numpy() for c in ("tile", "node", "copies"))
        edges = np.r_[0, np.flatnonzero(tile[1:] != tile[:-1]) + 1, n]
        low, high = np.repeat(edges[:-1], np.diff(edges)), np.repeat(edges[1:], np.diff(edges))
        sh, owner = _sets(t.column("text"), n_words)
        size = np.bincount(owner, minlength=n)
        own = np.r_[0, np.cumsum(size)]
        # Postings: the members of the tile that have a shingle. Common shingles of one member with all others are counted at once.
        _, code = np.unique(W.mix(sh ^ W.mix(low[owner].astype(np.uint64) + np.uint64(1))), return_inverse=True)
        holder = owner[np.argsort(code, kind="stable")]
        first = np.r_[0, np.cumsum(np.bincount(code))]
        many = np.r_[0, pc.list_value_length(t.column("partners")).to_numpy().cumsum()]
        partners = pc.list_flatten(t.column("partners")).to_numpy()
        links, root = np.zeros(n, np.int64), np.arange(n)
        for a in np.flatnonzero(np.diff(many)).tolist():
            lo, hi = low[a], high[a]
            b = lo + np.searchsorted(node[lo:hi], partners[many[a] : many[a + 1]])
            c = code[own[a] : own[a + 1]]
            width = first[c + 1] - first[c]
            both = np.zeros(hi - lo, np.int64)
            for part in np.split(np.arange(len(c)), np.flatnonzero(np.diff(np.cumsum(width) // POSTINGS)) + 1):
                w = width[part]
                at = np.repeat(first[c[part]] - np.r_[0, np.cumsum(w)[:-1]], w) + np.arange(w.sum())
                both += np.bincount(holder[at] - lo, minlength=hi - lo)
            common = both[b - lo]
            b = b[common >= threshold * (size[a] + size[b] - common) - 1e-9]
            links[a] += copies[b].sum()
            links[b] += copies[a]
            if (root[b] != root[a]).any():
                joined = np.unique(np.r_[root[b], root[a]])
                mine = root[lo:hi]
                mine[np.isin(mine, joined)] = joined[0]
        out = np.flatnonzero(links)
        if len(out):
            yield pa.record_batch([pa.array(node[out]), pa.array(links[out]), pa.array(node[root[out]])], ["node", "links", "root"])


def _grouped(docs: DataFrame, n_words: int, threshold: float, tolerance: float) -> tuple[DataFrame, bool, list[str]]:
    """A row for each row of `docs`: doc_id, its row keys, and (where it has links) class_id, copy_id, copies, links and
    the row keys of its group's first row. Then, whether any row keys repeat, and the tables to delete in the end."""
    if not 0.5 <= threshold <= 1:
        raise ValueError("the bands are laid out for thresholds of 0.5 to 1")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(c.alias(k) for c, k in zip(row_keys(), _KEYS, strict=True)))
    # Joins of tables that grow with the input are sort-merge joins at every size; Spark splits their hot partitions.
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(new_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    signed = keep(docs.mapInArrow(lambda it: W.tidied(_sign(it, n_words)), _SIGNED), "signed")
    member = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *_KEYS)
    classes = signed.where("n_sh > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.min(member).alias("member"), *(F.first(c).alias(c) for c in ("n_sh", "sig", "bands")))
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbered once, in the written table

    keys = classes.select("node", "n_sh", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_sh").alias("shingles")).where("n > 1")
    shared = shared.select("key", F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).cast("int").alias("chunks"))
    hits = keys.drop("n_sh").hint("merge").join(shared, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    tiles = hits.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))).select(
        "node",
        "band",
        F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"),
        F.expr("case when chunk = other then 2 when chunk < other then 0 else 1 end").alias("side"),
    )
    tiles = tiles.hint("merge").join(classes.select("node", "copies", "n_sh", "sig", *(F.col(f"member.{k}").alias(k) for k in _KEYS)), "node")
    least = least_matches(threshold, tolerance)
    survivors = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(lambda it: W.tidied(_candidates(_groups(it, "tile"), threshold, least)), "tile long, node long, copies long, t0 long, t1 long, t2 long, partners array<long>")
    survivors = keep(survivors, "survivors")
    # Where rows repeat, one of them is enough, and they are combined before the shuffle; else that sort is saved.
    repeated = not signed.groupBy(*_KEYS).count().where("count > 1").isEmpty()
    needed = survivors.hint("merge").join(docs.dropDuplicates(_KEYS) if repeated else docs, _KEYS).select("tile", "node", "copies", "partners", F.coalesce("text", F.lit("")).alias("text"))
    verified = needed.repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(lambda it: W.tidied(_verify(_groups(it, "tile"), n_words, threshold)), "node long, links long, root long")
    verified = keep(verified, "verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(verified.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())

    linked = classes.select("node", "k1", "k2", "copy_id", "copies", "member").join(links.hint("merge"), "node", "left").join(group.hint("merge"), "node", "left").where("copies > 1 or links is not null")
    linked = keep(linked.withColumn("component", F.coalesce("component", "node")), "linked")
    ids = linked.groupBy("component").agg(F.min("copy_id").alias("class_id"), F.min("member").alias("first"))
    linked = salted_join(linked, ids, ["component"], F.col("node")).select("k1", "k2", "class_id", "copy_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.struct(*(F.col(f"first.{k}") for k in _KEYS)).alias("first"))
    return salted_join(signed.select("doc_id", *_KEYS, "k1", "k2"), linked, ["k1", "k2"], F.monotonically_increasing_id()), repeated, paths


def jaccard_join(docs: DataFrame, n_words: int = SHINGLE, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """See the module's docstring."""
    rows, _, paths = _grouped(docs, n_words, threshold, tolerance)
    of_group = lambda c: F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col(c))
    copies = F.coalesce("copies", F.lit(1).cast("long"))
    result = written(rows.select("doc_id", of_group("class_id").alias("class_id"), of_group("copy_id").alias("copy_id"), copies.alias("n_copies"), (F.coalesce("links", F.lit(0)) + copies - 1).cast("long").alias("n_links")), "jaccard")
    for p in paths:
        drop_path(docs.sparkSession, p)
    return result


def one_of_each(docs: DataFrame, n_words: int = SHINGLE, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """`docs` without the near duplicates: of each group one row stays, that with the smallest doc_id.

    Null ids are larger than any; of equal ids, that whose text has the smallest hash stays; of rows that are the same
    in doc_id and text (texts without words, too) one stays.
    """
    rows, repeated, paths = _grouped(docs, n_words, threshold, tolerance)
    gone = written(rows.where(F.col("first").isNotNull() & (F.struct(*_KEYS) != F.col("first"))).select(*_KEYS).distinct(), "copies")
    for p in paths:
        drop_path(docs.sparkSession, p)
    names = unused(docs, *_KEYS)
    keyed = docs.select("*", *(c.alias(k) for c, k in zip(row_keys(), names, strict=True)))
    keyed = keyed.dropDuplicates(names) if repeated else keyed
    return keyed.join(gone.toDF(*names), names, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def chance_missed(similarity: float) -> float:
    """Probability that no band of a pair agrees."""
    return math.pow(1 - similarity**ROWS, BANDS)
