"""Toxicity scores of texts that are restored first from leetspeak, spacing and repetition.

1. A character language model: trigram counts of the lower-case letters of all documents (a table of fixed size).
2. A noisy channel: suspicious tokens (letters mixed with digits or signs, at their ends too, three equal letters in a
   row, single letters set apart, with punctuation at the ends of the run) become lattices; each piece may stand for
   some letters, for the boundary of a word, or, when repeated, for one or two of itself, each at a cost. Viterbi finds
   the cheapest reading under the language model.
3. A logistic regression over the words of the restored text and their beginnings and ends, fitted to labelled rows
   of which at most SAMPLE_ROWS are taken by a hash of doc_id (all where there are fewer). It sees nothing but text.

Null, empty and letterless texts get the score of a text without any known feature. Very long texts and tokens are
read whole: decoding is linear in a token's length. Repeated rows get equal scores (no ties arise: each row has a score
of its own); a doc_id whose labels contradict each other counts as toxic. Without labels of both kinds every score is
the share of toxic labels (0 without any). An empty table gives an empty result. `score` ignores extra columns,
`reject` returns them whatever their names are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import written

THRESHOLD = 0.3
#: Bound on the labelled rows that the classifier is fitted to.
SAMPLE_ROWS = 10_000
#: Bound on the features of the model, and the fewest labelled documents that hold one.
MOST_FEATURES, LEAST_DOCS = 16384, 4
FEATURE_BITS = 20
#: Symbols of the language model: a boundary, a-z, and all other letters as one.
SYMBOLS = 28
#: What a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l", "¥": "y", "%": "", "#": "h",
}
#: Costs in nats: a substitution, reading a sign as a boundary, dropping a separator, leaving out a repeated letter.
SUBSTITUTE, AS_BOUNDARY, DROP, COLLAPSE, DOUBLE = 1.0, 2.0, 0.5, 0.2, 1.2
#: Longest token that is remembered; longer ones are decoded each time.
LONGEST = 48

WORD = re.compile(r"[^\W\d_]+")
REPEATED = re.compile(r"([^\W\d_])\1\1")
APART = re.compile(r"(?:[^\W\d_][.\-_*']){2,}[^\W\d_]")
AROUND = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—"
SIGNS = frozenset(LEET)
#: Punctuation that stands for no letter.
PLAIN = "".join(c for c in AROUND if c not in SIGNS)


def symbols() -> np.ndarray:
    lut = np.zeros(256, np.int64)
    lut[97:123] = np.arange(1, 27)
    lut[128:] = 27
    return lut


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, lut = np.zeros(SYMBOLS**3, np.int64), symbols()
    for b in batches:
        for t in W.slices(pc.utf8_lower(pc.fill_null(b.column("text").cast(pa.large_string()), ""))):
            wide = (t.data & 0xC0) == 0x80  # continuation bytes are no symbols of their own
            code = lut[t.data[~wide]]
            if len(code) > 2:
                total += np.bincount((code[:-2] * SYMBOLS + code[1:-1]) * SYMBOLS + code[2:], minlength=SYMBOLS**3)
    found = np.flatnonzero(total)
    yield pa.record_batch([pa.array(found), pa.array(total[found])], ["code", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """-log P(third | first two) as a SYMBOLS x SYMBOLS x SYMBOLS table, from all texts."""
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(lambda it: W.tidied(_trigrams(it)), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(SYMBOLS**3)
    table[counts["code"].to_numpy(dtype=np.int64)] = counts["n"].to_numpy(dtype=float)
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair = table.sum(axis=0)
    two = (pair + 0.5) / (pair.sum(axis=1, keepdims=True) + 0.5 * SYMBOLS)
    smooth = (table + 5 * two[None]) / (table.sum(axis=2, keepdims=True) + 5)
    return -np.log(smooth).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Pieces of a token, each a list of (letters or a blank for a boundary, cost)."""
    apart = bool(re.fullmatch(r"(?:\S[ .\-_*])+\S", token))
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        n, i = j - i, j
        if c.isalpha():
            if n == 1:
                out.append([(c, 0.0)])
            elif n == 2:
                out.append([(c + c, 0.0), (c, DOUBLE)])
            else:
                out.append([(c, COLLAPSE), (c + c, COLLAPSE)])
        elif c in LEET:
            read = [(x, SUBSTITUTE) for x in LEET[c]] + [(x + x, SUBSTITUTE + DOUBLE) for x in LEET[c] if n > 1]
            out.append([*read, (" ", AS_BOUNDARY)])
        else:
            out.append([("", DROP), (" ", DROP if apart and c != " " else AS_BOUNDARY if c == " " else DROP)])
    return out


def decode(token: str, model: np.ndarray) -> str:
    """The cheapest reading of a token in lower case; blanks are boundaries."""
    number = lambda c: 0 if c == " " else ord(c) - 96 if "a" <= c <= "z" else 27
    # Each state has its cost and its reading as a chain of pieces; where one state is left, its reading is settled.
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    settled: list[str] = []

    def spelt(chain: tuple) -> str:
        out = []
        while chain:
            chain, letters = chain
            out.append(letters)
        return "".join(reversed(out))

    for piece in lattice(token):
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, text) in states.items():
            for letters, price in piece:
                x, y, c = a, b, cost + price
                for ch in letters:
                    z = number(ch)
                    if z == 0 and y == 0:
                        continue
                    c += float(model[x, y, z])
                    x, y = y, z
                if (x, y) not in new or c < new[x, y][0]:
                    new[x, y] = (c, (text, letters))
        states = new
        if len(states) == 1:
            ((pair, (_, text)),) = states.items()
            settled.append(spelt(text))
            states = {pair: (0.0, ())}
    end = lambda s: s[1][0] + (float(model[s[0][0], s[0][1], 0]) if s[0][1] else 0.0)
    return re.sub(" +", " ", "".join(settled) + spelt(min(states.items(), key=end)[1][1])).strip()


@dataclass
class Restorer:
    """Reads texts as words; suspicious tokens are decoded. `then` is applied to a token's words, and what comes out is
    remembered by token, up to a bound."""

    model: np.ndarray
    then: Callable[[tuple[str, ...]], tuple] = tuple
    known: dict[str, tuple] = field(default_factory=dict)

    def token(self, t: str) -> tuple[str, ...]:
        """The words of one token in lower case."""
        core = t.strip(PLAIN)
        if core.isalpha():
            return tuple(decode(core, self.model).split()) if REPEATED.search(core) else (core,)
        if not WORD.search(core):
            return ()
        if SIGNS & {*core} or "*" in core or APART.search(core) or REPEATED.search(core):
            return tuple(decode(core, self.model).split())
        return tuple(WORD.findall(core))

    def read(self, t: str, apart: bool = False) -> tuple:
        if len(self.known) > 150_000:
            self.known.clear()
        out = self.then(tuple(decode(t, self.model).split()) if apart else self.token(t))
        if len(t) <= LONGEST:
            self.known[t] = out
        return out

    def apart(self, tokens: list[str]) -> Iterator[str]:
        """Runs of three and more single characters in a row: what may be one word set apart. Punctuation may stand
        before the first and after the last."""
        try:
            lengths = bytes(map(len, tokens))
        except ValueError:  # a token of more than 255
            lengths = bytes(min(len(t), 255) for t in tokens)
        at = lengths.find(1)
        while at >= 0:
            end = at + 1
            while end < len(lengths) and lengths[end] == 1:
                end += 1
            run = tokens[at:end]
            if at and len(t := tokens[at - 1]) > 1 and t[-1] not in PLAIN and not t[:-1].strip(AROUND):
                run.insert(0, t.lstrip(PLAIN))
            if end < len(tokens) and len(t := tokens[end]) > 1 and t[0] not in PLAIN and not t[1:].strip(AROUND):
                run.append(t.rstrip(PLAIN))
            if len(run) > 2 and len(set(run)) > 1:
                yield " ".join(run)
            at = lengths.find(1, end)

    def words(self, text: str) -> set:
        """What `then` makes of the distinct words of the restored text."""
        tokens = text.lower().split()
        out: set = set()
        known = self.known
        for t in {*tokens}:
            found = known.get(t)
            if found is None:
                found = self.read(t)
            if found:
                out.update(found)
        for run in self.apart(tokens):
            found = known.get(run)
            out.update(self.read(run, apart=True) if found is None else found)
        return out


def feature(kind: str, value: str) -> int:
    return xxhash.xxh64_intdigest(value, seed=ord(kind)) & ((1 << FEATURE_BITS) - 1)


def features_of(words: tuple[str, ...]) -> tuple[int, ...]:
    out = []
    for word in words:
        out.append(feature("w", word))
        for n in (4, 6):
            if len(word) >= n:
                out += [feature("p", word[:n]), feature("s", word[-n:])]
    return tuple(out)


def _features(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    restore = Restorer(shared.value, features_of)
    for b in batches:
        rows = []
        for text in b.column("text"):
            have = restore.words(text.as_py() or "")
            rows.append(np.fromiter(have, np.int32, len(have)).tobytes())
        yield pa.record_batch([b.column("doc_id"), b.column("toxic"), pa.array(rows, pa.binary())], ["doc_id", "toxic", "features"])


@dataclass
class Classifier:
    weights: dict[int, float]
    bias: float


def choose(df: np.ndarray, pos: np.ndarray, share: float) -> np.ndarray:
    """The features that are learned from, in order: by how many documents, and how many toxic ones, have each."""
    # Standardised difference between what toxic documents show and what the feature's frequency would give.
    z = np.abs(pos - df * share) / np.sqrt(np.maximum(df * share * (1 - share), 1e-9)) * (df >= LEAST_DOCS)
    chosen = np.flatnonzero(z > 2.5)
    return np.sort(chosen[np.argsort(-z[chosen], kind="stable")[:MOST_FEATURES]])


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << FEATURE_BITS
    df, pos = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for b in batches:
        for have, toxic in zip(b.column("features"), b.column("toxic").to_pylist(), strict=True):
            found = np.frombuffer(have.as_py(), np.int32)
            df[found] += 1
            pos[found] += toxic > 0
    has = np.flatnonzero(df)
    yield pa.record_batch([pa.array(has), pa.array(df[has]), pa.array(pos[has])], ["feature", "df", "pos"])


def _only_chosen(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    keep = np.zeros(1 << FEATURE_BITS, bool)
    keep[chosen] = True
    for b in batches:
        rows = [found[keep[found]].tobytes() for found in (np.frombuffer(x.as_py(), np.int32) for x in b.column("features"))]
        yield pa.record_batch([b.column("doc_id"), b.column("toxic"), pa.array(rows, pa.binary())], ["doc_id", "toxic", "features"])


def fit(labels: np.ndarray, flat: np.ndarray, edges: np.ndarray, rounds: int = 200, ridge: float = 1e-4, chosen: np.ndarray | None = None) -> Classifier:
    """Logistic regression on binary features (those that are `chosen`); row i has those of flat[edges[i]:edges[i+1]]."""
    n = len(labels)
    if not n or labels.min() == labels.max():
        share = float(np.clip(labels.mean() if n else 0.0, 1e-6, 1 - 1e-6))
        return Classifier({}, float(np.log(share / (1 - share))))
    size = 1 << FEATURE_BITS
    if chosen is None:
        has = np.repeat(labels > 0, np.diff(edges))
        chosen = choose(np.bincount(flat, minlength=size), np.bincount(flat[has], minlength=size), labels.mean())
    p = labels.mean()
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    cols, rows = [], []
    for k in range(0, n, 512):
        top = min(k + 512, n)
        own = place[flat[edges[k] : edges[top]]]
        whose = np.repeat(np.arange(k, top, dtype=np.int32), np.diff(edges[k : top + 1]))
        order = np.lexsort((own, whose))
        order = order[own[order] >= 0]
        cols.append(own[order])
        rows.append(whose[order])
    col, row = np.concatenate(cols), np.concatenate(rows)
    w, bias = np.zeros(len(chosen)), float(np.log(p / (1 - p)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for k in range(1, rounds + 1):
        score = bias + np.bincount(row, weights=w[col], minlength=n)
        error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels
        g = np.r_[np.bincount(col, weights=error[row], minlength=len(w)) / n + ridge * w, error.mean()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return Classifier({int(f): float(x) for f, x in zip(chosen, w, strict=True)}, float(bias))


def train(docs: DataFrame, labels: DataFrame, model, allowed: Callable[[Column], Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Fits to the texts that `labels` (doc_id, toxic) marks; `allowed` says of which doc_id labels may be used.

    Features are counted by tasks; the driver gets these counts, and of each row those among MOST_FEATURES features only,
    however long its text is.
    """
    marked = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    if allowed is not None:
        marked = marked.where(allowed(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    if n > sample_rows:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * (sample_rows / n) * 0.97))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(marked, "doc_id").select("doc_id", "toxic", "text")
    schema = "doc_id long, toxic int, features binary"
    rows = written(rows.mapInArrow(lambda it: W.tidied(_features(it, model)), schema), "features")
    counts = rows.mapInArrow(_count_features, "feature long, df long, pos long").groupBy("feature").agg(F.sum("df").alias("df"), F.sum("pos").alias("pos")).toArrow()
    df, pos = np.zeros(1 << FEATURE_BITS, np.int64), np.zeros(1 << FEATURE_BITS, np.int64)
    at = counts.column("feature").to_numpy()
    df[at], pos[at] = counts.column("df").to_numpy(), counts.column("pos").to_numpy()
    share = rows.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    chosen = choose(df, pos, share)
    found = rows.mapInArrow(lambda it: _only_chosen(it, chosen), schema).orderBy("doc_id").toArrow()
    y = found.column("toxic").to_numpy().astype(float)
    sizes, chunks = pc.binary_length(found.column("features")).to_numpy() // 4, found.column("features").chunks
    edges = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    flat = np.zeros(int(edges[-1]), np.int32)
    at = 0
    for c in chunks:  # straight from Arrow's buffers: no object for each row
        ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int32)
        n = int(ends[-1] - ends[0]) // 4
        if n:
            flat[at : at + n] = np.frombuffer(c.buffers()[2], np.int32, n, int(ends[0]))
        at += n
    del found, chunks
    return fit(y, flat, edges, chosen=chosen)


def _score(batches: Iterator[pa.RecordBatch], model, weights) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    weight, bias = weights.value
    have = set(weight)
    restore = Restorer(model.value, lambda words: tuple(f for f in features_of(words) if f in have))
    for b in batches:
        scores = [bias + sum(weight[f] for f in sorted(restore.words(text.as_py() or ""))) for text in b.column("text").cast(pa.string())]
        yield b, 1 / (1 + np.exp(-np.clip(np.array(scores, float), -30, 30)))


def _only_scores(batches: Iterator[pa.RecordBatch], model, weights) -> Iterator[pa.RecordBatch]:
    for b, scores in _score(batches, model, weights):
        yield pa.record_batch([b.column("doc_id"), pa.array(scores)], ["doc_id", "score"])


def _below(batches: Iterator[pa.RecordBatch], model, weights, threshold: float) -> Iterator[pa.RecordBatch]:
    for b, scores in _score(batches, model, weights):
        yield b.filter(pa.array(scores < threshold))


def trained(docs: DataFrame, labels: DataFrame, allowed: Callable[[Column], Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> tuple:
    """The language model of `docs` and the classifier's weights, broadcast."""
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(language_model(docs))
    found = train(docs, labels, model, allowed, sample_rows)
    return model, sc.broadcast((found.weights, found.bias))


def score(docs: DataFrame, labels: DataFrame, allowed: Callable[[Column], Column] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text) -> doc_id, score, in a row for each given row."""
    model, weights = trained(docs, labels, allowed, sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: W.tidied(_only_scores(it, model, weights)), "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """The fold of the registered query whose labels are not learned from."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, allowed: Callable[[Column], Column] | None = lambda c: ~held_out(c)) -> DataFrame:
    """The rows of `docs` whose text scores less than `threshold`, whatever their doc_id is (null, or repeated)."""
    model, weights = trained(docs, labels, allowed)
    return docs.mapInArrow(lambda it: W.tidied(_below(it, model, weights, threshold)), docs.schema)
