"""Quality rules: counts of every text, and a learned decision list over them.

`features` counts words, symbols, repeated lines and repeated 8-word windows of whole texts (and some more). `learn`
grows an ordered list of threshold conjunctions by sequential covering: each rule adds the condition with the best
information gain until it covers no good document of the growing set, is pruned from its end on the pruning set, and
is accepted while its precision there beats `PRECISION`; what it covers is set aside. `Rules.column` gives the list as
one Spark conditional expression.

Learning takes labelled rows only, at most SAMPLE_ROWS of them chosen by a hash of doc_id (all of them where there are
fewer); the counts cover all documents.

Null, empty and blank texts have zero words, and fail the base rule; very long texts are counted whole. Repeated rows
and null ids are rows of their own and equal texts get equal results; a doc_id with contradicting labels counts as low
quality, one with several texts is learned from once, by its smallest counts. Of conditions with equal gain the first
wins, in the order of `ratios` and of thresholds. Without labels, or with one kind of label only, the list is empty and
only the base rule decides; an empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: The base rule: fewer words, or a larger share of repeated words in per cent, fail.
MIN_WORDS, MAX_REPEAT = 20, 30
#: Bound on the labelled rows that the list is learned from.
SAMPLE_ROWS = 200_000
#: Fewest low-quality documents that a rule covers in the growing set, and its least precision in the pruning set.
SUPPORT, PRECISION = 5, 0.9
#: Thresholds tried for a feature: so many quantiles.
QUANTILES = 64
MOST_CONDITIONS, MOST_RULES = 4, 24

COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_alpha long, n_digits long, n_marks long, n_lines long, n_distinct long, n_hanging long"


def _per_text(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.int64)


def _running(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def _table(chars: bytes) -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[list(chars)] = True
    return lut


def _again(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items (text, hash): which are equal to another of their text, and which to an earlier one."""
    key = W.mix(h ^ W.mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, twice = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def count(t: W.Texts, window: int = WINDOW) -> list[np.ndarray]:
    """The columns of COUNTS after doc_id, for a slice of texts."""
    n, data, off = len(t), t.data, t.offsets
    space = W.spaces()[data]
    starts, ends, doc = W.runs(~space, off)
    sums = W.prefix(data)
    wh = W.hashes(sums, starts, ends)
    per = lambda mask: _per_text(_running(mask), off)
    n_words = np.bincount(doc, minlength=n)
    code_points = (data & 0xC0) != 0x80
    ls, le, ldoc = W.runs(data != 0x0A, off)
    filled = _running(~space)
    full = filled[le] > filled[ls]
    ls, le, ldoc = ls[full], le[full], ldoc[full]
    _, later = _again(ldoc, W.hashes(sums, ls, le))
    at, h = W.windows(wh, doc, window)
    twice, _ = _again(doc[at], h)
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + window, -1)
    covered = np.cumsum(cover[:-1]) > 0
    _, seen = _again(doc, wh)
    upper, lower, digit = _table(bytes(range(65, 91))), _table(bytes(range(97, 123))), _table(b"0123456789")
    wide = data >= 0xC0
    hanging = _table(SYMBOLS + b"!")[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    return [
        n_words,
        per(code_points & ~space),
        per(_table(SYMBOLS)[data]),
        np.bincount(ldoc[later], minlength=n),
        np.bincount(doc[covered], minlength=n),
        per(upper[data]),
        per(upper[data] | lower[data] | wide),
        per(digit[data]),
        per(_table(b"!?")[data]),
        np.bincount(ldoc, minlength=n),
        np.bincount(doc[~seen], minlength=n),
        np.bincount(doc[hanging], minlength=n),
    ]


def _count(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in COUNTS.split(", ")]
    for b in batches:
        for t in W.slices(b.column("text")):
            yield pa.record_batch([b.column("doc_id").slice(t.first, len(t)), *(pa.array(x.astype(np.int64)) for x in count(t, window))], names)


def features(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row of COUNTS for each row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lambda it: _count(it, window), COUNTS)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def ratios() -> dict[str, Column]:
    """What conditions of the list look at."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "n_words"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "upper": _share("n_upper", "n_alpha"),
        "digits": _share("n_digits", "word_chars"),
        "marks": _share("n_marks", "n_words"),
        "line_words": _share("n_words", "n_lines"),
        "distinct": _share("n_distinct", "n_words"),
        "hanging": _share("n_hanging", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


@dataclass
class Rules:
    """Ordered conjunctions of (feature, '<=' or '>', threshold); the first that fits says low quality."""

    rules: list[list[tuple[str, str, float]]]

    def column(self) -> Column:
        """True where no rule fits."""
        at = ratios()
        out = None
        for rule in self.rules:
            fits = None
            for name, sign, x in rule:
                c = at[name] <= F.lit(x) if sign == "<=" else at[name] > F.lit(x)
                fits = c if fits is None else fits & c
            out = F.when(fits, F.lit(False)) if out is None else out.when(fits, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def predict(self, x: dict[str, np.ndarray]) -> np.ndarray:
        keep = np.ones(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            keep &= ~fits(rule, x)
        return keep


def fits(rule: list[tuple[str, str, float]], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for name, sign, t in rule:
        out &= x[name] <= t if sign == "<=" else x[name] > t
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, alive: np.ndarray) -> list[tuple[str, str, float]]:
    rule: list[tuple[str, str, float]] = []
    inside = alive.copy()
    while len(rule) < MOST_CONDITIONS:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p or not n:
            break
        before, best = np.log2(p / (p + n)), (1e-9, None)
        for name, v in x.items():
            values = v[inside]
            b = bad[inside]
            for t in np.unique(np.quantile(values, np.linspace(0, 1, QUANTILES + 1)[:-1], method="lower")):
                low = values <= t
                for sign, m in (("<=", low), (">", ~low)):
                    p1, n1 = int((m & b).sum()), int((m & ~b).sum())
                    if p1 >= SUPPORT:
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - before)
                        if gain > best[0]:
                            best = (gain, (name, sign, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= fits([best[1]], x)
    return rule


def cover(x: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray) -> Rules:
    """The decision list for the low-quality rows `bad`; rows of `prune` prune, the rest grow."""
    found: list[list[tuple[str, str, float]]] = []
    alive = np.ones(len(bad), bool)
    while len(found) < MOST_RULES and (alive & bad & ~prune).sum() >= SUPPORT:
        rule = _grow(x, bad, alive & ~prune)
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            m = fits(rule[:k], x) & alive & prune
            p, n = int((m & bad).sum()), int((m & ~bad).sum())
            worth.append(((p - n) / (p + n) if p + n else -1.0, p, -k, k))
        value, p, _, k = max(worth)
        if (value + 1) / 2 < PRECISION or not p:
            break
        found.append(rule[:k])
        alive &= ~fits(rule[:k], x)
    return Rules(found)


def learn(counts: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Rules:
    """Learns from the rows of `counts` that `labels` (doc_id, quality) marks, at most `sample_rows` of them."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    n = marked.count()
    if not n:
        return Rules([])
    if n > sample_rows:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * (sample_rows / n) * 0.98))
    side = F.pmod(F.xxhash64(F.lit("prune"), F.col("doc_id")), F.lit(3)) == 0
    counts = counts.select(*(c.split()[0] for c in COUNTS.split(", "))).join(marked, "doc_id")
    # Of rows that repeat a doc_id the one with the smallest counts.
    counts = counts.groupBy("doc_id", "quality").agg(F.min(F.struct(*counts.drop("doc_id", "quality").columns)).alias("x")).select("doc_id", "quality", "x.*")
    rows = counts.select(*(c.alias(k) for k, c in ratios().items()), (F.col("quality") == 0).alias("_bad"), side.alias("_prune"), base_failed().alias("_out"), "doc_id").where("not _out").orderBy("doc_id").toPandas()
    if not len(rows) or rows["_bad"].all() or not rows["_bad"].any():
        return Rules([])
    return cover({k: rows[k].to_numpy() for k in ratios()}, rows["_bad"].to_numpy(), rows["_prune"].to_numpy())


def judge(counts: DataFrame, rules: Rules) -> DataFrame:
    """`counts` with base_failed and kept."""
    return counts.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.column())
