"""Secret scan: fixed patterns, and a battery of randomness tests with length-aware false-discovery control.

DataFrame functions only. Candidates are runs of 20 and more characters of the base64 alphabets. Each gets the
smallest encoding that holds it (digits, hex, letters of one case, base32, letters, base62, base64, base64url), and with that encoding's alphabet:

* chi-squared uniformity: how far the statistic lies below what text spelt in this alphabet would give (its
  expectation and variance are those of a non-central chi-squared, so short runs say little);
* a runs test: changes between digits and letters against the rate of ordinary identifiers; runs above and below the
  middle of the alphabet must be as many as a random order gives;
* lag-1 serial correlation of the symbols' places, which sequences and repeats fail.

The first two give one p-value for "this is spelt, not drawn"; where a run has no digits or only digits, changes
between them say nothing and chi-squared alone gives it. Over all candidates of the corpus, the
Benjamini-Hochberg step-up rule holds the false-discovery rate at `fdr` inside each class of lengths; it works on a
histogram of p-values of fixed size (classes x bins), so only that reaches the driver. p-values are kept as logarithms
without a ceiling, so certain secrets are found among any number of candidates.

Spans are code points, end exclusive, leftmost and non-overlapping for each kind. A run of the battery (kind `random`)
is added where it overlaps no pattern's span. Null texts are empty; very long texts and runs are scanned whole. Repeated
rows, and null ids, are rows of their own; spans that begin together stand in the order of their kinds; equal p-values
are discoveries together or not at all. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, written

KINDS = ("assign", "access", "hex", "random")
HEAD = r"""(?i)((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
RUN = r"([A-Za-z0-9+/_=-]{20,})"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
FDR = 0.01
#: Lengths at which a new class begins.
CLASSES = (20, 24, 32, 48, 96)
#: Bins of -log10(p): STEPS to a unit up to FINE, and STEPS_TEN to a power of ten beyond, far above what any run reaches.
FINE, STEPS, STEPS_TEN = 10, 10, 40
BINS = FINE * STEPS + 8 * STEPS_TEN
#: Sum of squared letter frequencies of ordinary spelling, and its rate of changes between digits and letters.
SPELT, CHANGES = 0.066, 0.08
#: Sum of squared digit frequencies of ordinary numbers.
NUMBERS = 1.9 / 16
#: Bound on the z-scores of the order tests.
ORDER_Z = 3.5
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the smallest on: pattern, alphabet.
ENCODINGS = (
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[a-z]+$", LOWER),
    (r"^[A-Z]+$", UPPER),
    (r"^[A-Z2-7]+=*$", UPPER + "234567"),
    (r"^[A-Za-z]+$", UPPER + LOWER),
    (r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    (r"^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    (r"^[0-9A-Za-z_=-]+$", UPPER + LOWER + DIGITS + "-_"),
)
#: Private-use characters that mark matches; texts that hold them get MARK_FREE there, which no pattern matches.
MARKS, MARK_FREE = "\ue000\ue001\ue002", "\ue003"

SPAN = "array<struct<s:int,e:int,v:string>>"


#: Lengths that are summed together: sums of a text's parts are taken in groups, then of the groups.
GROUP = 128


def before(lengths: Column) -> Column:
    """For each of some lengths the sum of those before it. An array that grows is copied at every step, so sums are taken
    in groups of GROUP: work is linear in the lengths for any text of practical size."""
    none = F.array().cast("array<int>")

    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(values, start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))

    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / GROUP).cast("int")), lambda k: sums(F.slice(lengths, k * GROUP + 1, F.lit(GROUP))))
    joined = lambda g: F.flatten(F.zip_with(g, sums(F.transform(g, lambda x: x["at"]))["out"], lambda x, a: F.transform(x["out"], lambda o: o + a)))
    return once(groups, joined)


def spans(text: Column, pattern: str, least: int, two: bool = False) -> Column:
    """Matches of `pattern` as (start, end, value): one group, or a head and a value. The value has `least` characters."""
    a, b, c = MARKS
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{a}$1{b}$2{c}" if two else f"{a}$1{b}"))
    parts = F.split(marked, f"[{MARKS}]")
    step = 3 if two else 2

    def found(parts: Column) -> Column:
        def at(x: Column) -> Column:
            value = lambda p, i: F.struct(i.alias("i"), F.get(x["begin"], i - 1 if two else i).alias("s"), (F.get(x["begin"], i) + F.length(p)).alias("e"), p.alias("v"))
            hits = F.filter(F.transform(x["parts"], value), lambda y: (F.pmod(y["i"], F.lit(step)) == step - 1) & (F.length(y["v"]) >= least))
            return F.transform(hits, lambda y: F.struct(y["s"], y["e"], y["v"]))

        return once(F.struct(parts.alias("parts"), before(F.transform(parts, F.length)).alias("begin")), at)

    return once(parts, lambda p: F.when(F.size(p) > 1, found(p)).otherwise(F.array().cast(SPAN)))


def tail(z: Column) -> Column:
    """-log10 of the normal distribution's upper tail (Mills' ratio by Shenton and Sampford's bounds), in logarithms, so
    that no z is too large."""
    return F.when(z > 0, z * z / 2 * 0.4342944819032518 + 0.3990899341790575 + F.log10((3 * z + F.sqrt(z * z + 8)) / 4)).otherwise(0.0)


def bin_of(x: Column) -> Column:
    coarse = FINE * STEPS + F.floor(F.log10(F.greatest(x, F.lit(float(FINE))) / FINE) * STEPS_TEN + 1e-9)
    return F.least(F.when(x < FINE, F.floor(x * STEPS)).otherwise(coarse), F.lit(BINS - 1)).cast("int")


def lower_edge(b: int) -> float:
    """The smallest -log10(p) of a bin."""
    return b / STEPS if b < FINE * STEPS else FINE * 10 ** ((b - FINE * STEPS) / STEPS_TEN)


def battery(run: Column) -> Column:
    """-log10(p) that `run` is spelt rather than drawn at random; 0 where the order of its symbols fails."""
    body = F.regexp_replace(run, "=+$", "")
    alphabet = None
    for pattern, letters in ENCODINGS:
        alphabet = F.when(run.rlike(pattern), F.lit(letters)) if alphabet is None else alphabet.when(run.rlike(pattern), F.lit(letters))
    alphabet = alphabet.otherwise(F.lit(UPPER + LOWER + DIGITS + "+/-_"))
    # Each step's values are computed once and handed to the next: an expression inside a lambda runs for every element.
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    but_last = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
    but_first = lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    changes = lambda a: total(F.zip_with(but_last(a), but_first(a), lambda u, v: F.when(u != v, 1.0).otherwise(0.0)))
    base = F.struct(body.alias("body"), F.length(body).cast("double").alias("n"), alphabet.alias("abc"), F.filter(F.split(body, ""), lambda c: c != "").alias("chars"))

    def places(x: Column) -> Column:
        at = F.transform(x["chars"], lambda c: F.instr(x["abc"], c).cast("double"))
        digit = F.transform(x["chars"], lambda c: F.when(c.between("0", "9"), 1).otherwise(0))
        # How often each symbol comes, squared and summed: a symbol's count is what its removal takes away.
        squares = total(F.transform(F.array_distinct(x["chars"]), lambda c: F.pow(x["n"] - F.length(F.replace(x["body"], c, F.lit(""))), F.lit(2.0))))
        return F.struct(x["n"].alias("n"), F.length(x["abc"]).cast("double").alias("k"), at.alias("at"), digit.alias("digit"), squares.alias("squares"))

    def means(x: Column) -> Column:
        high = F.transform(x["at"], lambda v: F.when(v > x["k"] / 2, 1.0).otherwise(0.0))
        return F.struct(x["n"].alias("n"), x["k"].alias("k"), x["at"].alias("at"), x["digit"].alias("digit"), x["squares"].alias("squares"), (total(x["at"]) / x["n"]).alias("mean"), high.alias("high"))

    def moments(x: Column) -> Column:
        from_mean = F.transform(x["at"], lambda v: v - x["mean"])
        power = total(F.transform(from_mean, lambda d: d * d))
        lagged = total(F.zip_with(but_last(from_mean), but_first(from_mean), lambda u, v: u * v))
        mixed = F.array_contains(x["digit"], 1) & F.array_contains(x["digit"], 0)
        fields = {"n": x["n"], "k": x["k"], "squares": x["squares"], "power": power, "lagged": lagged, "n1": total(x["high"]), "runs": changes(x["high"]) + 1, "switches": changes(x["digit"]), "mixed": mixed}
        return F.struct(*(v.alias(k) for k, v in fields.items()))

    def verdict(x: Column) -> Column:
        n, k = x["n"], x["k"]
        chi = k / n * x["squares"] - n
        # Spelling in k symbols is as uneven as in letters; hex has the unevenness of decimal numbers.
        more = n * F.when(k <= 16, k * NUMBERS - 1).otherwise(k * SPELT - 1)
        z1 = (k - 1 + more - chi) / F.sqrt(2 * (k - 1) + 4 * more)
        z2 = (x["switches"] - (n - 1) * CHANGES) / F.sqrt((n - 1) * CHANGES * (1 - CHANGES))
        n1, n2 = x["n1"], n - x["n1"]
        spread = F.sqrt(F.greatest(2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * F.greatest(n - 1, F.lit(1.0))), F.lit(1e-9)))
        z_runs = F.when((n1 == 0) | (n2 == 0), 99.0).otherwise((x["runs"] - 2 * n1 * n2 / n - 1) / spread)
        z_serial = F.when(x["power"] > 0, x["lagged"] / x["power"]).otherwise(1.0) * F.sqrt(n)
        drawn = (F.abs(z_runs) <= ORDER_Z) & (F.abs(z_serial) <= ORDER_Z)
        return F.when((n >= CLASSES[0]) & drawn, once(F.when(x["mixed"], (z1 + z2) / (2**0.5)).otherwise(z1), tail)).otherwise(0.0)

    return once(once(once(once(base, places), means), moments), verdict)


def length_class(n: Column) -> Column:
    out = F.lit(0)
    for k, least in enumerate(CLASSES):
        out = F.when(n >= least, k).otherwise(out)
    return out


def step_up(histogram: list[tuple[int, int, int]], fdr: float = FDR) -> dict[int, int]:
    """(class, bin, count) -> for each class the smallest bin of -log10(p) that is a discovery (BINS: none)."""
    out = {}
    for k in range(len(CLASSES)):
        counts = [0] * BINS
        for c, b, n in histogram:
            if c == k:
                counts[b] += n
        total, passed, least = sum(counts), 0, BINS
        for b in range(BINS - 1, -1, -1):
            passed += counts[b]
            # Every p-value p of the bin has -log10(p) of the lower edge at least, and p * total / passed <= fdr is wanted.
            if counts[b] and lower_edge(b) >= math.log10(total / passed) - math.log10(fdr):
                least = b
        out[k] = least
    return out


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, one array of spans for each pattern, and the candidates with class and bin."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), MARKS, MARK_FREE * len(MARKS))
    d = docs.select("doc_id", text.alias("_t"))
    d = d.select(
        "doc_id",
        spans(F.col("_t"), HEAD, LEAST_ASSIGN, two=True).alias("assign"),
        spans(F.col("_t"), ACCESS, LEAST_ACCESS).alias("access"),
        spans(F.col("_t"), HEX.replace("]+", "]{%d,}" % LEAST_HEX), LEAST_HEX).alias("hex"),
        spans(F.col("_t"), RUN, CLASSES[0]).alias("runs"),
    )
    bare = lambda c: F.transform(c, lambda x: F.struct(x["s"], x["e"]))
    # What the other two patterns find has letters of runs only, so it lies in a run, whole.
    known = lambda v: v.rlike("[0-9a-f]{%d,}" % LEAST_HEX) | v.rlike("AKIA[A-Z0-9]{%d,}" % (LEAST_ACCESS - 4))
    scored = F.transform("runs", lambda x: F.struct(x["s"], x["e"], known(x["v"]).alias("known"), length_class(F.length(x["v"])).alias("class"), once(battery(x["v"]), bin_of).alias("bin")))
    return d.select("doc_id", bare("assign").alias("assign"), bare("access").alias("access"), bare("hex").alias("hex"), scored.alias("runs"))


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """(doc_id, text) -> doc_id, `found`: array of (s, e, k) with k the number of its kind, in order."""
    rows = written(find(docs), "secrets")
    counts = rows.select(F.explode("runs").alias("r")).groupBy("r.class", "r.bin").count()
    least = step_up([(r["class"], r["bin"], r["count"]) for r in counts.collect()], fdr)
    limits = F.array(*(F.lit(max(1, least[k])) for k in range(len(CLASSES))))
    tag = lambda c, k: F.transform(c, lambda x: F.struct(x["s"], x["e"], F.lit(k).alias("k")))
    base = F.concat(tag("assign", 0), tag("access", 1), tag("hex", 2))
    rows = rows.withColumn("base", base)
    drawn = F.filter("runs", lambda x: (x["bin"] >= F.element_at(limits, x["class"] + 1)) & ~x["known"] & ~F.exists("assign", lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))
    every = F.array_sort(F.transform(F.concat("base", tag(drawn, 3)), lambda x: F.struct(x["s"], x["k"], x["e"])))
    return rows.select("doc_id", F.transform(every, lambda x: F.struct(x["s"], x["e"], x["k"])).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """The counts and digests of the registered query."""
    names = F.array(*(F.lit(k) for k in KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
    base = F.filter("found", lambda x: x["k"] < 3)
    n = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        n(3).alias("n_random"),
    )
