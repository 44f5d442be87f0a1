"""Mixing sources to target weights by exact block quotas and a multivariate-hypergeometric splitting tree.

DataFrame functions only. A document's size is its number of words. Each source gets a target in words: its weight's
part of all words, at most MOST_REPEATS times its own size, with the excess reshared by weight until none is above.

1. The documents of a source are dealt by hash into blocks (at most BLOCKS; few documents to a block in a small one).
2. A source's quota of blocks: whole passes over it while the target holds them, and the blocks of one partial pass, in
   permuted order, while they fit. The block at the edge is cut in the same way: it is dealt by hash into parts. In the
   part at the edge of these, documents are taken in permuted order while they fit, then the largest ones that fit into
   what is left; then one more, in place of others where it is too large, if it brings the sum nearer.
3. The quotas of all sources are split over the output shards by a binary tree: at each node the left child's share of
   every source is drawn from the multivariate hypergeometric distribution (source after source, by the inverse of the
   distribution function). Quotas stay exact at each node, and shards differ by a block at most.
4. Each shard draws its quota of every source: a stretch of a permutation of the source's blocks (of every pass), which
   no other shard has. What a document is taken is what the shards drew of its block. Inside a shard a seeded hash of
   document, copy and shard gives each row its place; `repeat` writes them in this order.

All draws are hashes of a seed, so reruns agree. Null and empty texts have size 0 and are taken with their block; very
long ones count whole. A null source is a source of its own, last in the order of sources; sources are few, one row a
source goes through one task. Null doc_ids are dealt by their texts. Rows with the same doc_id and text are taken alike,
others on their own. Of documents of one size, a hash says which is tried first. A source
without words has target 0. `mix` ignores extra columns, `repeat` returns them whatever their names are; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import once, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCKS = 4096
#: A source has a block for so many of its documents at least, and so have the parts of the block at the edge.
BLOCK_DOCS = 64
#: Documents that are sorted together, about, when shards are written.
STRIPE_DOCS = 256
LEVELS = 4
SEED = 20240131


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts and SEED alone."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def row_hash() -> Column:
    return F.xxhash64(F.lit(SEED), F.col("doc_id").cast("string"), F.lit("text"), F.col("text").cast("string"))


def sizes(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), row_hash().alias("h"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row a source: words and documents, target, whole passes and words of the partial pass.

    Targets follow one water level: with sources sorted by cap over weight, those up to some place stand at their caps
    and the others share the rest by weight. That is where resharing the excess ends.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    last = F.when(F.col("source").isNull(), 1).otherwise(0)
    everything = Window.partitionBy()
    order = F.row_number().over(Window.orderBy(last, "source"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(order - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.lit(most) * F.col("source_size").cast("double")
    t = total.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = Window.orderBy("ratio", last, "source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("caps", F.sum("cap").over(upto)).withColumn("low", F.sum("weight").over(upto))
    t = t.withColumn("all_words", F.sum("source_size").over(everything)).withColumn("all_weights", F.sum("weight").over(everything))
    # The level if the sources up to this one stood at their caps; the true level is the first that the next cap is not below.
    rest = F.col("all_weights") - F.col("low")
    level = F.when(rest > 0.5, (F.col("all_words") - F.col("caps")) / rest)
    following = F.lead("ratio").over(Window.orderBy("ratio", last, "source"))
    first = F.min("ratio").over(everything)
    t = t.withColumn("level", F.when(level <= following, level))
    plain = F.col("all_words") / F.col("all_weights")
    t = t.withColumn("water", F.when(plain <= first, plain).otherwise(F.coalesce(F.max("level").over(everything), F.max("ratio").over(everything))))
    t = t.withColumn("target", F.least("cap", F.col("water") * F.col("weight")))
    t = t.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    t = t.withColumn("part", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    t = t.withColumn("blocks", F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.ceil(F.col("n_docs") / BLOCK_DOCS))).cast("long"))
    return t.select("source", "source_size", "n_docs", "weight", "target", "passes", "part", "blocks")


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of `draws` from good + bad are good: the distribution function's inverse at u.

    Probabilities come from their ratios, starting at the mode; terms further from it than 40 standard deviations and
    40 are below any double's precision next to it.
    """
    d = lambda c: c.cast("double")
    none, nothing = F.array().cast("array<double>"), F.array().cast("array<bigint>")

    def support(x: Column) -> Column:
        low, high = F.greatest(F.lit(0).cast("long"), x["draws"] - x["bad"]), F.least(x["draws"], x["good"])
        mode = F.floor((x["draws"] + 1.0) * (x["good"] + 1.0) / (x["good"] + x["bad"] + 2.0)).cast("long")
        p = x["good"] / F.greatest(x["good"] + x["bad"], F.lit(1).cast("long"))
        reach = F.ceil(40 * F.sqrt(x["draws"] * p * (1 - p)) + 40).cast("long")
        return F.struct(x["good"].alias("good"), x["bad"].alias("bad"), x["draws"].alias("draws"), x["u"].alias("u"), low.alias("low"), high.alias("high"), F.least(high, F.greatest(low, mode)).alias("mode"), reach.alias("reach"))

    def terms(x: Column) -> Column:
        lo, hi = F.greatest(x["low"], x["mode"] - x["reach"]), F.least(x["high"], x["mode"] + x["reach"])
        up = lambda k: d(x["good"] - k) * d(x["draws"] - k) / (d(k + 1) * d(x["bad"] - x["draws"] + k + 1))  # noqa: E731  P(k+1) / P(k)

        def walk(steps: Column, factor) -> Column:
            """Weights relative to the mode's, step by step away from it."""
            step = lambda s, k: once(s["w"] * factor(k), lambda w: F.struct(w.alias("w"), F.concat(s["all"], F.array(w)).alias("all")))
            return F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), none.alias("all")), step, lambda s: s["all"])

        right = walk(F.when(hi > x["mode"], F.sequence(x["mode"], hi - 1)).otherwise(nothing), up)
        left = walk(F.when(x["mode"] > lo, F.sequence(x["mode"] - 1, lo, F.lit(-1).cast("long"))).otherwise(nothing), lambda k: 1.0 / up(k))
        return F.struct(x["u"].alias("u"), lo.alias("lo"), hi.alias("hi"), F.concat(F.reverse(left), F.array(F.lit(1.0)), right).alias("terms"))

    def inverse(x: Column) -> Column:
        total = F.aggregate(x["terms"], F.lit(0.0), lambda a, t: a + t)
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))

        def passed(bound: Column) -> Column:
            return F.aggregate(x["terms"], start, lambda s, t: F.struct((s["sum"] + t).alias("sum"), (s["n"] + F.when(s["sum"] + t <= bound, 1).otherwise(0)).cast("long").alias("n")), lambda s: s["n"])

        return F.least(x["hi"], x["lo"] + once(x["u"] * total, passed))

    given = F.struct(good.alias("good"), bad.alias("bad"), draws.alias("draws"), u.alias("u"))
    return once(once(once(given, support), terms), inverse)


def _draw(level: int):
    """One source's quota for the left child, given those before it."""

    def step(s: Column, x: Column) -> Column:
        after = s["rest"] - x
        got = F.when(after <= 0, s["draws"]).otherwise(hypergeometric(x, after, s["draws"], uniform(F.lit(level), s["place"], F.size(s["out"]))))
        return once(got, lambda n: F.struct(after.alias("rest"), (s["draws"] - n).alias("draws"), s["place"].alias("place"), F.concat(s["out"], F.array(n)).alias("out")))

    return step


def split(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(k, quota) for each source k of 0, 1, ... -> (k, shard, first, n): each shard's stretch of the source's blocks.

    Rows are nodes of the tree: they hold the quotas of all sources, and their place. The root's are gathered from the
    sources' table, one number a source.
    """
    node = quotas.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "quota"))), lambda x: x["quota"]).alias("have")).where("size(have) > 0")
    node = node.select(F.lit(0).cast("long").alias("place"), F.transform("have", lambda x: F.lit(0).cast("long")).alias("from"), "have")
    empty = F.array().cast("array<bigint>")
    for level in range(levels):
        total = F.aggregate("have", F.lit(0).cast("long"), lambda a, x: a + x)
        odd = F.when(F.pmod(total, F.lit(2)) == 1, F.when(uniform(F.lit("odd"), F.lit(level), F.col("place")) < 0.5, 1).otherwise(0)).otherwise(0)
        node = node.withColumn("all", total).withColumn("half", (F.floor(total / 2) + odd).cast("long"))

        start = F.struct(F.col("all").alias("rest"), F.col("half").alias("draws"), F.col("place").alias("place"), empty.alias("out"))
        node = node.withColumn("left", F.aggregate("have", start, _draw(level), lambda s: s["out"]))
        one = F.struct((F.col("place") * 2).alias("place"), F.col("from").alias("from"), F.col("left").alias("have"))
        two = F.struct((F.col("place") * 2 + 1).alias("place"), F.zip_with("from", "left", lambda a, b: a + b).alias("from"), F.zip_with("have", "left", lambda a, b: a - b).alias("have"))
        node = node.select(F.explode(F.array(one, two)).alias("n")).select("n.place", "n.from", "n.have")
    pairs = F.arrays_zip("from", "have")
    return node.select(F.col("place").cast("int").alias("shard"), F.posexplode(pairs).alias("k", "x")).select("k", "shard", F.col("x.from").alias("first"), F.col("x.have").alias("n")).where("n > 0")


def affine(i: Column, n: Column, *seed: Column) -> Column:
    """i's place in a permutation of 0 ... n-1."""
    primes = (1_000_003, 1_000_033, 1_000_037, 1_000_039)  # n < 3 * BLOCKS + 3 has none of them as a factor
    a = F.element_at(F.array(*(F.lit(p).cast("long") for p in primes)), (F.floor(uniform(F.lit("a"), *seed) * len(primes)) + 1).cast("int"))
    return F.pmod(i * a + F.floor(uniform(F.lit("b"), *seed) * n).cast("long"), n)


def cut(units: DataFrame, unit: str, seed: str, room: str) -> DataFrame:
    """Units (k, `unit`, words) of each source k in permuted order, with `rank`, and `left`: -1 where the whole unit fits
    into `room` words, else the words of it that do."""
    order = Window.partitionBy("k").orderBy(F.xxhash64(F.lit(SEED), F.lit(seed), F.col("k"), F.col(unit)), unit)
    upto = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    units = units.withColumn("rank", F.row_number().over(order) - 1).withColumn("upto", upto)
    left = F.when(F.col(room) <= 0, 0).when(F.col("upto") <= F.col(room), -1).otherwise(F.greatest(F.lit(0).cast("long"), F.col(room) - F.col("upto") + F.col("words")))
    return units.withColumn("left", left).drop("upto")


def largest_first(docs: Column, room: Column) -> Column:
    """Those of `docs` (less, by, h) that still fit into `room`, tried from the largest on, and what is left of it: (hs, left)."""

    def step(s: Column, x: Column) -> Column:
        fits = s["left"] + x["less"] >= 0
        return F.struct(F.when(fits, s["left"] + x["less"]).otherwise(s["left"]).alias("left"), F.when(fits, F.concat(s["hs"], F.array(x["h"]))).otherwise(s["hs"]).alias("hs"))

    return F.aggregate(F.array_sort(docs), F.struct(room.alias("left"), F.array().cast("array<bigint>").alias("hs")), step)


def fill(ranked: DataFrame) -> DataFrame:
    """(k, h, words, room, fits) -> (k, some): the documents of a piece that are taken, one row a source.

    To those that fit in order come the largest ones that still fit into what they leave. Then the smallest of the others
    takes the place of the largest ones that its excess holds, if that brings the sum nearer.
    """
    one = F.struct((-F.col("words")).alias("less"), F.xxhash64(F.lit(SEED), F.col("h")).alias("by"), "h")
    room = F.max("room") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("words"))), F.lit(0))
    g = ranked.groupBy("k").agg(room.alias("room"), F.collect_list(F.when(F.col("fits"), one)).alias("fit"), F.collect_list(F.when(~F.col("fits") & (F.col("words") > 0), one)).alias("unfit"))
    g = g.withColumn("more", largest_first(F.col("unfit"), F.col("room")))
    added = lambda x: F.array_contains("more.hs", x["h"])
    g = g.withColumn("next", F.array_max(F.filter("unfit", lambda x: ~added(x)))).withColumn("taken", F.concat("fit", F.filter("unfit", added)))
    excess = -F.col("next.less") - F.col("more.left")
    g = g.withColumn("out", largest_first(F.filter("taken", lambda x: x["less"] < 0), excess))
    hs = F.transform("taken", lambda x: x["h"])
    swapped = F.array_append(F.array_except(hs, F.col("out.hs")), F.col("next.h"))
    return g.select("k", F.when(F.col("out.left") < F.col("more.left"), swapped).otherwise(hs).alias("some"))


def draw(blocks: DataFrame, sources: DataFrame, levels: int) -> DataFrame:
    """(k, block, rank, left, passes) -> (k, block, shards): the shards that drew the block, in order of the passes.

    Each taking of a block has a number in its source's permutation; the tree says which shard holds which stretch.
    """
    of_source = Window.partitionBy("k")
    times = (F.col("passes") + F.when(F.col("left") != 0, 1).otherwise(0)).cast("int")
    b = blocks.withColumn("times", times).withColumn("in_source", F.count("*").over(of_source)).withColumn("quota", F.sum("times").over(of_source))
    quotas = sources.select("k").join(b.groupBy("k").agg(F.max("quota").alias("quota")), "k", "left").select("k", F.coalesce("quota", F.lit(0)).cast("long").alias("quota"))
    drawn = written(split(written(quotas, "quotas"), levels), "leaves").select("k", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("number"))
    takings = b.where("times > 0").select("k", "block", "rank", "in_source", "quota", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("nth"))
    takings = takings.withColumn("number", affine(F.col("nth") * F.col("in_source") + F.col("rank"), F.col("quota"), F.col("k")))
    held = takings.join(drawn, ["k", "number"]).groupBy("k", "block").agg(F.array_sort(F.collect_list(F.struct("nth", "shard"))).alias("held"))
    return held.select("k", "block", F.transform("held", lambda x: x["shard"]).alias("shards"))


def with_block(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows (source, h, ...) with what `sources` says and their block; a source with a third of all rows is spread."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    # One small row a source: it joins by a broadcast while Spark sees it is small, else by a salted shuffle.
    small = sources.withColumn("key", key).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31)))).drop("source")
    rows = rows.withColumn("key", key).withColumn("salt", F.pmod(F.col("h"), F.lit(32)).cast("int")).join(small, ["key", "salt"]).drop("key", "salt")
    return rows.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), F.lit("block"), F.col("h")), F.col("blocks")))


def part_of(parts: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit("part"), F.col("h")), F.col(parts))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, levels: int = LEVELS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sizes of the documents, the sources, and the blocks with the shards that drew them, as written tables.

    At a source's edge block, `whole` has the parts of it that the partial pass takes and `some` the documents of one more.
    """
    sized = written(sizes(docs), "sizes")
    t = targets(sized, weights, most)
    t = t.withColumn("k", (F.row_number().over(Window.orderBy(F.when(F.col("source").isNull(), 1).otherwise(0), "source")) - 1).cast("int"))
    parts = F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.ceil(F.col("n_docs") / F.col("blocks") / BLOCK_DOCS))).cast("long")
    sources = written(t.withColumn("parts", parts).drop("weight"), "sources")
    d = with_block(sized, sources)
    b = d.groupBy("k", "block").agg(F.sum("size").alias("words"), F.first("part").alias("part"), F.first("passes").alias("passes"))
    b = written(cut(b, "block", "rank", "part").select("k", "block", "rank", "left", "passes"), "blocks")

    edge = d.join(b.where("left > 0").select("k", "block", "left"), ["k", "block"]).withColumn("piece", part_of("parts"))
    pieces = written(cut(edge.groupBy("k", "piece").agg(F.sum("size").alias("words"), F.first("left").alias("room")), "piece", "piece", "room"), "pieces")
    whole = pieces.groupBy("k").agg(F.collect_list(F.when(F.col("left") < 0, F.col("piece"))).alias("whole"))
    # The piece at the edge, document by document.
    docs_of = edge.drop("left").join(pieces.where("left > 0").select("k", "piece", "left"), ["k", "piece"]).groupBy("k", "h").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    ranked = cut(docs_of.withColumnRenamed("left", "room"), "h", "edge", "room").withColumn("fits", F.col("left") < 0).drop("left")
    cuts = written(whole.join(fill(ranked), "k", "left").select("k", "whole", F.coalesce("some", F.array().cast("array<bigint>")).alias("some")), "cuts")

    edges = b.where("left > 0").select("k", "block").join(cuts, "k")
    blocks = b.join(written(draw(b, sources, levels), "draws"), ["k", "block"], "left").join(edges, ["k", "block"], "left")
    blocks = blocks.select("k", "block", F.coalesce("shards", F.array().cast("array<int>")).alias("shards"), "whole", "some")
    return sized, sources, written(blocks, "drawn")


def taken(rows: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (source, h, ...) with `shards`, one for each time that the row is taken, and its `places` in them."""
    d = with_block(rows, sources).join(blocks, ["k", "block"])
    whole = F.col("whole").isNull() | F.array_contains("whole", part_of("parts")) | F.array_contains("some", F.col("h"))
    times = F.size("shards") - F.when(whole, 0).otherwise(1)
    d = d.withColumn("shards", F.slice("shards", F.lit(1), F.greatest(times, F.lit(0))))
    return d.withColumn("places", F.transform("shards", lambda s, i: uniform(F.lit("place"), F.col("h"), i, s)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, levels: int = LEVELS) -> DataFrame:
    """(doc_id, text, source) -> doc_id, size, source_size, target, taken, times, shards and places (one for each time)."""
    sized, sources, blocks = plan(docs, weights, most, levels)
    d = taken(sized, sources, blocks).withColumn("times", F.size("shards"))
    return d.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"), "times", "shards", "places")


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, levels: int = LEVELS) -> DataFrame:
    """`docs` as the mix takes them: a row for each time that it is taken, shard by shard in the order of places.

    A partition holds a stripe of a shard, or several of them.
    """
    _, sources, blocks = plan(docs, weights, most, levels)
    n = sources.agg(F.sum("n_docs")).first()[0] or 0
    stripes = max(1, -(-n // (STRIPE_DOCS << levels)))
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), row_hash().alias("h"))
    rows = taken(rows, sources, blocks).select("row", F.explode(F.arrays_zip("shards", "places")).alias("x")).select("row", "x.shards", "x.places")
    rows = rows.repartition("shards", F.floor(F.col("places") * stripes)).sortWithinPartitions("shards", "places")
    return rows.select("row.*")
