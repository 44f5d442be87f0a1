"""Selection under caps: the next item always comes from the thinnest sector, then the thinnest sub-type.

The choice depends on what was chosen before, so it is sequential; but its rank depends on (sector, sub-type) alone.
One queue for each such pair, in pool order, with the least of (sector count, sub-type count, place) taken next gives
the same as a scan of the whole pool for each choice. The pool is ranked once, by ranges. The task that chooses gets the
head of each queue and the counts of what is taken already; where a queue runs out of its head, choosing goes on from
there, with longer heads: what was chosen counts as taken, and what was visited isn't seen again. All
other rows are labelled by joins.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import filled
from marlstone.sources.scratch import keep, ranked

NARROW = ["id", "page_url", "domain", "sector", "subtype", "image_file", "image_sha256", "element_role"]
COUNTED = ("page_url", "domain", "subtype", "sector")
DROPS = ("alreadySelected", "noImage", "duplicateImage", "pageCap", "domainCap")


@dataclass(frozen=True)
class Caps:
    add: int = 60
    goal: int = 250
    headroom: int = 1
    require_image: bool = True
    per_page: int = 2
    domain_share: float = 0.05

    def __post_init__(self):
        if self.add < 0 or self.goal < 1 or self.headroom < 1:
            raise ValueError("add must not be negative, goal and headroom at least 1")

    @property
    def domain_cap(self) -> int:
        return max(1, ceil(round(self.goal * self.domain_share * self.headroom, 9)))


def greedy(pool: list[dict], counts: dict[str, Counter], caps: Caps, done: int = 0) -> list[dict]:
    """The outcome of each row of the pool in order: chosen (with its number), a reason for its drop, or remaining.

    `counts` says how often each page_url, domain, subtype, sector and image (digest and role) is taken, `done` how many
    were chosen before. A row with `cut` marks where the head of its queue ends: it comes out as cut when it is reached,
    and nothing more is chosen. Counts only grow, so a queue's place in the heap is put right when it comes up.
    """
    columns = {c: [r[c] for r in pool] for c in COUNTED}
    columns["image"] = [(r["image_sha256"], r["element_role"]) for r in pool]
    outcome, order = _greedy(columns, [bool(r.get("cut")) for r in pool], counts, caps, done)
    return [{"id": r["id"], "outcome": OUTCOMES[o], "chosen_seq": order.get(k), "pos": r["pos"], "sector": r["sector"], "subtype": r["subtype"]} for k, (r, o) in enumerate(zip(pool, outcome, strict=True))]


OUTCOMES = ("remaining", "cut", "duplicateImage", "pageCap", "domainCap", "chosen")


def _greedy(columns: dict[str, Sequence], cut: Sequence, counts: dict[str, Counter], caps: Caps, done: int) -> tuple[bytearray, dict[int, int]]:
    """`greedy` over columns (COUNTED and image), of values or of numbers for them: places in OUTCOMES, and the chosen rows' numbers."""
    queues: dict[tuple, array] = {}
    for k, pair in enumerate(zip(columns["sector"], columns["subtype"], strict=True)):
        queues.setdefault(pair, array("q")).append(k)
    went = dict.fromkeys(queues, 0)
    place = lambda pair: (counts["sector"][pair[0]], counts["subtype"][pair[1]], queues[pair][went[pair]])
    heap: list[tuple] = []
    for n, pair in enumerate(queues):  # rows are in order, so the third of a place tells queues apart
        heappush(heap, (place(pair), n, pair))
    outcome = bytearray(len(cut))
    order: dict[int, int] = {}
    while done + len(order) < caps.add and heap:
        at, n, pair = heappop(heap)
        if at != (now := place(pair)):
            heappush(heap, (now, n, pair))
            continue
        k = queues[pair][went[pair]]
        went[pair] += 1
        image = columns["image"][k]
        if cut[k]:
            outcome[k] = 1
            break
        if caps.require_image and counts["image"][image]:
            outcome[k] = 2
        elif counts["page_url"][columns["page_url"][k]] >= caps.per_page:
            outcome[k] = 3
        elif counts["domain"][columns["domain"][k]] >= caps.domain_cap:
            outcome[k] = 4
        else:
            outcome[k] = 5
            order[k] = done + len(order)
            counts["image"][image] += 1
            for c in COUNTED:
                counts[c][columns[c][k]] += 1
        if went[pair] < len(queues[pair]):
            heappush(heap, (place(pair), n, pair))
    return outcome, order


def _counts(taken: DataFrame, heads: DataFrame) -> DataFrame:
    """(field, key, role, n): how often what stands in the heads of the queues is taken already."""
    none = F.lit(None).cast("string")
    parts = []
    for c in (*COUNTED, "image"):
        key, role = (F.col("image_sha256"), F.col("element_role")) if c == "image" else (F.col(c), none)
        n = taken.groupBy(key.alias("key"), role.alias("role")).agg(F.count("*").alias("n")).alias("t")
        if c not in ("subtype", "sector"):
            mine = heads.select(key.alias("key"), role.alias("role")).distinct().alias("h")
            n = n.join(mine, F.expr("t.key <=> h.key and t.role <=> h.role"), "left_semi")
        parts.append(n.select(F.lit(c).alias("field"), "key", "role", F.col("n").cast("long").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _choice(caps: Caps, done: int) -> Callable[[pa.Table], pa.Table]:
    """What the choosing task does with the heads of all queues and the counts, `done` having been chosen before.

    Heads can hold the whole pool where caps are full, so rows stay in Arrow, and values are numbers in arrays.
    """

    def run(table: pa.Table) -> pa.Table:
        facts = table.filter(pc.is_valid(table["field"])).select(["field", "key", "role", "n"])
        table = table.filter(pc.is_null(table["field"])).select(["at", "pos", "cut", *COUNTED, "image_sha256", "element_role"])
        by = pc.sort_indices(table, sort_keys=[("pos", "ascending"), ("at", "ascending")])
        numbers, values = {}, {}
        for c in (*COUNTED, "image_sha256", "element_role"):
            coded = table[c].combine_chunks().dictionary_encode(null_encoding="encode")
            values[c], numbers[c] = coded.dictionary, coded.indices.take(by).to_numpy().astype("int64")
        at, cut = table["at"].combine_chunks().take(by), table["cut"].combine_chunks().take(by).to_numpy(zero_copy_only=False).astype("uint8").tobytes()
        del table
        roles = max(1, len(values["element_role"]))
        numbers["image"] = numbers.pop("image_sha256") * roles + numbers.pop("element_role")
        columns = {c: array("q", v.tobytes()) for c, v in numbers.items()}
        counts = {c: Counter() for c in (*COUNTED, "image")}
        for c in counts:
            mine = facts.filter(pc.equal(facts["field"], c))
            place = lambda given, c, mine=mine: pc.index_in(mine[given].cast(values[c].type), value_set=values[c]).to_pylist()
            keys = zip(place("key", "image_sha256"), place("role", "element_role"), strict=True) if c == "image" else zip(place("key", c), strict=True)
            for key, n in zip(keys, mine["n"].to_pylist(), strict=True):
                if None not in key:  # what no head has matters to none
                    counts[c][key[0] * roles + key[1] if c == "image" else key[0]] += n
        outcome, order = _greedy(columns, cut, counts, caps, done)
        told = pa.DictionaryArray.from_arrays(pa.array(np.frombuffer(bytes(outcome), dtype="int8")), pa.array(OUTCOMES)).cast(pa.string())
        chosen = np.full(len(outcome), -1, dtype="int32")
        for k, n in order.items():
            chosen[k] = n
        return pa.table({"at": at, "outcome": told, "chosen_seq": pa.array(chosen, mask=chosen < 0)})

    return run


def select(pool: DataFrame, taken: DataFrame, caps: Caps, head: int = 256) -> DataFrame:
    """(id, outcome, chosen_seq, pos) for the pool (columns NARROW and pos); `head` is how much of a queue is tried first."""
    narrow = [c for c in NARROW if c in pool.columns]
    missing = [F.lit(None).cast("string").alias(c) for c in NARROW if c not in narrow]
    side = lambda df: df.select(*narrow, *missing, F.col("pos").cast("long") if "pos" in df.columns else F.lit(0).cast("long").alias("pos"))
    rows, taken = side(pool), side(taken)
    ids = taken.select(F.col("id").alias("_id")).distinct()
    has_image = filled(F.col("image_file")) & filled(F.col("image_sha256"))
    label = F.when(F.col("_id").isNotNull(), "alreadySelected").when(~has_image if caps.require_image else F.lit(False), "noImage")
    rows = rows.join(ids, F.col("id") == F.col("_id"), "left").withColumn("label", label).drop("_id")
    same = lambda a, b: F.col(f"{a}.sector").eqNullSafe(F.col(f"{b}.sector")) & F.col(f"{a}.subtype").eqNullSafe(F.col(f"{b}.subtype"))
    order = [F.col("sector").asc_nulls_first(), F.col("subtype").asc_nulls_first(), "pos", "id"]
    pooled = keep(ranked(rows.where("label is null").drop("label"), order, "at"), "queues")
    queues = keep(pooled.groupBy("sector", "subtype").agg(F.min("at").alias("from")).withColumn("to", F.col("from") + head), "heads")
    visited, done = None, 0
    while True:
        heads = pooled.alias("p").join(queues.alias("q"), same("p", "q")).where((F.col("at") >= F.col("from")) & (F.col("at") <= F.col("to"))).select("p.*", (F.col("at") == F.col("to")).alias("cut"))
        heads = keep(heads, "given")
        before = taken
        if visited is not None:
            mine = visited.where("outcome = 'chosen'").select(F.col("id").alias("_id"), F.col("pos").alias("_pos"))
            before = taken.unionByName(rows.join(mine, F.col("pos").eqNullSafe(F.col("_pos")) & F.col("id").eqNullSafe(F.col("_id"))).select(*taken.columns))
        facts = keep(_counts(before, heads), "taken")
        given = heads.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("field", "string"), ("key", "string"), ("role", "string"), ("n", "long"))))
        given = given.unionByName(facts, allowMissingColumns=True)

        given = given.select("at", "pos", "cut", *COUNTED, "image_sha256", "element_role", "field", "key", "role", "n")
        found = given.groupBy(F.lit(0).alias("_all")).applyInArrow(_choice(caps, done), "at long, outcome string, chosen_seq int")
        found = keep(found.join(heads.select("at", "id", "pos", "sector", "subtype"), "at").select("id", "outcome", "chosen_seq", "pos", "sector", "subtype"), "outcomes")
        seen = found.where("outcome not in ('remaining', 'cut')")
        visited = seen if visited is None else visited.unionByName(seen)
        if found.where("outcome = 'cut'").isEmpty():
            break
        done = visited.where("outcome = 'chosen'").count()
        # Every queue goes on behind what was visited of it, with a head eight times as long: few rounds for any length.
        head *= 8
        went = seen.groupBy("sector", "subtype").agg(F.count("*").alias("went"))
        at = F.col("from") + F.coalesce("went", F.lit(0))
        queues = keep(queues.alias("q").join(went.alias("w"), same("q", "w"), "left").select("q.sector", "q.subtype", at.alias("from"), (at + head).alias("to")), "heads")
    found = visited
    found = found.select(F.col("pos").alias("_pos"), F.col("id").alias("_id"), "outcome", "chosen_seq")
    out = rows.join(found, F.col("pos").eqNullSafe(F.col("_pos")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    return out.select("id", F.coalesce("label", "outcome", F.lit("remaining")).alias("outcome"), "chosen_seq", "pos")


def chosen(pool: DataFrame, outcome: DataFrame) -> DataFrame:
    """The chosen rows of the pool, with chosen_seq."""
    return pool.join(outcome.where("outcome = 'chosen'").select("id", "pos", "chosen_seq"), ["id", "pos"])


def summary(outcome: DataFrame) -> DataFrame:
    """(outcome, n); drops cover visited rows only."""
    return outcome.groupBy("outcome").count().withColumnRenamed("count", "n")


def pending(shortlist: DataFrame, corpus: DataFrame) -> DataFrame:
    return shortlist.join(corpus.select("id"), "id", "left_anti")


def shortlist(pool: DataFrame, corpus: DataFrame, listed: DataFrame, want: int, goal: int = 250, headroom: int = 3) -> DataFrame:
    """Outcome of filling the shortlist up to `want` pending rows; a row in both tables counts twice against the caps."""
    add = max(0, want - pending(listed, corpus).count())
    columns = [c for c in NARROW if c in corpus.columns and c in listed.columns]
    taken = corpus.select(*columns).unionByName(listed.select(*columns))
    return select(pool, taken, Caps(add, goal, headroom, require_image=False))


def with_images(items: DataFrame) -> DataFrame:
    return items.where(filled(F.col("image_file")) & filled(F.col("image_sha256")))


def state(outcome: DataFrame, refused: bool = False) -> int:
    """0 selected, 1 nothing, 2 refused."""
    return 2 if refused else 1 if outcome.where("outcome = 'chosen'").isEmpty() else 0
