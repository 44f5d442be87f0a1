"""Conversations as training text: templates that are compiled, and generation markers as a loss mask.

`render` formats (conv_id, turn, role, text) by a template (see `templates`), and `read_back` gets the turns and what is
under the mask out of the formatted text again; texts that hold control strings survive, as those are escaped.

Rows are dealt by conversation and stretch of TURNS turn numbers, and stream through a task in order, so a
conversation of any length is dealt over tasks. For a conversation with several stretches, rows that say which place
each stretch begins at travel with its turns; no other conversation needs them. A conversation's text leaves in
segments of about SEGMENT characters, split between turns: one segment is all of most conversations, and what is written
before and behind the loop stands in the first and the last one.

Results. `render`: conv_id, place (of the segment's first turn), n_turns, whole (it is all of its conversation),
formatted, spans (start, end of each stretch to learn: code points in `formatted`, end exclusive). `digests`: one row a
conversation, whose hashes are taken over its segments in order, one at a time.

Turns are ordered by turn, then role, then text (nulls last; repeated rows are turns of their own). Null texts and roles are
empty. Rows with a null conv_id are one conversation. Very long texts are formatted whole; a text is never split. An
empty table has no conversations. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .templates import Output, Template, Turn, compile_template, escaper
from .words import tidied

#: Turn numbers of one stretch, and characters of a segment.
TURNS, SEGMENT = 512, 1 << 20
#: The control strings of TEMPLATE.
BOS, EOS = "<s>", "</s>"
CONTROLS = (BOS, EOS, "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "[REPLY]")
TEMPLATE = """
{{- bos -}}
{%- for message in messages -%}
  {%- if message.role == 'user' -%}
    [INST]{{ message.text | escape }}[/INST]
  {%- elif message.role == 'assistant' -%}
    [REPLY]{% generation %}{{ message.text | escape }}{% endgeneration %}{{ eos }}
  {%- elif message.role == 'system' -%}
    [SYS]{{ message.text | escape }}[/SYS]
  {%- else -%}
    [ROLE]{{ message.role | escape }}[TEXT]{{ message.text | escape }}[/ROLE]
  {%- endif -%}
{%- endfor -%}
"""
#: A turn as TEMPLATE writes it.
WRITTEN = re.compile(r"\[INST\](?P<user>.*?)\[/INST\]|\[REPLY\](?P<assistant>.*?)</s>|\[SYS\](?P<system>.*?)\[/SYS\]|\[ROLE\](?P<role>.*?)\[TEXT\](?P<other>.*?)\[/ROLE\]", re.S)
SEGMENTS = "conv_id long, place long, n_turns long, whole boolean, formatted string, spans array<struct<start:int,end:int>>"
PLACES = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def default_template() -> Template:
    return compile_template(TEMPLATE, {"bos": BOS, "eos": EOS}, CONTROLS)


def stretches(rows: DataFrame) -> DataFrame:
    """Of conversations with several stretches: conv_id, stretch, the place it begins at, and whether it is the last."""
    counts = rows.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    several = counts.groupBy("conv_id").agg(F.count("*").alias("stretches")).where("stretches > 1").select(F.col("conv_id").alias("several"))
    counts = counts.join(several, F.col("conv_id").eqNullSafe(F.col("several")), "left_semi")
    order = Window.partitionBy("conv_id").orderBy(F.col("stretch").asc_nulls_last())
    begin = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select("conv_id", "stretch", begin.cast("long").alias("begin"), F.lead("n").over(order).isNull().alias("final"))


def _render(batches: Iterator[pa.RecordBatch], source: str, constants: dict, controls: tuple[str, ...], segment: int) -> Iterator[pa.RecordBatch]:
    template = compile_template(source, constants, controls)
    out, done = Output(), []
    current: tuple | None = None
    begin = place = n = 0
    several = final = False
    waiting: tuple[str, str] | None = None

    def turn(last: bool) -> None:
        nonlocal n, waiting
        template.turn(Turn(waiting[0], waiting[1], place + n == 0, last, place + n), out)
        n, waiting = n + 1, None

    def leave(end: bool) -> None:
        nonlocal out, place, n
        if end:
            template.after(None, out)
        done.append((current[0], place, n, end and not several and place == 0, "".join(out.pieces), [{"start": a, "end": z} for a, z in out.spans]))
        out, place, n = Output(), place + n, 0

    def close() -> None:
        if waiting is not None:
            turn(not several or final)
            leave(not several or final)

    def packed() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True))
        done.clear()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(PLACES))
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv_id", "place", "n_turns", "whole", "formatted", "spans"])

    held = 0
    for b in batches:
        for conv, stretch, start, is_final, role, text in zip(*(b.column(c) for c in ("conv_id", "stretch", "begin", "final", "role", "text")), strict=True):
            start, key = start.as_py(), (conv.as_py(), stretch.as_py())
            if key != current:
                close()
                current, place, n, several, final, out = key, 0, 0, False, False, Output()
                if start is not None:
                    several, final, place = True, is_final.as_py(), start
                if place == 0:
                    template.before(None, out)
            if start is not None:  # says where the stretch begins; is no turn
                continue
            if waiting is not None:
                turn(False)
                if out.size >= segment:
                    held += out.size
                    leave(False)
            waiting = (role.as_py() or "", text.as_py() or "")
            if len(done) >= 2000 or held >= 4 * segment:
                held = 0
                yield packed()
    close()
    if done:
        yield packed()


def render(turns: DataFrame, source: str = TEMPLATE, constants: dict | None = None, controls: tuple[str, ...] = CONTROLS, turns_a_stretch: int = TURNS, segment: int = SEGMENT) -> DataFrame:
    """The formatted conversations of (conv_id, turn, role, text), as segments."""
    constants = {"bos": BOS, "eos": EOS} if constants is None else constants
    compile_template(source, constants, controls)  # errors of the template are the driver's
    kept = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    kept = kept.withColumn("stretch", F.floor(F.col("turn") / turns_a_stretch))
    rows = kept.select("conv_id", "stretch", F.lit(None).cast("long").alias("begin"), F.lit(None).cast("boolean").alias("final"), "turn", "role", "text")
    null = lambda t: F.lit(None).cast(t)
    rows = rows.unionByName(stretches(kept.select("conv_id", "stretch")).select("*", null("long").alias("turn"), null("string").alias("role"), null("string").alias("text")))
    order = ["conv_id", "stretch", F.col("begin").asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ("turn", "role", "text"))]
    rows = rows.repartition("conv_id", "stretch").sortWithinPartitions(*order)
    return rows.mapInArrow(lambda it: tidied(_render(it, source, constants, controls, segment)), SEGMENTS)


def turns_of(formatted: str, undo) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a text that TEMPLATE has made."""
    for m in WRITTEN.finditer(formatted):
        kind = m.lastgroup
        yield (undo(m.group("role")), undo(m.group("other"))) if kind == "other" else (kind, undo(m.group(kind)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    undo = escaper(CONTROLS)[1]
    names = ("conv_id", "place", "n_turns", "turns", "turns_sha256", "loss", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for b in batches:
        rows = []
        for conv, place, whole, formatted, spans in zip(*(b.column(c) for c in ("conv_id", "place", "whole", "formatted", "spans")), strict=True):
            formatted = formatted.as_py()
            found = list(turns_of(formatted, undo))
            said = "".join(f"{role}\n{text}\n" for role, text in found)
            loss = "".join(undo(formatted[s["start"] : s["end"]]) for s in spans.as_py())
            if whole.as_py():
                rows.append((conv.as_py(), place.as_py(), len(found), None, sha(said), None, len(loss), sha(loss), len(formatted)))
            else:
                rows.append((conv.as_py(), place.as_py(), len(found), said, None, loss, len(loss), None, len(formatted)))
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


READ = "conv_id long, place long, n_turns long, turns string, turns_sha256 string, loss string, loss_chars long, loss_sha256 string, formatted_chars long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """What each segment that TEMPLATE has made holds: its turns and what is to be learnt (whole conversations: hashed)."""
    return segments.select("conv_id", "place", "whole", "formatted", "spans").mapInArrow(lambda it: tidied(_read(it)), READ)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order: hashes of a conversation go on from segment to segment."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    done: list[tuple] = []
    conv, state = None, None

    def close() -> None:
        if state is not None:
            done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    pack = lambda: pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
    for b in batches:
        for r in zip(*(b.column(c) for c in READ.replace(" long", "").replace(" string", "").split(", ")), strict=True):
            c, _, n, turns, turns_sha, loss, loss_n, loss_sha, size = (x.as_py() for x in r)
            if turns is None:
                close()
                state = None
                done.append((c, n, turns_sha, loss_n, loss_sha, size))
                continue
            if state is None or c != conv:
                close()
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1].update(turns.encode())
            state[3].update(loss.encode())
            state[0], state[2], state[4] = state[0] + n, state[2] + loss_n, state[4] + size
        if len(done) >= 2000:
            yield pack()
            done.clear()
    close()
    if done:
        yield pack()


def digests(segments: DataFrame) -> DataFrame:
    rows = read_back(segments).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(lambda it: tidied(_join(it)), DIGESTS)


def with_probe(turns: DataFrame) -> DataFrame:
    """`turns` and conversation -1, whose texts are control strings."""
    probe = turns.sparkSession.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
