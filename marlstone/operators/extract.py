"""From pages to tables of elements, labelled images and links.

Only tokenising is Python: `explode_nodes` reads each page once and gives a row for every element, and `page_texts` one for
every text. All that follows is DataFrame code over their intervals: which control is nearest around an image, what a
screen reader announces, which element owns a map or a sprite, roles, classes, the first reason for which an image is
left out, and repeats on a page. page_ids are unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import html as H
from marlstone.functions import url as U
from marlstone.functions.columns import collapse, filled
from marlstone.plans.schemas import FIELDS, IMPLEMENTATIONS
from marlstone.sources.scratch import keep

NODES = (
    "page_id long, page_url string, pos int, parent int, tag string, attrs map<string,string>, start int, open_end int, end int, "
    "parent_start int, parent_end int, svg int, outer string, text string"
)
_INT, _TEXT = pa.int32(), pa.string()
ARROW_NODES = [
    ("page_id", pa.int64()), ("page_url", _TEXT), ("pos", _INT), ("parent", _INT), ("tag", _TEXT), ("attrs", pa.map_(_TEXT, _TEXT)), ("start", _INT), ("open_end", _INT), ("end", _INT),
    ("parent_start", _INT), ("parent_end", _INT), ("svg", _INT), ("outer", _TEXT), ("text", _TEXT),
]
#: Tags whose own markup later steps need: graphics, and what can be a control.
KEPT = frozenset(("svg", "symbol", "g", "defs", "path", "use", "a", "button", "summary", "input", "area"))
#: The tag of rows that are texts, and rows of a batch.
TEXT, ROWS = "#text", 20_000
SKIPS = ("noControl", "noName", "noImage", "spriteMissing", "duplicateOnPage")
SVG_NS, XLINK_NS = "http://www.w3.org/2000/svg", "http://www.w3.org/1999/xlink"
#: UTF-16 units of the text around an image that are kept.
AROUND = 240
#: Images whose texts a task puts together.
IMAGES = 20_000


def _page(doc: str, tags: frozenset | None, texts: bool) -> list[tuple]:
    """The columns of ARROW_NODES behind page_url, row by row."""
    o = H.outline(doc)
    out: list[tuple] = []
    for k, tag in enumerate(o.tag):
        if tags is not None and tag not in tags:
            continue
        up, attrs = o.parent[k], o.attrs[k]
        whole = tag in KEPT or "role" in attrs or o.svg[k] is not None and "id" in attrs
        place = (-1, len(doc)) if up < 0 else (o.start[up], o.end[up])
        out.append((k, up, tag, list(attrs.items()), o.start[k], o.open_end[k], o.end[k], *place, o.svg[k], doc[o.start[k] : o.end[k]] if whole else None, None))
    if texts:
        out += [(None, up, TEXT, None, a, a, z, None, None, None, None, value) for a, z, value, up in o.texts]
    return out


def explode_nodes(pages: DataFrame, tags: list[str] | None = None, texts: bool = False) -> DataFrame:
    """(page_id, url, html) -> a row of NODES for every element, or for those of `tags`; and for every text, if wanted."""
    only = frozenset(tags) if tags else None
    schema = pa.schema(ARROW_NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, rows = [], [], []

            def packed() -> pa.RecordBatch:
                columns = [ids, urls, *map(list, zip(*rows, strict=True))]
                return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

            for page_id, url, doc in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                page, place, found = page_id.as_py(), url.as_py(), _page(doc.as_py() or "", only, texts)
                for k in range(0, len(found), ROWS):
                    rows += found[k : k + ROWS]
                    ids += [page] * (len(rows) - len(ids))
                    urls += [place] * (len(rows) - len(urls))
                    if len(rows) >= ROWS:
                        yield packed()
                        ids, urls, rows = [], [], []
            if rows:
                yield packed()

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), "html").mapInArrow(run, NODES)


def nearest(nodes: DataFrame, asking: Column, around: Column, name: str, carried: list[str] | None = None, value: Column | None = None) -> DataFrame:
    """page_id, pos, start, tag and `carried` of the `asking` rows, and `name`: pos (or another `value` that isn't null) of the
    nearest element `around` each, or null.

    Intervals of a page lie inside each other or apart. A sweep over where they begin and end counts how many are open
    (the level); of those that opened at the level of a row, the last one is the nearest around it. Both steps are
    windows over a page in order, so no pair is made that is not an answer.
    """
    text = F.col("tag") == TEXT
    at = lambda when, place, side, step: F.when(when, F.struct(place.alias("at"), side.alias("side"), F.lit(step).alias("step")))
    # At one place, what ends there comes first; an element asks before it opens, a text after all that open there.
    events = F.array(at(around, F.col("end"), F.lit(0), -1), at(asking, F.col("start"), F.when(text, 3).otherwise(1), 0), at(around, F.col("start"), F.lit(2), 1))
    kept, carried = ["page_id", "pos", "start", "tag"], carried or []
    given = F.col("pos") if value is None else value
    rows = nodes.where(F.coalesce(asking, F.lit(False)) | F.coalesce(around, F.lit(False))).select(*kept, *carried, given.alias("_value"), F.explode(events).alias("e")).where("e is not null")
    # Only rows that ask come out, so only they carry what is wide through the sorts.
    rows = rows.withColumns({c: F.when(F.col("e.side").isin(1, 3), F.col(c)) for c in carried})
    sofar = Window.orderBy("e.at", "e.side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("level", F.sum("e.step").over(sofar.partitionBy("page_id"))).where("e.side > 0")
    found = F.last(F.when(F.col("e.side") == 2, F.col("_value")), ignorenulls=True).over(sofar.partitionBy("page_id", "level"))
    return rows.withColumn(name, F.when(F.col("level") > 0, found)).where("e.side != 2").drop("e", "level", "_value")


def is_image() -> Column:
    """Pictures: an svg counts if no other is around it."""
    kind = F.lower(F.trim(F.coalesce(F.col("attrs")["type"], F.lit(""))))
    return F.col("tag").isin("img", "area") | ((F.col("tag") == "svg") & F.col("svg").isNull()) | ((F.col("tag") == "input") & (kind == "image"))


def control_role() -> Column:
    return F.lower(F.trim(F.coalesce(F.col("attrs")["role"], F.lit(""))))


def is_control() -> Column:
    """Elements that can be activated, and so give an image inside a purpose."""
    leads = (F.col("tag") == "a") & (collapse(F.coalesce(F.col("attrs")["href"], F.lit(""))) != "")
    return leads | F.col("tag").isin("button", "summary") | control_role().isin(*H.ROLES)


def is_hidden() -> Column:
    """Elements whose texts a screen reader does not read as part of what is around them."""
    return F.col("tag").isin("script", "style", "title", "svg") | F.coalesce(F.col("attrs")["aria-hidden"] == "true", F.lit(False))


def flagged(nodes: DataFrame) -> DataFrame:
    """`nodes` with columns for what many steps ask of them: image, control, hidden, and id."""
    if "image" in nodes.columns:
        return nodes
    return nodes.withColumns({"image": is_image(), "control": F.coalesce(is_control(), F.lit(False)), "hidden": is_hidden(), "id": F.col("attrs")["id"]})


def _images(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Every image of flagged nodes: page_id, pos, start, tag, `carried`, and the pos of its control or null."""
    own = F.col("tag").isin("input", "area")
    ends = F.col("tag").isin("main", "body")
    # What ends the search is a find of -1: no control.
    rows = nearest(nodes, F.col("image") & ~own, F.col("control") | ends, "found", carried, F.when(F.col("control"), F.col("pos")).otherwise(-1))
    rows = rows.withColumn("found", F.when(F.col("found") >= 0, F.col("found")))
    rows = rows.unionByName(nodes.where(F.col("image") & own).select("page_id", "pos", "start", "tag", *carried, F.col("pos").alias("found")))
    return rows.withColumnRenamed("found", "control_pos")


def controls(nodes: DataFrame) -> DataFrame:
    """(page_id, pos, control) of every image: the nearest control around it, unless a block of content is nearer; inputs and areas are their own."""
    return _images(flagged(nodes), []).where("control_pos is not null").select("page_id", "pos", F.col("control_pos").alias("control"))


def clip(text: Column, units: int = AROUND) -> Column:
    """The first `units` UTF-16 code units; half of a pair is left out."""
    few = F.substring(text, 1, units)
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))

    def add(s: Column, c: Column) -> Column:
        n = s["n"] + F.when(F.ascii(c) > 0xFFFF, 2).otherwise(1)
        return F.struct(n.alias("n"), F.when(n <= units, F.concat(s["out"], c)).otherwise(s["out"]).alias("out"))

    return F.when(few.rlike(r"[\x{10000}-\x{10FFFF}]"), F.aggregate(F.filter(F.split(few, ""), lambda c: c != ""), start, add, lambda s: s["out"])).otherwise(few)


def heard(nodes: DataFrame, asked: DataFrame, texts: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """`asked` (page_id, key, context, a, b, s, e) with `text`: the collapsed text from a to b, without that from s to e.
    `texts` (page_id, context, start, end, text) are those of the nodes, where they are found already. Few bytes are much
    work here, so the number of `tasks` can be given.

    Each text belongs to the nearest hidden element around it (its context, null outside of all), and is read by those
    who ask from there. Texts and questions of one context of a page meet in one row, so no text is copied for a question.
    """
    if texts is None:
        texts = nearest(nodes, F.col("tag") == TEXT, is_hidden(), "context", ["text", "end"])
    dealt = lambda df: df.repartition(tasks, "page_id", "context") if tasks else df
    texts = dealt(texts.withColumn("context", F.coalesce("context", F.lit(-1)))).groupBy("page_id", "context").agg(F.sort_array(F.collect_list(F.struct("start", "end", "text"))).alias("texts"))
    asked = dealt(asked.withColumn("context", F.coalesce("context", F.lit(-1))))
    asked = asked.groupBy("page_id", "context").agg(F.collect_list(F.struct("key", "a", "b", "s", "e")).alias("asked"))

    def answer(q: Column) -> Column:
        inside = F.filter("texts", lambda t: (t["start"] >= q["a"]) & (t["start"] < q["b"]) & ((t["start"] < q["s"]) | (t["start"] >= q["e"])))
        return F.struct(q["key"].alias("key"), collapse(F.array_join(F.transform(inside, lambda t: t["text"]), "")).alias("text"))

    both = asked.join(texts, ["page_id", "context"])
    return both.select("page_id", F.explode(F.transform("asked", answer)).alias("q")).select("page_id", "q.key", "q.text")


def announced(nodes: DataFrame) -> DataFrame:
    """Every image that has a control: page_id, pos, what the control is, its name and where that comes from, alt text and text around."""
    return described(flagged(nodes)).where("control is not null").select(*_DESCRIBED)


#: What an image has by its control.
_DESCRIBED = ("page_id", "pos", "control", "control_tag", "control_role", "control_href", "name", "name_source", "around", "alt", "control_html")
#: What of an image's own later steps need.
_OWN = ["page_url", "attrs", "svg", "end", "outer"]


def described(nodes: DataFrame, around: bool = True) -> DataFrame:
    """Every image of flagged nodes with its own columns and those of `announced`, null where it has no control.

    The text around a control costs more than all names: who doesn't read it leaves `around` out, and gets nulls there.
    """
    part = lambda c, *names: [F.col(n).alias(f"{c}_{n}") for n in names]
    # Contexts, of texts and of what is asked from, in one sweep. An element that is hidden is one itself, for what is in
    # it; its parent's is the nearest around it.
    text, marks = F.col("tag") == TEXT, F.col("id").isNotNull() | F.col("control") | F.col("tag").isin("input", "area")
    swept = keep(nearest(nodes, text | marks, F.col("hidden"), "outer_context", ["parent", "attrs", "end", "parent_start", "parent_end", "outer", "hidden", "id", "text"]), "contexts")
    marked = swept.where(~text).withColumn("context", F.when(F.col("hidden"), F.col("pos")).otherwise(F.col("outer_context")))
    control = marked.select("page_id", *part("control", "pos", "tag", "attrs", "start", "end", "parent_start", "parent_end", "outer", "context", "outer_context"))
    rows = _images(nodes, _OWN).join(control, ["page_id", "control_pos"], "left")
    title = nodes.where((F.col("tag") == "title") & F.col("svg").isNotNull()).select("page_id", F.col("pos").alias("parent"), "svg")
    # A title is hidden itself, so what stands right in it has it as its context.
    title = swept.where(text & (F.col("parent") == F.col("outer_context"))).select("page_id", "parent", "start", "text").join(title, ["page_id", "parent"])
    title = title.groupBy("page_id", "svg", "parent").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("t")).groupBy("page_id", F.col("svg").alias("pos")).agg(F.min_by("t", "parent").alias("t"))
    rows = rows.join(title.withColumn("svg_title", collapse(F.array_join(F.transform("t", lambda x: x["text"]), ""))).drop("t"), ["page_id", "pos"], "left")
    rows = keep(rows, "described")  # asked for several times
    asking = rows.where("control_pos is not null")
    # What is asked of the page's texts: inside the control but for the image, around the control, and labels by id.
    ask = lambda kind, context, a, b, s, e, n=0: F.struct(F.struct("pos", F.lit(kind).alias("kind"), F.lit(n).alias("n")).alias("key"), F.col(context).alias("context"), F.col(a).alias("a"), F.col(b).alias("b"), F.col(s).alias("s"), F.col(e).alias("e"))
    asks = [F.when(F.col("pos") != F.col("control_pos"), ask("in", "control_context", "control_start", "control_end", "start", "end"))]
    if around:
        asks.append(ask("by", "control_outer_context", "control_parent_start", "control_parent_end", "control_start", "control_end"))
    asked = asking.select("page_id", F.explode(F.array(*asks)).alias("q")).where("q is not null").select("page_id", "q.*")
    refs = asking.select("page_id", "pos", F.posexplode(F.split(collapse(F.col("control_attrs")["aria-labelledby"]), " ")).alias("n", "id")).where("id != ''")
    named = marked.where("id is not null").groupBy("page_id", "id").agg(F.min_by(F.struct("context", F.col("start").alias("a"), F.col("end").alias("b")), "pos").alias("to"))
    refs = refs.join(named, ["page_id", "id"]).select("page_id", F.struct("pos", F.lit("label").alias("kind"), "n").alias("key"), "to.*", F.lit(0).alias("s"), F.lit(0).alias("e"))
    texts = swept.where(text).select("page_id", F.col("outer_context").alias("context"), "start", "end", "text")
    told = heard(nodes, asked.unionByName(refs), texts, rows.count() // IMAGES + 1).groupBy("page_id", F.col("key.pos").alias("pos")).agg(
        F.max(F.when(F.col("key.kind") == "in", F.col("text"))).alias("inside"),
        F.max(F.when(F.col("key.kind") == "by", F.col("text"))).alias("beside"),
        F.array_sort(F.collect_list(F.when(F.col("key.kind") == "label", F.struct("key.n", "text")))).alias("labels"),
    )
    rows = rows.join(told, ["page_id", "pos"], "left")
    own = F.col("pos") == F.col("control_pos")
    said = lambda c: collapse(F.coalesce(c, F.lit("")))
    label = said(F.array_join(F.transform("labels", lambda x: x["text"]), " "))
    inside = F.when(own, "").otherwise(F.coalesce("inside", F.lit("")))
    svg = F.col("tag") == "svg"
    drawn = F.when(F.coalesce(F.col("attrs")["aria-hidden"] == "true", F.lit(False)), "").otherwise(F.coalesce("svg_title", F.lit("")))
    mark, control_mark = said(F.col("attrs")["aria-label"]), said(F.col("control_attrs")["aria-label"])
    shown = F.when(svg, drawn).otherwise(said(F.col("attrs")["alt"]))
    ways = [(label, F.lit("aria-labelledby")), (control_mark, F.lit("aria-label")), (inside, F.lit("control-text")), (mark, F.lit("aria-label")), (shown, F.when(svg, "svg-title").otherwise("alt")), (said(F.col("control_attrs")["title"]), F.lit("title")), (said(F.col("attrs")["title"]), F.lit("title"))]
    first = F.get(F.filter(F.array(*(F.struct(t.alias("name"), s.alias("source")) for t, s in ways)), lambda x: x["name"] != ""), F.lit(0))
    alt = F.when(svg, F.nullif(F.coalesce(F.nullif(mark, F.lit("")), drawn), F.lit(""))).when(F.map_contains_key("attrs", "alt"), said(F.col("attrs")["alt"]))
    has = lambda c: F.when(F.col("control_pos").isNotNull(), c)
    return rows.select(
        "page_id", "pos", "tag", *_OWN, F.col("control_pos").alias("control"), "control_tag", has(F.lower(F.trim(F.coalesce(F.col("control_attrs")["role"], F.lit(""))))).alias("control_role"), F.col("control_attrs")["href"].alias("control_href"),
        has(F.coalesce(first["name"], F.lit(""))).alias("name"), has(F.coalesce(first["source"], F.lit(""))).alias("name_source"), (has(clip(F.when(inside != "", inside).otherwise(F.coalesce("beside", F.lit(""))))) if around else F.lit(None).cast("string")).alias("around"), has(alt).alias("alt"), F.col("control_outer").alias("control_html"),
    )


def role_of(tag: Column, role: Column) -> Column:
    roles = F.create_map(*(F.lit(x) for pair in H.ROLES.items() for x in pair))
    return F.when(tag == "a", "link").when(tag.isin("button", "summary"), "button").when(tag == "input", "input-image").when(tag == "area", "area").otherwise(F.coalesce(F.try_element_at(roles, role), F.lit("custom")))


def classify(tag: Column, target: Column) -> Column:
    """(category, subtype) from the control's tag and where it leads; a link to the root of any site is a logo's."""
    host = F.regexp_extract(target, r"^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract(target, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(target, r"^[^#?]*(\?[^#]+)", 1)
    root = target.isNotNull() & (host != "") & path.isin("", "/") & (query == "")
    pair = lambda c, s: F.struct(F.lit(c).alias("category"), F.lit(s).alias("subtype"))
    return (
        F.when(tag == "input", pair(2, "form-control-or-image-button"))
        .when(tag == "area", pair(4, "linked-complex-graphic-or-image-map"))
        .when((tag == "a") & root, pair(1, "linked-standalone-logo"))
        .when(tag == "a", pair(1, "standalone-navigational-link"))
        .otherwise(pair(2, "action-or-toggle-icon"))
    )


def map_owners(nodes: DataFrame) -> DataFrame:
    """(page_id, map_name, owner): the first image or object of a page that uses the map."""
    uses = F.regexp_replace(F.col("attrs")["usemap"], "^#", "")
    users = nodes.where(F.col("tag").isin("img", "object") & F.col("attrs")["usemap"].isNotNull())
    return users.groupBy("page_id", uses.alias("map_name")).agg(F.min_by("attrs", "pos").alias("owner"))


def coord_space(owner: Column) -> Column:
    w, h = F.trim(owner["width"]), F.trim(owner["height"])
    good = w.rlike(r"^\d+$") & h.rlike(r"^\d+$") & ~w.rlike("^0+$") & ~h.rlike("^0+$")
    return F.when(good, F.concat(w, F.lit("x"), h))


def sprites(nodes: DataFrame) -> DataFrame:
    """For each outer svg: (page_id, pos, standalone): a document of its own, or null where it can't be made.

    Every `use` must point into the page, at an element that paints; the symbols come in a <defs> block, each once.
    """
    svg = nodes.where((F.col("tag") == "svg") & F.col("svg").isNull()).select("page_id", "pos", "outer")
    ref = F.trim(F.coalesce(F.col("attrs")["href"], F.col("attrs")["xlink:href"], F.lit("")))
    uses = nodes.where(F.col("tag") == "use").select("page_id", F.col("svg").alias("svg_pos"), F.col("pos").alias("use_pos"), F.when(ref.rlike("^#."), F.substring(ref, 2, F.length(ref))).alias("target"))
    uses = uses.where("svg_pos is not null")
    marked = nodes.where(F.col("attrs")["id"].isNotNull()).groupBy("page_id", F.col("attrs")["id"].alias("target")).agg(F.min_by(F.struct("outer", F.col("attrs")["viewbox"].alias("view")), "pos").alias("t"))
    found = uses.join(marked, ["page_id", "target"], "left")
    paints = F.coalesce(F.col("t.outer").rlike(H.PAINTS.pattern.replace("<", "(?i)<", 1)), F.lit(False))
    parts = found.groupBy("page_id", "svg_pos").agg(
        F.bool_and(paints).alias("ok"),
        F.array_sort(F.collect_list(F.struct("use_pos", F.col("t.outer").alias("outer"), F.col("t.view").alias("view")))).alias("parts"),
    )
    parts = parts.withColumn("defs", F.array_join(F.array_distinct(F.transform("parts", lambda p: p["outer"])), "")).withColumn("view", F.get(F.filter(F.transform("parts", lambda p: p["view"]), lambda v: v.isNotNull()), F.lit(0)))
    j = svg.join(parts, (svg["page_id"] == parts["page_id"]) & (svg["pos"] == parts["svg_pos"]), "left").select(svg["page_id"], svg["pos"], svg["outer"], "ok", "defs", "view")
    at = F.instr("outer", ">")
    open_, rest = F.substring("outer", 1, at - 1), F.substring("outer", at, F.length("outer"))
    whole = F.col("outer").rlike(r"(?i)^<svg[\s/>]") & (at > 0) & (F.length("outer") - F.instr(F.reverse("outer"), ">gvs/<") - 5 >= at) & F.contains("outer", F.lit("</svg>"))
    own = F.col("outer").rlike(H.PAINTS.pattern.replace("<", "(?i)<", 1))
    body = F.when(F.col("ok"), F.concat(F.lit(">"), F.lit("<defs>"), "defs", F.lit("</defs>"), F.substring(rest, 2, F.length("outer")))).when(F.col("ok").isNull() & own, rest)
    has = lambda name: open_.rlike(rf"(?i)\s{name}\s*=")
    add = F.concat(
        F.when(~has("xmlns"), f' xmlns="{SVG_NS}"').otherwise(""),
        F.when(F.concat(open_, body).rlike("(?i)xlink:") & ~has("xmlns:xlink"), f' xmlns:xlink="{XLINK_NS}"').otherwise(""),
        F.when(~has("viewBox") & (F.trim(F.coalesce("view", F.lit(""))) != ""), F.concat(F.lit(' viewBox="'), F.trim("view"), F.lit('"'))).otherwise(""),
    )
    return j.select("page_id", "pos", F.when(whole & body.isNotNull(), F.concat(open_, add, body)).alias("standalone"))


def judged(pages: DataFrame, sector: Column, retrieved: str, around: bool = True, tags: tuple[str, ...] | None = None) -> DataFrame:
    """Every image of the pages, or every one of `tags`: the columns of an item, page_id, pos, and `skip_reason` (null for a candidate).

    Without `around` there is no surrounding_text. An svg repeats svgs only, as it has no address: it is judged alike without the other tags.
    """
    # Parsed once: what images, controls, maps, sprites and names need is written out, texts included.
    needed = F.col("image") | F.col("control") | F.col("hidden") | F.col("tag").isin("input", "main", "body", "map", "use", TEXT) | F.col("attrs")["usemap"].isNotNull() | F.col("id").isNotNull()
    # Pages are dealt first: a file of few row groups would be parsed by as few tasks.
    dealt = pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page_id")
    nodes = flagged(explode_nodes(dealt, texts=True))
    nodes = keep((nodes.withColumn("image", F.col("image") & F.col("tag").isin(*tags)) if tags else nodes).where(needed), "nodes")
    images = described(nodes, around)
    in_map = nearest(nodes, F.col("tag") == "area", F.col("tag") == "map", "map_pos").select("page_id", "pos", "map_pos")
    maps = nodes.where("tag = 'map'").select("page_id", F.col("pos").alias("map_pos"), F.coalesce(F.col("attrs")["name"], F.col("attrs")["id"]).alias("map_name"))
    images = images.join(in_map, ["page_id", "pos"], "left").join(maps, ["page_id", "map_pos"], "left").join(map_owners(nodes), ["page_id", "map_name"], "left")
    images = images.join(sprites(nodes), ["page_id", "pos"], "left")
    src, srcset = F.col("attrs")["src"], F.col("attrs")["srcset"]
    first = F.split(F.trim(F.split_part(srcset, F.lit(","), F.lit(1))), r"\s+")[0]
    raw = F.when(F.col("tag") == "area", F.col("owner")["src"]).when(F.trim(F.coalesce(src, F.lit(""))) != "", src).when(F.trim(F.coalesce(srcset, F.lit(""))) != "", first)
    images = images.withColumn("image_url", F.when(F.col("tag") != "svg", U.absolute_col(raw, F.col("page_url"))))
    images = images.withColumn("target", U.absolute_col(F.col("control_href"), F.col("page_url"))).withColumn("role", role_of(F.col("control_tag"), F.col("control_role"))).withColumn("domain", U.domain_col(F.col("page_url")))
    reason = (
        F.when(F.col("control").isNull(), "noControl")
        .when(F.col("name") == "", "noName")
        .when(F.col("image_url").isNull() & (F.col("tag") != "svg"), "noImage")
        .when((F.col("tag") == "svg") & F.col("standalone").isNull(), "spriteMissing")
    )
    images = images.withColumn("skip_reason", reason)
    key = Window.partitionBy("page_id", F.col("skip_reason").isNull(), F.coalesce("image_url", "outer"), "role", "name").orderBy("pos")
    images = images.withColumn("nth", F.row_number().over(key)).withColumn("skip_reason", F.when(F.col("skip_reason").isNull() & (F.col("nth") > 1), "duplicateOnPage").otherwise(F.col("skip_reason")))
    kind = F.create_map(*(F.lit(x) for pair in IMPLEMENTATIONS.items() for x in pair))
    none = F.lit(None).cast("string")
    c = classify(F.col("control_tag"), F.col("target"))
    made = {
        "id": none, "status": F.lit("unreviewed"), "page_url": F.col("page_url"), "domain": F.col("domain"), "sector": sector, "image_url": F.col("image_url"),
        "image_coord_space": F.when(F.col("tag") == "area", coord_space(F.col("owner"))), "image_svg": F.when(F.col("tag") == "svg", F.col("standalone")), "image_file": none, "image_sha256": none,
        "implementation": kind[F.col("tag")], "element_role": F.col("role"), "element_html": F.col("control_html"), "surrounding_text": F.coalesce("around", F.lit("")) if around else none, "observed_alt": F.col("alt"),
        "accessible_name": F.col("name"), "accessible_name_source": F.col("name_source"), "category": c["category"], "subtype": c["subtype"], "retrieved": F.lit(retrieved),
        "review_verdict": none, "review_reason": none, "alt_quality": none,
    }
    return images.where("domain is not null").select("page_id", "pos", "skip_reason", *(made[f].alias(f) for f in FIELDS))


def candidates(pages: DataFrame, sector: Column | None = None, retrieved: str = "1970-01-01", around: bool = True, tags: tuple[str, ...] | None = None) -> DataFrame:
    """The items of the pages, by page_id and pos; `around` and `tags` as in `judged`."""
    return judged(pages, F.lit("webapp") if sector is None else sector, retrieved, around, tags).where("skip_reason is null").drop("skip_reason")


def skips(images: DataFrame) -> DataFrame:
    """(skip_reason, n) of `judged` images, zero where a reason never came."""
    all_ = images.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, SKIPS))).alias("skip_reason"))
    return all_.join(images.where("skip_reason is not null").groupBy("skip_reason").count(), "skip_reason", "left").select("skip_reason", F.coalesce("count", F.lit(0)).alias("n"))


def outbound_links(pages: DataFrame) -> DataFrame:
    """(page_id, page_url, pos, href, link): same-host page links, the first of each target, in document order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, u, k, href) for i, u, doc in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True) for k, href in H.anchors(doc or "")]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.string())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "page_url", "pos", "href"])

    nodes = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, page_url string, pos int, href string")
    links = nodes.where(filled(F.col("href"))).withColumn("link", U.without_hash(U.absolute_col("href", "page_url"))).withColumn("here", U.absolute_col("page_url", "page_url"))
    links = links.where(F.col("link").rlike("^https?://") & (U.plain_host(F.col("link")) == U.plain_host(F.col("here"))) & ~U.is_asset(U.plain_path(F.col("link"))) & (F.col("link") != F.col("here")))
    first = Window.partitionBy("page_id", "page_url", "link").orderBy("pos")
    return links.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("page_id", "page_url", "pos", "href", "link")
