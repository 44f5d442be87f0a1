"""Queries of rules: records, verdicts, coverage, selection, archives and sessions, over records made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import columns, media
from marlstone.operators import aggregates, archive, export, pool, region, review, session, validate
from marlstone.operators import select as selection
from marlstone.plans.registry import ORACLES, query, read
from marlstone.plans.schemas import FIELDS, SUBTYPES, Settings
from marlstone.sources import text

# Records that each break a rule: what is changed in a record without faults, and the problem that must come of it.

READY = {"status": "ready", "image_file": "pool/images/x.png", "image_sha256": "a" * 64, "review_verdict": "keep", "review_reason": "r", "alt_quality": "good"}
SVG = {"implementation": "inline-svg", "image_url": None, "image_svg": '<svg xmlns="x"/>'}
BREAKS: list[tuple[dict, str | None]] = [
    ({}, None),
    (READY, None),
    (SVG, None),
    ({"id": "fi-1"}, "id_form"),
    ({"status": "new", "review_verdict": "keep", "review_reason": "r", "alt_quality": "good"}, "status_value"),
    ({"page_url": "nothing"}, "page_url_web"),
    ({"domain": ""}, "domain_filled"),
    ({"domain": "www.a.org"}, "domain_is_host"),
    ({"sector": None}, "sector_filled"),
    ({"implementation": "font"}, "implementation_value"),
    ({"element_role": "x"}, "element_role_value"),
    ({"image_url": "ftp://x"}, "image_url_needed"),
    (SVG | {"image_url": "https://a/b"}, "image_url_unneeded"),
    (SVG | {"image_svg": None}, "image_svg_needed"),
    (SVG | {"image_svg": "<svg>"}, "image_svg_document"),
    ({"image_svg": "<svg xmlns=1>"}, "image_svg_unneeded"),
    ({"-": "image_svg"}, "image_svg_unneeded"),
    ({"element_role": "area", "image_coord_space": "010x2"}, "coord_space_form"),
    ({"-": "image_coord_space"}, "coord_space_form"),
    ({"image_coord_space": "1x2"}, "coord_space_area"),
    ({"element_html": ""}, "element_html_filled"),
    ({"element_html": "a"}, "element_html_tag"),
    ({"surrounding_text": None}, "surrounding_text_string"),
    ({"-": "observed_alt"}, "observed_alt_present"),
    ({"accessible_name": ""}, "accessible_name_filled"),
    ({"accessible_name_source": "x"}, "name_source_value"),
    ({"subtype": "constructor"}, "subtype_value"),
    ({"category": "2"}, "category_of_subtype"),
    ({"retrieved": "2024-1-2"}, "retrieved_form"),
    (READY | {"image_file": None}, "ready_file"),
    (READY | {"image_sha256": "A" * 64}, "ready_sha256"),
    ({"image_file": ""}, "image_file_blank"),
    (READY | {"status": "dropped", "review_verdict": "no"}, "reviewed_verdict"),
    (READY | {"review_reason": ""}, "reviewed_reason"),
    (READY | {"status": "dropped", "alt_quality": "x"}, "reviewed_quality"),
    (READY | {"alt_quality": "weak"}, "ready_good"),
    (READY | {"review_verdict": "drop"}, "ready_keep"),
    ({"review_verdict": "keep"}, "unreviewed_review_verdict"),
    ({"review_reason": "x"}, "unreviewed_review_reason"),
    ({"alt_quality": "good"}, "unreviewed_alt_quality"),
]
PLAIN = {
    "status": "unreviewed", "page_url": "https://www.a.org/p", "domain": "a.org", "sector": "docs", "image_url": "https://a.org/i.png", "implementation": "img", "element_role": "link", "element_html": "<a href=x></a>",
    "surrounding_text": "", "observed_alt": "A", "accessible_name": "A", "accessible_name_source": "alt", "category": "1", "subtype": "linked-standalone-logo", "retrieved": "2024-01-02",
}


def faulty_records(orders: DataFrame) -> DataFrame:
    """An item for each order, with the fault that its key names."""
    kind = (F.col("o_orderkey") % len(BREAKS)).cast("int")

    def value(field: str) -> Column:
        plain = F.format_string("fi-%04d", "o_orderkey") if field == "id" else F.lit(PLAIN.get(field)).cast("string")
        changed = {k: over[field] for k, (over, _) in enumerate(BREAKS) if field in over}
        by_value: dict[str | None, list[int]] = {}
        for k, v in changed.items():
            by_value.setdefault(v, []).append(k)
        out = None
        for v, ks in by_value.items():
            out = F.when(kind.isin(*ks), F.lit(v).cast("string")) if out is None else out.when(kind.isin(*ks), F.lit(v).cast("string"))
        return plain if out is None else out.otherwise(plain)

    absent = F.element_at(F.array(*(F.lit(over.get("-")).cast("string") for over, _ in BREAKS)), kind + 1)
    keys = F.array_except(F.array(*(F.lit(f) for f in FIELDS)), F.array(F.coalesce(absent, F.lit(""))))
    return orders.select(*(value(f).cast("int" if f == "category" else "string").alias(f) for f in FIELDS), keys.alias("_keys"), F.col("o_orderkey").alias("pos"))


_BROKEN = ", ".join(f"({k}, '{problem}')" for k, (_, problem) in enumerate(BREAKS) if problem)


@query(f"""
WITH b(k, problem) AS (VALUES {_BROKEN})
SELECT o_orderkey AS line, problem FROM orders JOIN b ON o_orderkey % {len(BREAKS)} = k
UNION ALL SELECT o_orderkey + 1000000000, 'duplicate_id_of_line_' || o_orderkey FROM orders WHERE o_orderkey % {len(BREAKS)} = 0 AND o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'duplicate_id_of_line_' || first FROM (SELECT o_orderkey, min(o_orderkey) OVER () AS first FROM orders WHERE o_orderkey % {len(BREAKS)} = 3) WHERE o_orderkey > first
""")
def record_problems(spark, sf_dir):
    """Every rule of a record, and ids that repeat."""
    items = faulty_records(read(spark, sf_dir, "orders").select("o_orderkey"))
    again = items.where((F.col("pos") % len(BREAKS) == 0) & (F.col("pos") % 3 == 0)).withColumn("pos", F.col("pos") + 1_000_000_000)
    return validate.check(items.unionByName(again)).select("line", "problem")


@query(f"""
WITH b(k, problem) AS (VALUES {_BROKEN}), i AS (SELECT o_orderkey % {len(BREAKS)} AS k FROM orders)
SELECT (SELECT count(*) FROM orders JOIN b ON o_orderkey % {len(BREAKS)} = k) + (SELECT count(*) - 1 FROM i WHERE k = 3) AS problems, 250 AS goal, 63 AS sector_most, count(*) FILTER (WHERE k NOT IN ({", ".join(str(k) for k, (o, _) in enumerate(BREAKS) if "sector" in o)})) AS docs, 2 AS per_page FROM i
""")
def validation_report(spark, sf_dir):
    """The machine-readable report, taken apart again."""
    out = validate.report(faulty_records(read(spark, sf_dir, "orders").select("o_orderkey")))
    at = lambda path, kind: F.get_json_object("report", path).cast(kind)
    return out.select(at("$.problems", "long").alias("problems"), at("$.goal", "int").alias("goal"), at("$.caps.sectorMax", "int").alias("sector_most"), at("$.by.sector.docs", "long").alias("docs"), at("$.caps.perPage", "int").alias("per_page"))


_PLACES = """
WITH i AS (SELECT list_extract(['government', 'education', 'publishing', 'docs', 'commerce', 'other'], (CASE WHEN doc_id % 10 < 6 THEN 0 ELSE doc_id % 10 - 5 END + 1)::INT) AS sector, doc_id % 3 AS t, 'd' || doc_id % 40 AS domain, 'p' || doc_id // 3 AS page FROM documents)
"""


@query(_PLACES + """
, s(kind, value, n, bound) AS (
SELECT 'sector_short', v, count(i.sector), 20 FROM (VALUES ('government'), ('education'), ('publishing'), ('docs'), ('commerce'), ('news'), ('webapp')) k(v) LEFT JOIN i ON i.sector = v GROUP BY v HAVING count(i.sector) < 20
UNION ALL SELECT 'sector_unknown', sector, count(*), NULL FROM i WHERE sector = 'other' GROUP BY sector
UNION ALL SELECT 'sector_over', sector, count(*), 63 FROM i GROUP BY sector HAVING count(*) > 63
UNION ALL SELECT 'subtype_short', v, 0, 13 FROM (VALUES ('action-or-toggle-icon'), ('functional-non-unicode-emoji'), ('linked-complex-graphic-or-image-map'), ('structural-break-or-reader-control')) k(v)
UNION ALL SELECT 'domain_over', domain, count(*), 13 FROM i GROUP BY domain HAVING count(*) > 13
UNION ALL SELECT 'page_url_over', page, count(*), 2 FROM i GROUP BY page HAVING count(*) > 2)
SELECT kind, value, n::BIGINT AS n, bound::INT AS bound FROM s
""")
def coverage_bounds(spark, sf_dir):
    """Shortfalls and excesses of sectors, sub-types, domains and pages, in one scan."""
    d = F.col("doc_id")
    sectors, kinds = F.array(*(F.lit(x) for x in ("government", "education", "publishing", "docs", "commerce", "other"))), F.array(*(F.lit(x) for x in list(SUBTYPES)[:3]))
    rows = read(spark, sf_dir, "documents").select(
        F.element_at(sectors, (F.when(d % 10 < 6, 0).otherwise(d % 10 - 5) + 1).cast("int")).alias("sector"), F.element_at(kinds, (d % 3 + 1).cast("int")).alias("subtype"), F.concat(F.lit("d"), d % 40).alias("domain"), F.concat(F.lit("p"), F.floor(d / 3)).alias("page_url")
    )
    return validate.coverage(rows)


# Verdicts, one in twelve of each kind.

_VERDICT_CASES: list[tuple[dict, str | None]] = [
    ({}, None),
    ({"item_id": "  "}, "item_id_blank"),
    ({"item_id": "unknown"}, "not_in_corpus"),
    ({"status": "ready"}, "already_decided"),
    ({"verdict": "maybe"}, "verdict_value"),
    ({"alt_quality": "fine"}, "alt_quality_value"),
    ({"reason": "    too short    "}, "reason_short"),
    ({"subtype": "toString"}, "subtype_value"),
    ({"alt_quality": "weak"}, "keep_not_good"),
    ({"image_file": ""}, "keep_without_image"),
    ({"twice": "1"}, "repeated_in_batch"),
    ({"verdict": "drop", "alt_quality": "wrong", "subtype": "action-or-toggle-icon"}, None),
]


def _verdict_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    d = read(spark, sf_dir, "documents").select("doc_id")
    kind = F.col("doc_id") % len(_VERDICT_CASES)
    pick = lambda field, plain: F.coalesce(*(F.when(kind == k, F.lit(over[field]).cast("string")) for k, (over, _) in enumerate(_VERDICT_CASES) if field in over), F.lit(None).cast("string"), plain)
    own = F.col("doc_id").cast("string")
    v = d.select(pick("item_id", own).alias("item_id"), pick("verdict", F.lit("keep")).alias("verdict"), pick("alt_quality", F.lit("good")).alias("alt_quality"), pick("reason", F.lit("  twenty characters of a reason ")).alias("reason"), pick("subtype", F.lit(None).cast("string")).alias("subtype"), F.col("doc_id").alias("line"), pick("twice", F.lit("")).alias("twice"))
    v = v.drop("twice").unionByName(v.where("twice = '1'").drop("twice").withColumn("line", F.col("line") + 1_000_000_000))
    c = d.select(own.alias("id"), pick("status", F.lit("unreviewed")).alias("status"), pick("image_file", F.lit("f.png")).alias("image_file"), F.lit("linked-standalone-logo").alias("subtype"), F.lit(1).alias("category"), *(F.lit(None).cast("string").alias(x) for x in ("review_verdict", "review_reason", "alt_quality")), F.col("doc_id").alias("pos"))
    return v, c


@query(f"""
WITH b(k, problem) AS (VALUES {", ".join(f"({k}, '{p}')" for k, (_, p) in enumerate(_VERDICT_CASES) if p)})
SELECT CASE problem WHEN 'repeated_in_batch' THEN doc_id + 1000000000 ELSE doc_id END AS line, problem FROM documents JOIN b ON doc_id % {len(_VERDICT_CASES)} = k
UNION ALL SELECT doc_id, 'keep_not_good' FROM documents WHERE doc_id % {len(_VERDICT_CASES)} = 5
UNION ALL SELECT doc_id, 'repeated_in_batch' FROM documents WHERE doc_id % {len(_VERDICT_CASES)} = 2 AND doc_id > (SELECT min(doc_id) FROM documents WHERE doc_id % {len(_VERDICT_CASES)} = 2)
""")
def verdict_problems(spark, sf_dir):
    """Every rule of a verdict. Blank ids are none, so they can't repeat; an unknown one can."""
    v, c = _verdict_tables(spark, sf_dir)
    return review.check(v, c).select("line", "problem")


@query(f"""
SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 12 = 3 THEN 'ready' WHEN doc_id % 12 = 0 THEN 'ready' WHEN doc_id % 12 = 11 THEN 'dropped' ELSE 'unreviewed' END AS status,
  CASE doc_id % 12 WHEN 11 THEN 'action-or-toggle-icon' ELSE 'linked-standalone-logo' END AS subtype, CASE doc_id % 12 WHEN 11 THEN 2 ELSE 1 END AS category, true AS kept_before
FROM documents
""")
def apply_batches(spark, sf_dir):
    """All or nothing: a batch with faults leaves the corpus as it was; the good part of it is applied, sub-types corrected."""
    v, c = _verdict_tables(spark, sf_dir)
    refused, problems = review.apply(c, v)
    good = v.where(F.col("line") % len(_VERDICT_CASES) % 11 == 0)
    after, none = review.apply(c, good)
    same = refused.exceptAll(c).isEmpty() and c.exceptAll(refused).isEmpty() and not problems.isEmpty() and none.isEmpty()
    return after.select("id", "status", "subtype", "category", F.lit(same).alias("kept_before"))


@query("SELECT CASE doc_id % 12 WHEN 0 THEN 'ready' ELSE 'dropped' END AS status, count(*) AS n FROM documents WHERE doc_id % 12 IN (0, 11) GROUP BY 1")
def batch_counts(spark, sf_dir):
    v, c = _verdict_tables(spark, sf_dir)
    return review.counts(c, review.merge(c, v.where(F.col("line") % len(_VERDICT_CASES) % 11 == 0)))


# Selection: a recursive query takes one row a step, from the thinnest sector, then the thinnest sub-type.

_GREEDY = """
WITH RECURSIVE pool AS (SELECT doc_id AS pos, 'b' || doc_id % 97 AS page, 'b' || doc_id % 41 AS domain, source AS sector, lang AS subtype, md5(text) AS image FROM documents),
taken AS (SELECT * FROM pool WHERE {taken}),
open AS (SELECT pos, page, domain, coalesce(sector, '-') AS sector, coalesce(subtype, '-') AS subtype, coalesce(image, '-') AS image FROM pool WHERE pos NOT IN (SELECT pos FROM taken)),
s AS (
  SELECT 0 AS step, []::BIGINT[] AS seen, 0 AS n, (SELECT coalesce(list(page), []) FROM taken2) AS pages, (SELECT coalesce(list(domain), []) FROM taken2) AS domains, (SELECT coalesce(list(sector), []) FROM taken2) AS sectors,
    (SELECT coalesce(list(subtype), []) FROM taken2) AS subtypes, (SELECT coalesce(list(image), []) FROM taken2) AS images, NULL::BIGINT AS pos, NULL::VARCHAR AS outcome
  UNION ALL
  SELECT step + 1, list_append(seen, r.pos), n + (o = 'chosen')::INT, CASE o WHEN 'chosen' THEN list_append(pages, r.page) ELSE pages END, CASE o WHEN 'chosen' THEN list_append(domains, r.domain) ELSE domains END,
    CASE o WHEN 'chosen' THEN list_append(sectors, r.sector) ELSE sectors END, CASE o WHEN 'chosen' THEN list_append(subtypes, r.subtype) ELSE subtypes END, CASE o WHEN 'chosen' THEN list_append(images, r.image) ELSE images END, r.pos, o
  FROM (SELECT *, CASE WHEN {images} AND list_contains(images, r.image) THEN 'duplicateImage' WHEN len(list_filter(pages, lambda x: x = r.page)) >= 2 THEN 'pageCap'
    WHEN len(list_filter(domains, lambda x: x = r.domain)) >= {domain} THEN 'domainCap' ELSE 'chosen' END AS o
    FROM (SELECT any_value(s) AS t, arg_min(open, (len(list_filter(s.sectors, lambda x: x = open.sector)), len(list_filter(s.subtypes, lambda x: x = open.subtype)), open.pos)) AS r
          FROM s, open WHERE s.n < {add} AND NOT list_contains(s.seen, open.pos) GROUP BY s.step) q, LATERAL (SELECT unnest(q.t))) z)
SELECT pool.pos::VARCHAR AS id, CASE WHEN pool.pos IN (SELECT pos FROM taken) THEN 'alreadySelected' ELSE coalesce(outcome, 'remaining') END AS outcome, CASE outcome WHEN 'chosen' THEN n - 1 END::INT AS chosen_seq
FROM pool LEFT JOIN s ON pool.pos = s.pos
"""


def _small_pool(spark, sf_dir) -> DataFrame:
    bucket = lambda n: F.concat(F.lit("b"), F.pmod(F.col("doc_id"), F.lit(n)))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), bucket(97).alias("page_url"), bucket(41).alias("domain"), F.coalesce("source", F.lit("-")).alias("sector"), F.coalesce("lang", F.lit("-")).alias("subtype"), F.lit("f").alias("image_file"), F.coalesce(F.md5("text"), F.lit("-")).alias("image_sha256"), F.lit("link").alias("element_role"), F.col("doc_id").alias("pos"))


def _greedy(taken: str, also: str, images: bool, domain: int, add: int) -> str:
    sql = _GREEDY.replace("open AS", f"taken2 AS (SELECT page, domain, coalesce(sector, '-') AS sector, coalesce(subtype, '-') AS subtype, coalesce(image, '-') AS image FROM taken{also}),\nopen AS", 1)
    return sql.replace("{taken}", taken).replace("{images}", str(images).lower()).replace("{domain}", str(domain)).replace("{add}", str(add))


@query(_greedy("pos % 50 = 0", "", True, 13, 40))
def select_forty(spark, sf_dir):
    """The core of the selection: caps by page, domain and picture, thinnest sector and sub-type first."""
    p = _small_pool(spark, sf_dir)
    return selection.select(p, p.where("pos % 50 = 0"), selection.Caps(add=40, goal=250), head=4).select("id", "outcome", "chosen_seq")


@query(_greedy("pos < 30", " UNION ALL SELECT page, domain, coalesce(sector, '-'), coalesce(subtype, '-'), coalesce(image, '-') FROM pool WHERE pos >= 5 AND pos < 10", False, 38, 35))
def shortlist_sixty(spark, sf_dir):
    """Sixty are wanted, and 20 of the 25 listed are pending, five being in the corpus: rows in both tables count twice."""
    p = _small_pool(spark, sf_dir)
    return selection.shortlist(p, p.where("pos < 10"), p.where("pos >= 5 and pos < 30"), want=55).select("id", "outcome", "chosen_seq")


@query("SELECT outcome, count(*) AS n FROM (" + _greedy("pos % 50 = 0", "", True, 13, 40) + ") GROUP BY outcome")
def selection_summary(spark, sf_dir):
    p = _small_pool(spark, sf_dir)
    return selection.summary(selection.select(p, p.where("pos % 50 = 0"), selection.Caps(add=40, goal=250)))


@query("SELECT 0 AS chosen, 1 AS nothing, 2 AS refused")
def selection_states(spark, sf_dir):
    p = _small_pool(spark, sf_dir)
    one, none = (selection.select(p, p.limit(0), selection.Caps(add=n)) for n in (1, 0))
    return spark.createDataFrame([(selection.state(one), selection.state(none), selection.state(none, refused=True))], "chosen int, nothing int, refused int")


@query("SELECT p_partkey FROM part WHERE p_partkey % 4 IN (0, 2) AND p_partkey % 6 IN (0, 1, 2)")
def eligible_images(spark, sf_dir):
    k = F.col("p_partkey")
    items = read(spark, sf_dir, "part").select("p_partkey", F.when(k % 4 == 1, "").when(k % 4 != 3, "f.png").alias("image_file"), F.when(k % 6 < 3, "h").when(k % 6 == 3, "").alias("image_sha256"))
    return selection.with_images(items).select("p_partkey")


# Exports and archives.


def _archive_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    part = read(spark, sf_dir, "part").select("p_partkey")
    status = F.when(k % 4 == 0, "ready").when(k % 4 == 1, "dropped").otherwise("unreviewed")
    items = part.select(k.cast("string").alias("id"), status.alias("status"), F.when(k % 8 == 0, "good").otherwise("weak").alias("alt_quality"), F.when(k % 16 != 0, F.concat(F.lit("pool/images/"), k, F.lit(".png"))).alias("image_file"), F.concat(F.lit("p"), k % 7).alias("page_url"), k.alias("pos"))
    return items, part.where(k % 3 != 0).select(F.concat(k, F.lit(".png")).alias("name"))


@query("SELECT p_partkey::VARCHAR AS id FROM part WHERE p_partkey % 8 = 0 AND (p_partkey % 16 = 0 OR p_partkey % 3 = 0)")
def export_missing(spark, sf_dir):
    items, files = _archive_tables(spark, sf_dir)
    return export.missing(items, files).select("id")


@query("SELECT p_partkey::VARCHAR AS id, p_partkey || '.png' AS name FROM part WHERE p_partkey % 4 = 0 AND p_partkey % 16 <> 0 AND p_partkey % 3 = 0")
def stranded_items(spark, sf_dir):
    items, files = _archive_tables(spark, sf_dir)
    return archive.stranded(items, files)


@query("""
SELECT p_partkey || '.png' AS name, CASE WHEN p_partkey % 16 = 0 THEN CASE WHEN p_partkey % 5 = 0 THEN 'unselected' ELSE 'orphaned' END ELSE 'dropped' END AS reason
FROM part WHERE p_partkey % 3 <> 0 AND (p_partkey % 4 = 1 OR p_partkey % 16 = 0) AND p_partkey % 7 <> 0
""")
def removal_entries(spark, sf_dir):
    """What a cleanup would delete, as entries that the log does not have yet."""
    items, files = _archive_tables(spark, sf_dir)
    k = F.col("p_partkey")
    listed = read(spark, sf_dir, "part").where(k % 5 == 0).select(k.cast("string").alias("id"))
    log = read(spark, sf_dir, "part").where(k % 7 == 0).select(F.concat(k, F.lit(".png")).alias("name"), F.lit("dropped").alias("reason"))
    return archive.log_entries(archive.removals(archive.cleanup_plan(files, items, listed), drop_unselected=True), log)


@query("""
SELECT p_partkey::VARCHAR AS id FROM part WHERE p_partkey % 4 IN (0, 2, 3) AND p_partkey % 3 = 1 AND (p_partkey % 5 = 0 OR p_partkey % 2 = 0)
""")
def needing_archive(spark, sf_dir):
    k = F.col("p_partkey")
    status = F.when(k % 4 == 0, "ready").when(k % 4 == 1, "dropped").otherwise("unreviewed")
    items = read(spark, sf_dir, "part").select(k.cast("string").alias("id"), status.alias("status"), F.when(k % 3 == 0, "f").when(k % 3 == 1, "").otherwise("g").alias("image_file"), F.when(k % 5 == 0, "inline-svg").otherwise("img").alias("implementation"), F.when(k % 2 == 0, "https://x.org/i").otherwise("").alias("image_url"))
    return items.where(archive.needs_archive()).select("id")


#: Bytes by kind, as hexadecimal text, what a server calls them, and the end of the url.
_BYTES = [
    ("89504e470d0a1a0a00000000", "image/png", ".png"), ("ffd8ffe000104a46", None, ".bin"), ("474946383961", "image/gif; charset=x", ""), ("524946460000000057454250", "image/webp", ".webp"),
    ("3c7376672f3e", "image/svg+xml", ".svg"), ("3c68746d6c3e", "text/html", ".png"), ("", "image/png", ".png"), ("00000100", "image/x-icon", ".ico"),
]


def _image_answer(url: str) -> dict:
    kind = int(url.split("kind=")[1][0])
    data, content_type, _ = _BYTES[kind]
    if "hop" in url:
        return {"redirect": url.replace("hop", "end")}
    return {"body": bytes.fromhex(data), "content_type": content_type, "url": url}


@query(r"""
WITH p AS (SELECT p_partkey AS n, (p_partkey % 12)::INT AS k, CASE WHEN p_partkey % 24 = 23 THEN 'bad' ELSE printf('fi-%04d', p_partkey) END AS id FROM part),
d(k, hex, ext) AS (VALUES (0, '89504e470d0a1a0a00000000', 'png'), (1, 'ffd8ffe000104a46', 'jpg'), (2, '474946383961', 'gif'), (3, '524946460000000057454250', 'webp'), (4, '3c7376672f3e', 'svg'), (7, '00000100', 'ico'), (8, '68656c6c6f', NULL), (10, '3c7376673e3c2f7376673e', 'svg'))
SELECT p.id, CASE WHEN p.id = 'bad' THEN NULL WHEN p.k = 9 THEN 'pool/images/' || p.id || '.png' WHEN ext IS NOT NULL THEN 'pool/images/' || p.id || '.' || ext END AS image_file,
  CASE WHEN p.id = 'bad' THEN NULL WHEN p.k = 9 THEN 'there' WHEN ext IS NOT NULL THEN sha256(unhex(hex)) END AS image_sha256,
  CASE WHEN p.id = 'bad' OR p.k IN (5, 6, 8, 11) THEN true ELSE false END AS failed
FROM p LEFT JOIN d ON p.k = d.k
""")
def archived_images(spark, sf_dir):
    """Copies by a getter that redirects, of data: urls and inline graphics; what is there is adopted, what is no image fails."""
    n = F.col("p_partkey")
    k = (n % 12).cast("int")
    url = F.when(k == 8, F.lit("data:text/plain;base64,aGVsbG8=")).when(k < 8, F.concat(F.format_string("https://h%d.org/hop?kind=%d&n=%d", n % 5, k, n)))
    rows = read(spark, sf_dir, "part").select(
        F.when(n % 24 == 23, "bad").otherwise(F.format_string("fi-%04d", n)).alias("id"), F.lit("unreviewed").alias("status"), F.lit(None).cast("string").alias("image_file"),
        F.when(k.isin(10, 11), "inline-svg").otherwise("img").alias("implementation"), F.when(k == 9, "https://x.org/9").otherwise(url).alias("image_url"), F.when(k == 10, "<svg></svg>").alias("image_svg"),
    )
    present = rows.where("image_url = 'https://x.org/9'").select(F.concat("id", F.lit(".png")).alias("name"), F.lit("there").alias("sha256"))
    return archive.archive(rows, present, _image_answer, 0.0).select("id", "image_file", "image_sha256", F.col("error").isNotNull().alias("failed"))


# Sessions, regions and small functions.


@query("""
SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN 'alt ' || n_nationkey WHEN n_nationkey % 5 = 0 THEN '' ELSE 'name ' || n_nationkey END AS announced,
  CASE n_nationkey % 4 WHEN 0 THEN 'an aria-label' WHEN 1 THEN 'a title attribute' ELSE 'text in the markup' END AS source,
  CASE WHEN n_nationkey % 3 = 0 THEN 'alt ' || n_nationkey WHEN n_nationkey % 2 = 0 THEN '(alt="", deliberately empty)' ELSE '(no alt attribute on the image)' END AS alt FROM nation
""")
def session_view(spark, sf_dir):
    k = F.col("n_nationkey")
    rows = read(spark, sf_dir, "nation").select(
        k.cast("string").alias("id"), F.when(k % 3 == 0, "").when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("name "), k)).alias("accessible_name"),
        F.when(k % 4 == 0, "aria-label").when(k % 4 == 1, "title").otherwise("other").alias("accessible_name_source"), F.when(k % 3 == 0, F.concat(F.lit("alt "), k)).when(k % 2 == 0, "").alias("observed_alt"),
    )
    return session.shown(rows).select(F.col("id").cast("int").alias("k"), "announced", "source", "alt")


@query("""
WITH d AS (SELECT conv_id, count(*) AS done FROM conversations GROUP BY conv_id), t AS (SELECT count(*) AS total FROM nation)
SELECT d.conv_id AS session_id, CASE WHEN done < total THEN 'n' || done END AS next_id, greatest(total - done, 0) AS "left" FROM d, t
""")
def session_cursor(spark, sf_dir):
    items = read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_nationkey").alias("pos"))
    decisions = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("session_id"))
    return session.cursor(items, decisions, decisions)


@query("""
SELECT conv_id::VARCHAR AS session_id, 40 AS corpus_size, count(*) AS accepted, 0::BIGINT AS rejected, max(turn)::VARCHAR AS last_id, true AS reasons FROM conversations GROUP BY conv_id
""")
def session_documents(spark, sf_dir):
    """Decisions of a session as the document that is sent in, taken apart again."""
    made = session.decide("s", read(spark, sf_dir, "conversations").select(F.col("turn").cast("string").alias("id"), F.lit("accepted").alias("status"), F.lit("  ").alias("reason"), "conv_id", "turn").where("turn >= 0"))
    events = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").cast("string").alias("id"), F.lit("accepted").alias("status"), F.lit(None).cast("string").alias("reason"), F.timestamp_seconds("turn").alias("timestamp"))
    blank = made.where("reason is not null").isEmpty()
    out = session.report(session.results(events, 40)).select("session_id", F.from_json("report", "corpus_size int, accepted long, rejected long, results array<struct<id string, status string, reason string, timestamp timestamp>>").alias("r"))
    last = F.element_at("r.results", -1)
    return out.select("session_id", "r.corpus_size", "r.accepted", "r.rejected", last["id"].alias("last_id"), (last["reason"].isNull() & F.lit(blank)).alias("reasons"))


@query("""
SELECT p_partkey AS k, 'outlined rect, ' || CASE WHEN p_partkey % 100 + 5 < 40 THEN 'top' WHEN p_partkey % 100 + 5 < 80 THEN 'middle' ELSE 'bottom' END || ' left of the map: x 0 to 10, y ' || p_partkey % 100 || ' to ' || p_partkey % 100 + 10 || ' of 300 by 120' AS note FROM part
""")
def region_notes(spark, sf_dir):
    y = F.col("p_partkey") % 100
    html = F.concat(F.lit('<area shape="rect" coords="0,'), y, F.lit(",10,"), y + 10, F.lit('">'))
    d = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), region.parse_region(F.lit("area"), html, F.lit("300x120")).alias("r")).withColumn("s", region.region_shape(F.col("r")))
    return d.select("k", region.region_note(F.col("s"), F.col("r.width"), F.col("r.height")).alias("note"))


@query(r"""
SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x{a0}\x{feff}\x{2000}-\x{200a}\x{3000}\x{85}]+', ' ', 'g')) AS collapsed FROM documents
""")
def collapsed_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", columns.collapse(F.col("text")).alias("collapsed"))


@query("""
SELECT p_partkey AS k, printf('%02d', p_partkey) AS batch, repeat('#', least(20, (p_partkey / 150.0 * 20 + 0.5)::DOUBLE.floor())::INT) || repeat('.', 20 - least(20, (p_partkey / 150.0 * 20 + 0.5)::DOUBLE.floor())::INT) AS bar,
  strftime(now() AT TIME ZONE 'UTC', '%Y-%m-%d') AS today, true AS session, '<svg a="' || p_partkey || '"></svg>' AS svg, p_partkey % 13 AS number FROM part
""".replace("(p_partkey / 150.0 * 20 + 0.5)::DOUBLE.floor()", "floor(p_partkey / 150.0 * 20 + 0.5)"))
def small_functions(spark, sf_dir):
    k = F.col("p_partkey")
    html = F.concat(F.lit("<a href=x>\n<svg a=\""), k, F.lit('"></svg> t</a>'))
    fresh = session.new_session_id()
    number = columns.item_number(F.format_string("fi-%04d", k % 13))
    return read(spark, sf_dir, "part").select(k.alias("k"), columns.batch_number(k).alias("batch"), columns.bar(k, 150).alias("bar"), columns.today().alias("today"), fresh.rlike("^v-[0-9a-z]{6,}-[0-9a-z]{5}$").alias("session"), columns.svg_slice(html).alias("svg"), number.alias("number"))


@query("""
WITH g AS (SELECT p_partkey, p_partkey + 1 AS goal FROM part)
SELECT p_partkey, greatest(1, ceil(round(goal * 0.05, 9)))::INT AS domain, greatest(1, floor(round(goal * 0.08, 9) + 0.5))::INT AS sector_least, greatest(1, floor(round(goal * 0.25, 9) + 0.5))::INT AS sector_most,
  greatest(1, floor(round(goal * 0.05, 9) + 0.5))::INT AS subtype_least, greatest(1, ceil(round(goal * 0.05 * 3, 9)))::INT AS wide_domain FROM g
""")
def cap_arithmetic(spark, sf_dir):
    """Caps for a goal of every size; those of Settings and Caps are the same for the goals that are looked at."""
    s, goal = Settings(), F.col("p_partkey") + 1
    for n in (1, 30, 100, 250):
        at = Settings(goal=n)
        mine = spark.range(1).select(columns.share_cap(F.lit(n), s.domain_share), columns.least_share(F.lit(n), s.sector_min_share), columns.share_cap(F.lit(n), s.domain_share, 3)).first()
        assert tuple(mine) == (at.domain_cap(), at.share(at.sector_min_share), selection.Caps(goal=n, headroom=3).domain_cap)
    return read(spark, sf_dir, "part").select(
        "p_partkey", columns.share_cap(goal, s.domain_share).alias("domain"), columns.least_share(goal, s.sector_min_share).alias("sector_least"), columns.least_share(goal, s.sector_max_share).alias("sector_most"),
        columns.least_share(goal, s.subtype_min_share).alias("subtype_least"), columns.share_cap(goal, s.domain_share, 3).alias("wide_domain"),
    )


@query("SELECT max(r_regionkey) + 3 AS next_batch, 4 AS pending FROM region")
def batch_state(spark, sf_dir):
    """Batches 1 to 5 have inputs, all but the fourth have verdicts; a prompt of the sixth is there."""
    k = (F.col("r_regionkey") + 1).cast("int")
    r = read(spark, sf_dir, "region")
    found = r.select(k.alias("batch"), F.lit("input").alias("kind")).unionByName(r.where("r_regionkey != 3").select(k.alias("batch"), F.lit("verdicts").alias("kind")))
    found = found.unionByName(r.where("r_regionkey = 4").select((k + 1).alias("batch"), F.lit("prompt").alias("kind")))
    return spark.createDataFrame([(text.next_batch(found), text.pending_batch(found))], "next_batch int, pending int")


@query("SELECT printf('  %6d  %s', n, lang) AS line FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def text_report(spark, sf_dir):
    lines = aggregates.lines(aggregates.tally(read(spark, sf_dir, "documents"), "lang"), "lang")
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query("""
SELECT l_partkey, l_suppkey, min(l_orderkey) AS l_orderkey FROM lineitem l WHERE l_suppkey % 2 = 0 OR l_partkey % 2 = 0 GROUP BY l_partkey, l_suppkey
""")
def first_unseen(spark, sf_dir):
    """The first row of each key that is not known, where the parts of keys may be null."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("s"), "l_suppkey")
    known = rows.where((F.col("l_suppkey") % 2 == 1) & (F.col("l_partkey") % 2 == 1)).select("l_partkey", "l_suppkey", "s")
    return pool.unseen(pool.firsts(rows, ["l_partkey", "s", "l_suppkey"], ["l_orderkey"]), known, ["l_partkey", "s", "l_suppkey"]).select("l_partkey", "l_suppkey", "l_orderkey")


@query("""
SELECT n_nationkey AS k, (['png', 'jpg', NULL, 'svg', NULL])[(n_nationkey % 5 + 1)::INT] AS by_type, (['png', 'jpg', 'webp', NULL, NULL])[(n_nationkey % 5 + 1)::INT] AS by_url, (['png', 'jpg', 'gif', 'webp', 'svg', NULL, NULL, 'ico'])[(n_nationkey % 8 + 1)::INT] AS by_bytes,
  n_nationkey % 8 = 4 AS is_svg FROM nation
""")
def file_endings(spark, sf_dir):
    k = F.col("n_nationkey")
    of = lambda values: F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (k % len(values) + 1).cast("int"))
    kind = of(["image/png", "IMAGE/JPEG; q=1", "text/html", "image/svg+xml", None])
    url = of(["https://x.org/a.PNG?x=1", "https://x.org/b.jpeg#f", "https://x.org/c.webp", "https://x.org/d.html", "https://x.org/e"])
    data = F.unhex(of([x[0] for x in _BYTES]))
    return read(spark, sf_dir, "nation").select(k.alias("k"), media.ext_from_type_col(kind).alias("by_type"), media.ext_from_url_col(url).alias("by_url"), media.sniff_col(data).alias("by_bytes"), media.looks_col("svg", data).alias("is_svg"))


def _with_place(sql: str) -> str:
    return f"SELECT id, outcome, chosen_seq, id::BIGINT AS pos FROM ({sql})"


ORACLES["greedy_select"] = _with_place(_greedy("false", "", True, 13, 60))
ORACLES["shortlist"] = _with_place(_greedy("pos < 30", " UNION ALL SELECT page, domain, coalesce(sector, '-'), coalesce(subtype, '-'), coalesce(image, '-') FROM pool WHERE pos >= 5 AND pos < 10", False, 38, 100))
