"""Named queries over the star-schema and web tables, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import table_functions
from marlstone.functions import url as U
from marlstone.operators import aggregates, archive, crawl, export, extract, pool, region, review, robots, session, validate
from marlstone.operators import select as selection
from marlstone.plans import queries_files, queries_pages, queries_rules, queries_streams  # noqa: F401  they register their queries
from marlstone.plans.registry import ORACLES, QUERIES, query, read
from marlstone.plans.schemas import SUBTYPES
from marlstone.streaming import pool_stream

FLAGSHIP = "outbound_links"


@query(r"""
WITH hrefs AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT DISTINCT page_id, href FROM hrefs
WHERE href <> '' AND NOT regexp_matches(regexp_replace(href, '[?#].*$', ''), '(?i)\.(pdf|zip|jpg|jpeg|png|gif|svg|mp4|mp3|css|js|xml|json)$')
""")
def outbound_links(spark, sf_dir):
    return extract.outbound_links(read(spark, sf_dir, "pages")).select("page_id", "href")


@query(r"""
SELECT regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') AS domain, count(*) AS pages
FROM pages GROUP BY 1
""")
def domain_normalise(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(U.plain_domain(F.col("url")).alias("domain")).agg(F.count("*").alias("pages"))


@query(r"""
SELECT page_id, regexp_replace(url, '#.*$', '') AS bare, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
  regexp_matches(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '(?i)\.(pdf|zip|jpg|jpeg|png|gif|svg|mp4|mp3|css|js|xml|json)$') AS asset
FROM pages
""")
def url_parts(spark, sf_dir):
    path = U.plain_path(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", U.without_hash(F.col("url")).alias("bare"), path.alias("path"), U.is_asset(path).alias("asset"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def tally_ordered(spark, sf_dir):
    return aggregates.tally(read(spark, sf_dir, "documents"), "source")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 15")
def tally_top(spark, sf_dir):
    return aggregates.top(read(spark, sf_dir, "documents"), "source", 15)


@query("""
SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' ELSE 'source' END AS field, coalesce(lang, source) AS value, count(*) AS n
FROM documents GROUP BY GROUPING SETS ((lang), (source))
""")
def coverage_sets(spark, sf_dir):
    return validate.tallies(read(spark, sf_dir, "documents"), ("lang", "source"))


@query("""
WITH d(lang) AS (VALUES ('en'), ('de'), ('fr'), ('es'), ('it'), ('pt'), ('nl'))
SELECT d.lang, coalesce(c.n, 0) AS n FROM d LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) c ON d.lang = c.lang
""")
def coverage_zero_fill(spark, sf_dir):
    return aggregates.filled_tally(read(spark, sf_dir, "documents"), "lang", ["en", "de", "fr", "es", "it", "pt", "nl"])


@query("""
WITH t AS (SELECT count(*) AS n FROM documents), c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT lang, c.n AS n, CASE WHEN c.n > floor(t.n * 0.25 + 0.5) THEN 'over' ELSE 'short' END AS warning FROM c, t
WHERE c.n > floor(t.n * 0.25 + 0.5) OR c.n < floor(t.n * 0.12 + 0.5)
""")
def coverage_warnings(spark, sf_dir):
    c = validate.tallies(read(spark, sf_dir, "documents"), ("lang",)).select(F.col("value").alias("lang"), "n")
    # The total comes from the counts: a window over a few rows.
    c = c.withColumn("t", F.sum("n").over(Window.partitionBy()))
    high, low = F.floor(F.col("t") * 0.25 + 0.5), F.floor(F.col("t") * 0.12 + 0.5)
    return c.where((F.col("n") > high) | (F.col("n") < low)).select("lang", "n", F.when(F.col("n") > high, "over").otherwise("short").alias("warning"))


@query("SELECT doc_id, md5(text) AS key FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def first_occurrence(spark, sf_dir):
    return pool.firsts(read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("key")), ["key"], ["doc_id"])


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pool_anti_join(spark, sf_dir):
    return pool.unseen(read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id, printf('fi-%04d', row_number() OVER (ORDER BY doc_id)) AS id FROM documents")
def assign_ids(spark, sf_dir):
    return pool.number(read(spark, sf_dir, "documents").select("doc_id"), 0, ["doc_id"]).select("doc_id", "id")


@query("SELECT max(l_orderkey) + 1 AS next FROM lineitem")
def next_id(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").select(F.format_string("fi-%04d", "l_orderkey").alias("id"))
    return spark.createDataFrame([(pool.last_number(items) + 1,)], "next long")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) <= 2
""")
def per_page_cap(spark, sf_dir):
    return pool.capped(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", ["l_linenumber"], 2)


def _selection_pool(spark, sf_dir) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    bucket = lambda n: F.concat(F.lit("b"), F.pmod(F.col("doc_id"), F.lit(n)))
    return d.select(F.col("doc_id").cast("string").alias("id"), bucket(97).alias("page_url"), bucket(41).alias("domain"), F.col("source").alias("sector"), F.col("lang").alias("subtype"), F.lit("f").alias("image_file"), F.md5("text").alias("image_sha256"), F.lit("link").alias("element_role"), F.col("doc_id").alias("pos"))


@query()
def greedy_select(spark, sf_dir):
    p = _selection_pool(spark, sf_dir)
    return selection.select(p, p.limit(0), selection.Caps(add=60, goal=250))


@query()
def shortlist(spark, sf_dir):
    p = _selection_pool(spark, sf_dir)
    return selection.shortlist(p, p.where("pos < 10"), p.where("pos >= 5 and pos < 30"), want=120)


def _corpus(spark, sf_dir) -> DataFrame:
    kinds = F.array(*(F.lit(s) for s in SUBTYPES))
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("unreviewed").alias("status"),
        F.concat(F.lit("pool/images/"), F.col("doc_id"), F.lit(".png")).alias("image_file"),
        F.element_at(kinds, (F.pmod("doc_id", F.lit(7)) + 1).cast("int")).alias("subtype"),
        (F.lit(0)).alias("category"),
        F.lit(None).cast("string").alias("review_verdict"),
        F.lit(None).cast("string").alias("review_reason"),
        F.lit(None).cast("string").alias("alt_quality"),
        F.col("doc_id").alias("pos"),
    )


def _verdicts(spark, sf_dir) -> DataFrame:
    good = F.col("quality") == 1
    return read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("item_id"),
        F.when(good, "keep").otherwise("drop").alias("verdict"),
        F.when(good, "good").otherwise("weak").alias("alt_quality"),
        F.lit("  long enough to be taken as a reason ").alias("reason"),
        F.when(F.col("toxic") == 1, "standalone-navigational-link").alias("subtype"),
        F.col("doc_id").alias("line"),
    )


@query("""
SELECT d.doc_id::VARCHAR AS id, CASE WHEN l.doc_id IS NULL THEN 'unreviewed' WHEN quality = 1 THEN 'ready' ELSE 'dropped' END AS status,
  CASE WHEN quality = 1 THEN 'keep' WHEN quality = 0 THEN 'drop' END AS review_verdict,
  CASE WHEN l.doc_id IS NOT NULL THEN 'long enough to be taken as a reason' END AS review_reason,
  CASE WHEN toxic = 1 AND d.doc_id % 7 <> 1 THEN 1 ELSE 0 END AS category
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def apply_review(spark, sf_dir):
    return review.merge(_corpus(spark, sf_dir), _verdicts(spark, sf_dir)).select("id", "status", "review_verdict", "review_reason", "category")


@query("""
WITH v AS (SELECT doc_id, quality FROM labels), two AS (SELECT * FROM v UNION ALL SELECT doc_id, quality FROM v WHERE doc_id % 50 = 0)
SELECT doc_id::VARCHAR AS item_id, 'repeated_in_batch' AS problem FROM two GROUP BY doc_id HAVING count(*) > 1
UNION ALL SELECT doc_id::VARCHAR, 'keep_not_good' FROM labels WHERE quality = 0
""")
def check_verdicts(spark, sf_dir):
    v = _verdicts(spark, sf_dir).withColumn("verdict", F.lit("keep"))
    v = v.unionByName(v.where("line % 50 = 0").withColumn("line", F.col("line") + 1_000_000_000).withColumn("alt_quality", F.lit("good")))
    return review.check(v, _corpus(spark, sf_dir)).select("item_id", "problem")


@query("SELECT doc_id::VARCHAR AS id, 'pool/images/' || doc_id || '.png' AS image_file FROM labels JOIN documents USING (doc_id) WHERE quality = 1")
def export_ready(spark, sf_dir):
    return export.export(review.merge(_corpus(spark, sf_dir), _verdicts(spark, sf_dir))).select("id", "image_file")


@query("""
SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS unreviewed, count(*) FILTER (WHERE quality = 1) AS ready, count(*) FILTER (WHERE quality = 0) AS dropped, 0::BIGINT AS held
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def export_sizes(spark, sf_dir):
    return export.sizes(review.merge(_corpus(spark, sf_dir), _verdicts(spark, sf_dir)))


@query("""
SELECT doc_id, unnest(list_filter([CASE WHEN NOT regexp_matches(text, '^[A-Z]') THEN 'no_capital' END, CASE WHEN n_chars < 200 THEN 'short' END,
  CASE WHEN NOT regexp_matches(source, '^src[0-9]$') THEN 'source_form' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'lang_value' END], lambda x: x IS NOT NULL)) AS problem
FROM documents
""")
def check_problems(spark, sf_dir):
    tests = [("no_capital", ~F.col("text").rlike("^[A-Z]")), ("short", F.col("n_chars") < 200), ("source_form", ~F.col("source").rlike("^src[0-9]$")), ("lang_value", ~F.col("lang").isin("en", "fr"))]
    return validate.broken(read(spark, sf_dir, "documents"), tests, "doc_id")


@query("""
SELECT l_orderkey, l_linenumber, min(l_orderkey) OVER (PARTITION BY l_partkey, l_suppkey) AS first_order FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) > 1
""")
def duplicate_key_first_line(spark, sf_dir):
    rows = validate.repeats(read(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", F.col("first").alias("first_order"))


@query("""
WITH rec AS (SELECT o_orderkey::VARCHAR AS id, o_custkey || '.png' AS name, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN 'x' ELSE sha256('c' || o_custkey) END AS sha FROM orders),
disk AS (SELECT c_custkey || '.png' AS name, sha256('c' || c_custkey) AS sha FROM customer WHERE c_custkey % 5 <> 0),
log AS (SELECT c_custkey || '.png' AS name FROM customer WHERE c_custkey % 10 = 0)
SELECT rec.id, rec.name, CASE WHEN disk.name IS NULL AND log.name IS NOT NULL THEN 'removed' WHEN disk.name IS NULL THEN 'missing' WHEN rec.sha = '' THEN 'noHash' WHEN rec.sha <> disk.sha THEN 'hashDiffers' ELSE 'ok' END AS finding
FROM rec LEFT JOIN disk ON rec.name = disk.name LEFT JOIN log ON rec.name = log.name
UNION ALL SELECT NULL, disk.name, 'orphan' FROM disk WHERE NOT EXISTS (SELECT 1 FROM rec WHERE rec.name = disk.name)
""")
def verify_archive(spark, sf_dir):
    name = lambda c: F.concat(F.col(c), F.lit(".png"))
    digest = lambda c: F.sha2(F.concat(F.lit("c"), F.col(c)), 256)
    sha = F.when(F.col("o_orderkey") % 11 == 0, "").when(F.col("o_orderkey") % 7 == 0, "x").otherwise(digest("o_custkey"))
    items = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("pool/images/"), name("o_custkey")).alias("image_file"), sha.alias("image_sha256"))
    c = read(spark, sf_dir, "customer")
    return archive.verify(items, c.where("c_custkey % 5 != 0").select(name("c_custkey").alias("name"), digest("c_custkey").alias("sha256")), c.where("c_custkey % 10 = 0").select(name("c_custkey").alias("name"), F.lit("dropped").alias("reason")))


@query("""
SELECT p_partkey || '.png' AS name, CASE WHEN p_partkey % 4 = 0 THEN 'keep' WHEN p_partkey % 4 = 1 THEN 'dropped' WHEN p_partkey % 4 = 2 THEN 'keep'
  WHEN p_partkey % 3 = 0 THEN 'unselected' ELSE 'orphaned' END AS class FROM part
""")
def cleanup_plan(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey")
    name = F.concat(F.col("p_partkey"), F.lit(".png"))
    status = F.when(F.col("p_partkey") % 4 == 0, "ready").when(F.col("p_partkey") % 4 == 1, "dropped").otherwise("unreviewed")
    corpus = p.where("p_partkey % 4 != 3").select(F.concat(F.lit("pool/images/"), name).alias("image_file"), status.alias("status"), F.col("p_partkey").alias("pos"))
    return archive.cleanup_plan(p.select(name.alias("name")), corpus, p.where("p_partkey % 3 = 0").select(F.col("p_partkey").cast("string").alias("id")))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT doc_id::VARCHAR AS item_id, doc_id % 7 AS kind FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id LIMIT 30")
def batch_input(spark, sf_dir):
    corpus = review.merge(_corpus(spark, sf_dir), _verdicts(spark, sf_dir))
    return review.batch_input(corpus, 30).select("item_id", (F.col("pos") % 7).alias("kind"))


@query("""
SELECT event_id, user_id, gap_s FROM (SELECT event_id, user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS gap_s FROM events)
WHERE gap_s < 3600
""")
def host_gap_audit(spark, sf_dir):
    return session.gaps(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", 3600).select("event_id", "user_id", "gap_s")


@query("""
SELECT conv_id AS session_id, count(*) AS reviewed, count(*) FILTER (WHERE role = 'user') AS accepted, count(*) FILTER (WHERE role <> 'user') AS rejected,
  floor(least(count(*), 10) / 10 * 100 + 0.5)::INT AS percent
FROM conversations GROUP BY conv_id
""")
def session_summary(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    decisions = c.select(F.col("conv_id").alias("session_id"), F.col("turn").cast("string").alias("id"), F.when(F.col("role") == "user", "accepted").otherwise("rejected").alias("status"), F.lit(None).cast("string").alias("reason"), F.timestamp_seconds("turn").alias("timestamp"))
    return session.results(decisions, 10).select("session_id", "reviewed", "accepted", "rejected", "percent")


@query("SELECT event_type, count(*) AS n, sum((props->>'$.k')::BIGINT) AS total FROM events GROUP BY event_type")
def json_report(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


ROBOTS = "User-agent: *\nDisallow: /en/\nAllow: /en/7\nDisallow: /*.html$\nDisallow: /de\nAllow: /de/1"


@query(r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS tail FROM pages),
q AS (SELECT page_id, CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END AS path FROM p),
r(allow, len, pattern) AS (VALUES (false, 4, '^/en/'), (true, 5, '^/en/7'), (false, 8, '^/.*\.html$'), (false, 3, '^/de'), (true, 5, '^/de/1'))
SELECT q.page_id, coalesce(first(r.allow ORDER BY r.len DESC, r.allow DESC), true) AS allowed FROM q LEFT JOIN r ON regexp_matches(q.path, r.pattern) GROUP BY q.page_id
""")
def robots_longest_match(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", robots.origin(F.col("url")).alias("origin"), robots.path_and_query(F.col("url")).alias("path"))
    rules = robots.rule_table(p.select("origin").distinct().withColumn("text", F.lit(ROBOTS)))
    return robots.decide(p, rules).select("page_id", "allowed")


@query("""
WITH RECURSIVE h AS (SELECT 'o' || k AS url, CASE WHEN k % 41 = 2 THEN 'gone' WHEN k % 50 = 7 THEN 'o' || k WHEN k % 60 = 20 THEN 'o' || (k + 3) WHEN k % 9 <> 0 THEN 'o' || (k - 1) END AS redirect,
  CASE WHEN k % 37 = 3 THEN 'HTTP 500' END AS error, k % 31 = 5 AS refused FROM (SELECT o_orderkey AS k FROM orders)),
w(url, place, chain, error, done, hop) AS (
  SELECT url, url, [url], NULL::VARCHAR, false, 0 FROM h
  UNION ALL
  SELECT url, CASE WHEN moves THEN redirect ELSE place END, CASE WHEN moves THEN list_append(chain, redirect) ELSE chain END, problem, NOT moves, hop + 1 FROM (
    SELECT *, problem IS NULL AND redirect IS NOT NULL AS moves FROM (
      SELECT w.url, w.place, w.chain, w.hop, h.redirect, CASE WHEN h.refused THEN 'disallowed by robots.txt' WHEN h.url IS NULL THEN 'HTTP 404' WHEN h.error IS NOT NULL THEN h.error WHEN list_contains(w.chain, h.redirect) THEN 'redirect loop' END AS problem
      FROM w LEFT JOIN h ON w.place = h.url WHERE NOT w.done AND w.hop < 6))),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY hop DESC) AS k FROM w)
SELECT url, CASE WHEN done AND error IS NULL THEN place END AS final, len(chain) AS hops, CASE WHEN NOT done THEN 'more than 5 redirects' ELSE error END AS error FROM f WHERE k = 1
""")
def redirect_chain(spark, sf_dir):
    """A link for every order: chains, loops, some too long, some that end in errors, nowhere, or where rules forbid."""
    k = F.col("o_orderkey")
    to = F.when(k % 41 == 2, "gone").when(k % 50 == 7, F.concat(F.lit("o"), k)).when(k % 60 == 20, F.concat(F.lit("o"), k + 3)).when(k % 9 != 0, F.concat(F.lit("o"), k - 1))
    hops = read(spark, sf_dir, "orders").select(F.concat(F.lit("o"), k).alias("url"), to.alias("redirect"), F.when(k % 37 == 3, "HTTP 500").alias("error"), (k % 31 == 5).alias("refused"))
    return crawl.resolve(hops.select("url"), hops).select("url", "final", F.size("chain").cast("long").alias("hops"), "error")


@query("""
WITH p AS (SELECT p_partkey, p_partkey % 6 AS form, p_partkey % 200 AS a, p_partkey % 70 AS b FROM part),
s AS (SELECT p_partkey, form, CASE form WHEN 0 THEN 'rect' WHEN 1 THEN 'rect' WHEN 2 THEN 'circle' WHEN 3 THEN 'polygon' WHEN 5 THEN 'polygon' END AS tag,
  CASE form WHEN 2 THEN a - b WHEN 4 THEN NULL ELSE a END::DOUBLE AS x1, CASE form WHEN 2 THEN 100 - b WHEN 4 THEN NULL ELSE b END::DOUBLE AS y1,
  CASE form WHEN 2 THEN a + b WHEN 3 THEN a + 50 WHEN 5 THEN a + 6 WHEN 4 THEN NULL ELSE a + 90 END::DOUBLE AS x2, CASE form WHEN 2 THEN 100 + b WHEN 3 THEN b + 40 WHEN 5 THEN b + 5 WHEN 4 THEN NULL ELSE b + 30 END::DOUBLE AS y2 FROM p)
SELECT p_partkey, tag, x1, y1, x2, y2, CASE WHEN tag IS NOT NULL THEN (['top', 'middle', 'bottom'])[(least(2, greatest(0, floor((y1 + y2) / 2 / 300 * 3))) + 1)::INT] || ' ' || (['left', 'centre', 'right'])[(least(2, greatest(0, floor((x1 + x2) / 2 / 300 * 3))) + 1)::INT] END AS place FROM s
""")
def region_box(spark, sf_dir):
    """Areas of all shapes: rectangles from either corner, circles, polygons of four, two and three corners."""
    k = F.col("p_partkey")
    a, b = k % 200, k % 70
    text = lambda *parts: F.concat_ws(",", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    forms = [("rect", text(a, b, a + 90, b + 30)), ("RECT", text(a + 90, b + 30, a, b)), ("circle", text(a, 100, b)), ("poly", text(a, b, a + 50, b, a + 50, b + 40, a, b + 40)), ("poly", text(a, b, a + 9, b)), ("Polygon", text(a, b, a + 6, b, a + 6, b + 5))]
    shape, coords = (F.element_at(F.array(*(F.lit(f[0]) if n == 0 else f[1] for f in forms)), (k % 6 + 1).cast("int")) for n in (0, 1))
    html = F.concat(F.lit('<area shape="'), shape, F.lit('" coords="'), coords, F.lit('">'))
    d = read(spark, sf_dir, "part").select("p_partkey", region.parse_region(F.lit("area"), html, F.lit("300x300")).alias("r")).withColumn("s", region.region_shape(F.col("r")))
    place = F.concat(region.band((F.col("s.y1") + F.col("s.y2")) / 2, F.col("r.height"), region.ROWS), F.lit(" "), region.band((F.col("s.x1") + F.col("s.x2")) / 2, F.col("r.width"), region.COLUMNS))
    return d.select("p_partkey", "s.tag", "s.x1", "s.y1", "s.x2", "s.y2", place.alias("place"))


_TAGS = r"""
WITH h AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<script>.*?</script>', '<script>', 'g'), '(?s)<style>.*?</style>', '<style>', 'g'), '(?s)<title>.*?</title>', '<title>', 'g') AS html FROM pages)
SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1))) AS tag FROM h) GROUP BY ALL
"""


@query(_TAGS)
def elements_by_table_function(spark, sf_dir):
    """Elements of the pages' own html in SQL: a table function over the pages, dealt by page."""
    table_functions.register(spark)
    read(spark, sf_dir, "pages").createOrReplaceTempView("marlstone_pages")
    return spark.sql("SELECT page_id, tag, count(*) AS n FROM page_elements(TABLE(SELECT page_id, html FROM marlstone_pages) PARTITION BY page_id) GROUP BY page_id, tag")


@query(_TAGS)
def elements_by_lateral(spark, sf_dir):
    """The same, page by page in a lateral join."""
    table_functions.register(spark)
    read(spark, sf_dir, "pages").createOrReplaceTempView("marlstone_pages")
    return spark.sql("SELECT p.page_id, e.tag, count(*) AS n FROM marlstone_pages p, LATERAL html_elements(p.html) e GROUP BY p.page_id, e.tag")


@query("""
SELECT date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY 1
""")
def window_rollup(spark, sf_dir):
    return pool_stream.rollup(read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "n")
