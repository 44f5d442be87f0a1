"""Queries that write files of a scratch folder and read them back: sources and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marlstone.operators import aggregates, archive, review, session
from marlstone.plans import stages
from marlstone.plans.registry import query, read
from marlstone.plans.schemas import ITEM, Settings
from marlstone.sources import blobs, jsonl, sinks, text
from marlstone.sources.scratch import folder, keep

ROWS = StructType([StructField("doc_id", LongType()), *(StructField(c, StringType()) for c in ("source", "lang", "note"))])


def place(spark, name: str) -> str:
    return f"{folder(spark)}/marlstone/{name}-{jsonl.unique()}"


def _rows(spark, sf_dir) -> DataFrame:
    """Narrow rows of documents; notes are null, empty, or have line ends and quotes."""
    note = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.concat(F.lit('a "b"\n\r\\ é '), F.col("doc_id").cast("string")))
    return read(spark, sf_dir, "documents").select("doc_id", "source", "lang", note.alias("note"))


_NOTED = r"""
SELECT doc_id, source, lang, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'a "b"' || chr(10) || chr(13) || '\ é ' || doc_id END AS note FROM documents
"""


@query(_NOTED)
def jsonl_appended(spark, sf_dir):
    """Two appends, read back strictly."""
    path, rows = place(spark, "append"), _rows(spark, sf_dir)
    sinks.append_jsonl(rows.where("doc_id % 2 = 0"), path)
    sinks.append_jsonl(rows.where("doc_id % 2 = 1"), path)
    sinks.append_jsonl(rows, path, dry_run=True)
    return jsonl.read_strict(spark, path, ROWS).select("doc_id", "source", "lang", "note")


@query("SELECT doc_id, source || '!' AS source FROM documents WHERE doc_id % 2 = 0")
def jsonl_rewritten(spark, sf_dir):
    """A table that is read, changed, and put in the place of itself; what a crash would leave comes back."""
    path = place(spark, "rewrite")
    sinks.overwrite_jsonl(_rows(spark, sf_dir), path)
    now = jsonl.read(spark, path, ROWS)[0]
    sinks.overwrite_jsonl(now.where("doc_id % 2 = 0").withColumn("source", F.concat("source", F.lit("!"))), path)
    sinks.recover(spark, path)
    return jsonl.read(spark, path, ROWS)[0].select("doc_id", "source")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) + (row_number() OVER (ORDER BY doc_id) - 1) // 4 AS line FROM documents")
def jsonl_lines(spark, sf_dir):
    """Rows with the lines of their file, a blank line after each four of them."""
    rows = _rows(spark, sf_dir)
    from pyspark.sql import Window

    numbered = rows.withColumn("nth", F.row_number().over(Window.orderBy("doc_id")) - 1)
    lines = numbered.select("nth", F.to_json(F.struct("doc_id", "source")).alias("value")).unionByName(numbered.where("nth % 4 = 3").select("nth", F.lit("").alias("value")))
    path = place(spark, "lines")
    lines.orderBy("nth", F.desc("value")).coalesce(1).select("value").write.text(path)
    return jsonl.read(spark, path, ROWS)[0].select("doc_id", F.col("pos").alias("line"))


@query("SELECT n_nationkey::BIGINT + 1 AS line FROM nation WHERE n_nationkey % 4 = 0")
def jsonl_bad_lines(spark, sf_dir):
    path = place(spark, "bad")
    n = F.col("n_nationkey")
    value = F.when(n % 8 == 0, "{no object").when(n % 4 == 0, "[1, 2]").otherwise(F.to_json(F.struct(n.alias("doc_id"))))
    read(spark, sf_dir, "nation").orderBy("n_nationkey").coalesce(1).select(value.alias("value")).write.text(path)
    return jsonl.read(spark, path, ROWS)[1].select(F.col("line").cast("long").alias("line"))


@query("SELECT doc_id, source FROM documents UNION ALL SELECT NULL, 'refused'")
def jsonl_strict_or_lenient(spark, sf_dir):
    """One bad line: the strict scan refuses the table, the lenient one leaves the line out."""
    path = place(spark, "lenient")
    rows = _rows(spark, sf_dir).select(F.to_json(F.struct("doc_id", "source")).alias("value"))
    rows.unionByName(spark.createDataFrame([("{broken",)], "value string")).write.text(path)
    try:
        jsonl.read_strict(spark, path, ROWS)
        said = "read"
    except ValueError:
        said = "refused"
    return jsonl.read_lenient(spark, path, ROWS).select("doc_id", "source").unionByName(spark.createDataFrame([(None, said)], "doc_id long, source string"))


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT -1")
def jsonl_first_place(spark, sf_dir):
    """The first of three places that has a table; a place without one is an empty table."""
    one, two, none = place(spark, "first"), place(spark, "second"), place(spark, "none")
    sinks.overwrite_jsonl(_rows(spark, sf_dir).where("doc_id % 2 = 0"), one)
    sinks.overwrite_jsonl(_rows(spark, sf_dir).where("doc_id % 2 = 1"), two)
    found = jsonl.read_first(spark, [none, one, two], ROWS).select("doc_id")
    empty = jsonl.read(spark, none, ROWS)[0].agg((F.count("*") - 1).alias("doc_id"))
    return found.unionByName(empty)


@query("""
SELECT 'http://' || lower(regexp_replace(n_name, '[ _]', '-', 'g')) || '.org/x' AS url, lower(regexp_replace(r_name, '[ _]', '-', 'g')) AS sector, row_number() OVER (ORDER BY lower(regexp_replace(r_name, '[ _]', '-', 'g')), n_nationkey) - 1 AS pos FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def seed_lists(spark, sf_dir):
    """A file a sector; comments, blank lines, fragments and a line that is no address."""
    rows, _ = text.seeds(spark, _seeds(spark, sf_dir))
    return rows


def _seeds(spark, sf_dir) -> str:
    path = place(spark, "seeds")
    name = lambda c: F.lower(F.regexp_replace(c, "[ _]", "-"))
    line = F.concat(F.lit("http://"), name("n_name"), F.lit(".org/x#part # why"))
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    lists = n.groupBy(name("r_name").alias("sector")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    for r in lists.collect():
        sinks.write_text(spark, f"{path}/{r['sector']}.txt", f"# {r['sector']}\n\n{r['body']}\nno address\n")
    return path


@query("SELECT lower(regexp_replace(r_name, '[ _]', '-', 'g')) || '.txt' AS file, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) + 3 AS line, 'no address' AS url FROM region WHERE r_regionkey = 1")
def seed_errors(spark, sf_dir):
    """Of one sector only: the other files are not read."""
    sector = read(spark, sf_dir, "region").where("r_regionkey = 1").select(F.lower(F.regexp_replace("r_name", "[ _]", "-"))).first()[0]
    return text.seeds(spark, _seeds(spark, sf_dir), sector)[1]


@query("SELECT n_nationkey || '.png' AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'orphaned' ELSE 'dropped' END AS reason FROM nation WHERE n_nationkey % 3 <> 0 OR n_nationkey % 5 = 0")
def removal_log(spark, sf_dir):
    """Written in two steps, with names that are logged already left out; then the last entry of a name counts."""
    path, n = place(spark, "log"), read(spark, sf_dir, "nation")
    rows = n.where("n_nationkey % 3 != 0").select(F.concat("n_nationkey", F.lit(".png")).alias("name"), F.lit("dropped").alias("class"))
    sinks.append_log(archive.log_entries(rows, spark.createDataFrame([], "name string, reason string")), path, first=True)
    known = text.read_removal_log(spark, path)
    sinks.append_log(archive.log_entries(rows, known), path, first=False)
    later = n.where("n_nationkey % 5 = 0").select(F.concat("n_nationkey", F.lit(".png")).alias("name"), F.lit("orphaned").alias("reason"))
    sinks.append_log(later, path, first=False)
    lines = jsonl.lines(spark, path).withColumn("line", F.when(F.col("value").endswith("orphaned"), 10**6).otherwise(F.col("line")))
    return text.removal_log(lines)


@query("SELECT doc_id || '.txt' AS name, octet_length(encode(text)) AS size, sha256(text) AS sha256 FROM documents WHERE doc_id % 5 <> 0 AND text IS NOT NULL")
def archive_files(spark, sf_dir):
    """Contents written file by file, some deleted again, then listed with their bytes."""
    path = place(spark, "files")
    d = read(spark, sf_dir, "documents").where("text is not null")
    rows = d.select(F.concat(F.lit("pool/images/"), "doc_id", F.lit(".txt")).alias("image_file"), F.encode("text", "UTF-8").alias("content"))
    sinks.write_files(rows, path)
    sinks.write_text(spark, f"{path}/README.md", "no image")
    name = F.concat("doc_id", F.lit(".txt")).alias("name")
    sinks.delete_files(d.where("doc_id % 5 = 1").select(name), path, dry_run=True)
    sinks.delete_files(d.where("doc_id % 5 = 0").select(name), path, dry_run=False)
    return blobs.contents(spark, path, content=False)


@query("SELECT n_nationkey || '.bin' AS name FROM nation")
def archive_names(spark, sf_dir):
    path = place(spark, "names")
    rows = read(spark, sf_dir, "nation").select(F.concat("n_nationkey", F.lit(".bin")).alias("image_file"), F.encode("n_name", "UTF-8").alias("content"))
    sinks.write_files(rows, path)
    sinks.write_text(spark, f"{path}/.hidden", "x")
    return blobs.names(spark, path)


def _items(spark, sf_dir) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    made = {"id": F.format_string("fi-%04d", "doc_id"), "status": F.when(F.col("doc_id") % 3 == 0, "ready").otherwise("unreviewed"), "image_file": F.lit("pool/images/x.png"), "alt_quality": F.when(F.col("doc_id") % 3 == 0, "good"), "page_url": F.concat(F.lit("p"), F.col("doc_id") % 9), "category": F.lit(1), "subtype": F.lit("linked-standalone-logo")}
    return d.select(*(made.get(f, F.lit(None)).cast(ITEM[f].dataType).alias(f) for f in ITEM.fieldNames()), F.col("doc_id").alias("pos"))


@query("""
WITH u AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS nth FROM documents WHERE doc_id % 3 <> 0)
SELECT CASE WHEN nth <= 7 THEN 1 ELSE 2 END AS batch, printf('fi-%04d', doc_id) AS item_id, 'linked-standalone-logo' AS proposed_subtype, true AS prompted FROM u WHERE nth <= 14
""")
def frozen_batches(spark, sf_dir):
    """Batch 1 is frozen, judged and applied, then batch 2 is frozen, and frozen again while it waits."""
    base = place(spark, "review")
    corpus, reviews, s = f"{base}/corpus", f"{base}/review", Settings(batch_size=7)
    sinks.overwrite_jsonl(_items(spark, sf_dir), corpus)
    said: list[str] = []
    codes = [stages.apply_batch(spark, corpus, reviews, say=said.append), stages.batch_input(spark, corpus, reviews, s, say=said.append), stages.apply_batch(spark, corpus, reviews, say=said.append)]
    given = spark.read.json(f"{reviews}/batch-01-input.jsonl")
    verdicts = given.select("item_id", F.lit("keep").alias("verdict"), F.lit("good").alias("alt_quality"), F.lit("it is plain what this leads to").alias("reason"), F.lit(None).cast("string").alias("subtype"))
    sinks.overwrite_jsonl(verdicts, f"{reviews}/batch-01.jsonl")
    codes += [stages.apply_batch(spark, corpus, reviews, say=said.append), stages.batch_input(spark, corpus, reviews, s, say=said.append), stages.batch_input(spark, corpus, reviews, s, say=said.append)]
    names = {r["file"].rsplit("/", 1)[-1] for r in text.batches(spark, f"{reviews}/batch-*").collect()}
    ok = codes == [1, 0, 2, 0, 0, 0] and names == {"batch-01-input.jsonl", "batch-01-prompt.md", "batch-01.jsonl", "batch-02-input.jsonl", "batch-02-prompt.md"}
    rows = [spark.read.json(f"{reviews}/batch-0{n}-input.jsonl").select(F.lit(n).alias("batch"), "item_id", "proposed_subtype", F.lit(ok).alias("prompted")) for n in (1, 2)]
    return rows[0].unionByName(rows[1])


@query("""
WITH e AS (SELECT doc_id FROM documents WHERE doc_id % 3 = 0) SELECT printf('fi-%04d', doc_id) AS id, 17::BIGINT AS fields FROM e
""")
def exported_file(spark, sf_dir):
    """The stage that exports, onto a file that is there already; records keep their nulls."""
    base = place(spark, "export")
    sinks.overwrite_jsonl(_items(spark, sf_dir), f"{base}/corpus")
    sinks.write_text(spark, f"{base}/images/x.png", "x")
    for _ in range(2):
        stages.export(spark, f"{base}/corpus", f"{base}/images", f"{base}/out", say=lambda _: None)
    return spark.read.text(f"{base}/out").select(F.get_json_object("value", "$.id").alias("id"), F.size(F.json_object_keys("value")).cast("long").alias("fields"))


@query("SELECT conv_id AS session, count(*) AS accepted, 12 AS corpus_size FROM conversations GROUP BY conv_id")
def session_files(spark, sf_dir):
    """A file for each session, read back."""
    path = place(spark, "sessions")
    events = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("session_id"), F.col("turn").cast("string").alias("id"), F.lit("accepted").alias("status"), F.lit("r").alias("reason"), F.timestamp_seconds("turn").alias("timestamp"))
    sinks.write_sessions(session.report(session.results(events, 12)), path)
    return spark.read.json(path).select(F.col("session_id").cast("long").alias("session"), "accepted", F.col("corpus_size").cast("int").alias("corpus_size"))


@query("""
SELECT 'more' AS kind, (count(*) - 40)::VARCHAR AS line FROM documents WHERE doc_id % 3 <> 0
UNION ALL SELECT 'records', 'records: ' || count(*) FILTER (WHERE doc_id % 3 <> 0) || ' unreviewed, ' || count(*) FILTER (WHERE doc_id % 3 = 0) || ' ready, 0 dropped; goal 250' FROM documents
UNION ALL SELECT 'lines', '40' UNION ALL SELECT 'exit', '2'
""")
def check_report(spark, sf_dir):
    """What the check of a corpus says: the first 40 problems, how many more, and counts. Records here break 11 rules each,
    of which one is looked at."""
    from marlstone.operators import validate

    path = place(spark, "checked")
    sinks.overwrite_jsonl(_items(spark, sf_dir), path)
    said: list[str] = []
    code = stages.check(spark, path, say=said.append)
    items = jsonl.read_strict(spark, path, ITEM)
    problems = keep(validate.check(items).where("problem = 'domain_filled'").join(items.where("status = 'unreviewed'").select("id"), "id"), "some")
    heard: list[str] = []
    stages._first(problems.orderBy("line"), "{line}", 40, heard.append)
    more = heard[-1].split()[1]
    out = [("more", more), ("records", next(x for x in said if x.startswith("records"))), ("lines", str(len(heard) - 1)), ("exit", str(code))]
    return spark.createDataFrame(out, "kind string, line string")


@query("SELECT CASE WHEN doc_id % 3 = 0 THEN 'ready' ELSE 'unreviewed' END AS status, count(*) AS n FROM documents GROUP BY 1")
def status_tally(spark, sf_dir):
    path = place(spark, "tally")
    sinks.overwrite_jsonl(_items(spark, sf_dir), path)
    return aggregates.tally(jsonl.read_strict(spark, path, ITEM), "status")


@query("SELECT printf('fi-%04d', doc_id) AS item_id FROM documents WHERE doc_id % 3 <> 0 ORDER BY doc_id LIMIT 30")
def waiting_items(spark, sf_dir):
    path = place(spark, "waiting")
    sinks.append_jsonl(_items(spark, sf_dir), path)
    items = jsonl.read_strict(spark, path, ITEM).withColumn("pos", F.regexp_extract("id", r"(\d+)$", 1).cast("long"))
    return review.batch_input(items, 30).select("item_id")


def _picture(url: str) -> dict:
    return {"body": b"\x89PNG" + url.encode(), "content_type": "image/png", "url": url}


@query("""
WITH n AS (SELECT count(*) AS n FROM nation)
SELECT what, k::BIGINT AS n FROM n, LATERAL (VALUES ('1 run', 0), ('2 pool', 2 * n), ('3 shortlist', 2 * n), ('4 images', 2 * n), ('5 corpus', 20), ('6 ready', 8), ('7 exported', 8), ('8 least of a sector', 4), ('9 most of a sector', 4),
  ('a verify', 0), ('b validate', 0), ('c problems', 0), ('d cleanup, dry', 0), ('e cleanup', 0), ('f images left', 20), ('g nothing new', 1), ('h arguments', 3), ('i second batch', 0)) t(what, k)
""")
def whole_run(spark, sf_dir):
    """All stages from seeds to the export, with pages, pictures and verdicts that are made up; exit codes and counts."""
    base = place(spark, "run")
    where = {k: f"{base}/{k}" for k in ("pool", "shortlist", "corpus", "images", "log", "reviews", "out")} | {"seeds": _seeds(spark, sf_dir)}
    s = Settings(goal=40, add=20, pages_per_host=1, follow=0, batch_size=8, host_delay_s=0.0)
    said: list[str] = []

    def load(urls: DataFrame) -> DataFrame:
        picture = lambda k: F.format_string('<a href="/%d"><img src="http://img.org/%s.png" alt="Picture %d"></a>', F.lit(k), F.xxhash64("url", F.lit(k)).cast("string"), F.lit(k))
        return urls.select("url", F.col("url").alias("final_url"), F.concat(picture(1), picture(2)).alias("html"), F.lit(None).cast("string").alias("error"))

    def judge(prompt_file: str, batch: int) -> bool:
        given = spark.read.json(f"{where['reviews']}/batch-{batch:02d}-input.jsonl")
        made = given.select("item_id", F.lit("keep").alias("verdict"), F.lit("good").alias("alt_quality"), F.lit("the picture says where it leads").alias("reason"), F.lit(None).cast("string").alias("subtype"))
        sinks.overwrite_jsonl(made, f"{where['reviews']}/batch-{batch:02d}.jsonl")
        return sinks.size(spark, prompt_file) > 0

    counted = lambda name: jsonl.read_strict(spark, where[name], ITEM).count()
    out = [("1 run", stages.run(spark, where, s, _picture, load, judge, said.append)), *((f"{n} {name}", counted(name)) for n, name in ((2, "pool"), (3, "shortlist")))]
    corpus = keep(jsonl.read_strict(spark, where["corpus"], ITEM), "corpus")
    sectors = [r["count"] for r in corpus.groupBy("sector").count().collect()]
    out += [("4 images", blobs.names(spark, where["images"]).count()), ("5 corpus", corpus.count()), ("6 ready", corpus.where("status = 'ready'").count()), ("7 exported", spark.read.json(where["out"]).count()), ("8 least of a sector", min(sectors)), ("9 most of a sector", max(sectors))]
    out += [("a verify", stages.verify(spark, where["corpus"], where["images"], where["log"], said.append)), ("b validate", stages.check(spark, where["corpus"], s, as_json=True, say=said.append))]
    out.append(("c problems", spark.createDataFrame([(said[-1],)], "report string").select(F.get_json_object("report", "$.problems").cast("int")).first()[0]))
    out += [(f"{n}", stages.cleanup(spark, where["images"], where["corpus"], where["shortlist"], where["log"], True, apply, said.append)) for n, apply in (("d cleanup, dry", False), ("e cleanup", True))]
    out += [("f images left", blobs.names(spark, where["images"]).count()), ("g nothing new", stages.harvest(spark, where["seeds"], where["pool"], settings=s, fetcher=load, say=said.append))]
    out += [("h arguments", stages.harvest(spark, where["seeds"], where["pool"], settings=Settings(follow=-1), fetcher=load, say=said.append)), ("i second batch", stages.batch_input(spark, where["corpus"], where["reviews"], s, say=said.append))]
    return spark.createDataFrame(out, "what string, n long")
