"""Every query of the catalog runs; those with SQL give its rows."""

import glob
import os
import re

import pandas as pd
import pytest

from marlstone.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(frame):
    text = lambda x: "-" if pd.isna(x) else f"{x:.9g}" if isinstance(x, float) else re.sub(r"\.0$", "", str(x))
    return sorted(tuple(map(text, r)) for r in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)


def test_entry_needs_no_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) > 80 and len(e.oracle_sql()) > 75"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry_imports():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stream_appends_only_what_is_new(spark, tmp_path):
    from marlstone.streaming import pool_stream

    html = '<a href="/x"><img src="i.png" alt="A"></a>'
    source = str(tmp_path / "in")
    for k in (1, 2):
        spark.createDataFrame([(k, "https://x.org/p", html), (10 + k, f"https://x.org/q{k}", html)], "page_id long, url string, html string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("page_id long, url string, html string").parquet(source)
        query = pool_stream.append_new(stream, str(tmp_path / "pool"), str(tmp_path / "cp"))
        query.awaitTermination()
        assert k == 1 or str(tmp_path / "pool") not in query._jsq.explainInternal(False)
    rows = spark.read.json(str(tmp_path / "pool")).orderBy("id").collect()
    assert [(r["id"], r["page_url"]) for r in rows] == [("fi-0001", "https://x.org/p"), ("fi-0002", "https://x.org/q1"), ("fi-0003", "https://x.org/q2")]


def test_stream_knows_a_pool_that_was_there(spark, tmp_path):
    from marlstone.sources import sinks
    from marlstone.streaming import pool_stream

    html = '<a href="/x"><img src="i.png" alt="A"></a><a href="/x"><img src="i.png" alt="B"></a>'
    from pyspark.sql import functions as F

    from marlstone.operators import extract, pool

    pages = spark.createDataFrame([(1, "https://x.org/p", html)], "page_id long, url string, html string")
    sinks.append_jsonl(pool.number(extract.candidates(pages, F.lit("webapp")).where("accessible_name = 'B'"), 6, ["page_id", "pos"]), str(tmp_path / "pool"))
    pages.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema("page_id long, url string, html string").parquet(str(tmp_path / "in"))
        pool_stream.append_new(stream, str(tmp_path / "pool"), str(tmp_path / "cp")).awaitTermination()
    assert sorted((r["id"], r["accessible_name"]) for r in spark.read.json(str(tmp_path / "pool")).collect()) == [("fi-0007", "B"), ("fi-0008", "A")]


def test_stream_tells_new_keys_without_python(spark, tmp_path):
    """A key that comes in several batches, before and after a restart: its first page counts, and no key goes to a Python task."""
    from marlstone.streaming import pool_stream

    def run(pages):
        for page, url, near in pages:
            html = f'<div>{near}<a href="/x"><img src="i.png" alt="A"></a></div>'
            spark.createDataFrame([(page, f"https://x.org/{url}", html)], "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("page_id long, url string, html string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = pool_stream.append_new(stream, str(tmp_path / "pool"), str(tmp_path / "cp"))
        query.awaitTermination()
        return query._jsq.explainInternal(False)

    plan = run([(5, "p", "five"), (2, "p", "two"), (7, "q", "seven"), (9, "p", "nine")])
    assert "StateStoreSave" in plan and "Python" not in plan and "Pandas" not in plan
    run([(1, "p", "one"), (3, "r", "three"), (4, "r", "four"), (8, "q", "eight")])
    rows = spark.read.json(str(tmp_path / "pool")).orderBy("id").collect()
    assert [(r["id"], r["page_url"][-1], r["surrounding_text"]) for r in rows] == [("fi-0001", "p", "two"), ("fi-0002", "q", "seven"), ("fi-0003", "r", "three")]


def test_batch_that_runs_again_adds_nothing_twice(spark, tmp_path):
    from marlstone.sources import sinks

    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    for batch in (0, 1, 1):
        assert sinks.append_batch(rows, str(tmp_path / "out"), batch) == 2
    assert spark.read.json(str(tmp_path / "out")).count() == 4


@pytest.fixture(scope="module")
def many_pages(spark, tmp_path_factory):
    """Pages for more than 9,999 items, so ids have four digits and five; some pages share a url."""
    path = str(tmp_path_factory.mktemp("many"))
    url = "concat('https://www.x', id % 7, '.org/a/', if(id % 50 = 1, id - 1, id))"
    spark.range(750).selectExpr("id AS page_id", f"{url} AS url", "'<h1>a &amp; b &quot;c&quot; &lt;d&amp</h1>' AS html").write.parquet(f"{path}/pages.parquet")
    return path


def against_sql(spark, path, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/pages.parquet/*.parquet'")
    want = con.execute(catalog.ORACLES[name]).df()
    assert len(want) and plain(catalog.QUERIES[name](spark, path).toPandas()) == plain(want)


def test_new_candidates_with_ids_of_five_digits(spark, many_pages):
    against_sql(spark, many_pages, "new_candidates")


def test_streamed_pool_with_ids_of_five_digits_and_shared_urls(spark, many_pages):
    against_sql(spark, many_pages, "streamed_pool")


def test_page_headings_with_other_entities(spark, many_pages):
    against_sql(spark, many_pages, "page_headings")


def test_redirect_chains_are_dealt_by_rows_and_hot_places_apart(spark, monkeypatch):
    """Few rows a task, and a place where half of all chains end: the same chains, by more tasks."""
    from pyspark.sql import functions as F

    from marlstone.operators import crawl

    k = F.col("id")
    to = F.when(k % 2 == 0, F.lit("u1")).when(k % 5 == 0, "gone").when(k % 7 != 1, F.concat(F.lit("u"), k - 2))
    hops = spark.range(400).select(F.concat(F.lit("u"), k).alias("url"), to.alias("redirect"), F.when(k % 11 == 3, "HTTP 500").alias("error"), F.lit(None).cast("boolean").alias("refused"))
    rows = lambda df: sorted(map(str, df.collect()))
    want = rows(crawl.resolve(hops.select("url"), hops))
    monkeypatch.setattr(crawl, "ROWS", 50)
    monkeypatch.setattr(crawl, "HOT", 20)
    got = crawl.resolve(hops.select("url"), hops)
    assert rows(got) == want and len(want) == 400
    assert len(got.groupBy(F.spark_partition_id()).count().collect()) > 8
