"""Pages to candidates, links, robots rules and crawls."""

import pytest

from marlstone.operators import crawl, extract, pool, robots
from marlstone.sources import fetch, text, web

PAGE = """<html><body><svg style="display:none"><symbol id="s1" viewBox="0 0 8 8"><path d="M0"/></symbol></svg>
<a href="/"><img src="/logo.png" alt="Home of things"></a>
<a href="/doc"><img src="d.png" alt="Report"></a>
<a href="/more"><img src="m.png" alt="">Read more</a>
<a href="/none"><img src="n.png"></a>
<button><svg viewBox="0 0 1 1"><title>Close</title><path d="M1"/></svg></button>
<button aria-label="Bell"><svg><use xlink:href="#s1"></use></svg></button>
<button aria-label="Far"><svg><use href="/sprite.svg#x"></use></svg></button>
<input type="image" src="go.png" alt="Go">
<a href="/text">only text</a><img src="free.png" alt="free">
<img src="map.png" usemap="#m" width="370" height="200" alt="Map">
<map name="m"><area href="/n" coords="0,0,1,1" alt="North"><area href="/s" coords="1,1,2,2" alt="South"></map>
<map name="p"><area href="/w" coords="0,0,1,1" alt="West"></map><img src="p.png" usemap="#p" width="50%" height="20" alt="P">
</body></html>"""
SAME = "<body>" + '<a href="/x"><img src="i.png" alt="Same"></a>' * 3 + "</body>"


@pytest.fixture(scope="module")
def judged(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(1, "https://www.x.org/p/", PAGE), (2, "https://x.org/q", SAME), (3, "https://x.org/empty", None)], "page_id long, url string, html string")
    return extract.judged(pages, F.lit("docs"), "2024-05-06").persist()


def test_fixture_page(judged):
    rows = judged.where("page_id = 1 and skip_reason is null").orderBy("pos").collect()
    got = [(r["accessible_name"], r["accessible_name_source"], r["element_role"], r["subtype"]) for r in rows]
    nav, area = "standalone-navigational-link", "linked-complex-graphic-or-image-map"
    assert got == [
        ("Home of things", "alt", "link", "linked-standalone-logo"),
        ("Report", "alt", "link", nav),
        ("Read more", "control-text", "link", nav),
        ("Close", "svg-title", "button", "action-or-toggle-icon"),
        ("Bell", "aria-label", "button", "action-or-toggle-icon"),
        ("Go", "alt", "input-image", "form-control-or-image-button"),
        ("North", "alt", "area", area),
        ("South", "alt", "area", area),
        ("West", "alt", "area", area),
    ]
    by = {r["accessible_name"]: r for r in rows}
    assert by["Report"]["image_url"] == "https://www.x.org/p/d.png" and by["Report"]["domain"] == "x.org"
    assert by["North"]["image_url"] == "https://www.x.org/p/map.png" and by["North"]["image_coord_space"] == "370x200"
    assert by["West"]["image_coord_space"] is None
    assert by["Read more"]["observed_alt"] == "" and by["Read more"]["surrounding_text"] == "Read more"
    assert by["Bell"]["image_svg"] == '<svg xmlns="http://www.w3.org/2000/svg" xmlns:xlink="http://www.w3.org/1999/xlink" viewBox="0 0 8 8"><defs><symbol id="s1" viewBox="0 0 8 8"><path d="M0"/></symbol></defs><use xlink:href="#s1"></use></svg>'
    assert by["Close"]["image_svg"].startswith('<svg viewBox="0 0 1 1" xmlns=')
    assert all(r["element_html"] in PAGE for r in rows)


NAMES = [
    ('<a href=x aria-label="L">t<img alt=A></a>', ("L", "aria-label")),
    ('<a href=x aria-labelledby="q">t<img alt=A></a><i id=q>Q</i>', ("Q", "aria-labelledby")),
    ('<a href=x aria-labelledby="q r">t<img alt=A></a><i id=r>R</i><i id=q>Q <b aria-hidden=true>no</b></i>', ("Q R", "aria-labelledby")),
    ('<a href=x aria-labelledby="gone">t<img alt=A></a>', ("t", "control-text")),
    ("<a href=x title=T><img alt=A></a>", ("A", "alt")),
    ('<a href=x title=T><img alt=""></a>', ("T", "title")),
    ("<button><svg><title>S</title><path/></svg></button>", ("S", "svg-title")),
    ("<button><svg aria-hidden=true><title>S</title></svg></button>", ("", "")),
    ("<a href=x><span aria-hidden=true>no</span><img title=I></a>", ("I", "title")),
    ("<div aria-hidden=true>far <a href=x>near<img></a></div>", ("near", "control-text")),
    ("<a href=x>one<div>two</div>three<img></a>", ("one two three", "control-text")),
    ("<button><input type=image alt=In></button>", ("In", "alt")),
]


def _nodes(spark, docs):
    return extract.explode_nodes(spark.createDataFrame([(k, "https://x.org/", d) for k, d in enumerate(docs)], "page_id long, url string, html string"), texts=True).persist()


def test_names(spark):
    got = {r["page_id"]: (r["name"], r["name_source"]) for r in extract.announced(_nodes(spark, [d for d, _ in NAMES])).collect()}
    assert [got.get(k) for k in range(len(NAMES))] == [want for _, want in NAMES]


def test_controls_stop_at_blocks_of_content(spark):
    docs = ["<a href=x><main><img alt=a></main></a>", "<button><a><img alt=b></a></button>", "<a href=' '><img></a>", "<a href=x><b></b></a><img>", "<a href=x><i><button></button><img></i></a>", "<div role=' Tab '><svg><svg></svg></svg></div>", "<area><input type=IMAGE><input>"]
    rows = extract.controls(nodes := _nodes(spark, docs)).join(nodes.select("page_id", nodes["pos"].alias("control"), "tag"), ["page_id", "control"]).collect()
    assert sorted((r["page_id"], r["tag"]) for r in rows) == [(1, "button"), (4, "a"), (5, "div"), (6, "area"), (6, "input")]


def test_nearest_against_a_walk(spark):
    """Random nestings: the nearest of a set around each element and text, found by going up parent by parent."""
    import random

    rng = random.Random(5)
    docs = []
    for _ in range(30):
        out, stack = [], []
        for _ in range(rng.randint(0, 60)):
            if stack and rng.random() < 0.4:
                out.append(f"</{stack.pop()}>")
            else:
                stack.append(tag := rng.choice(["i", "b", "u", "em"]))
                out.append(f"<{tag}>" + rng.choice(["", "x"]))
        docs.append("".join(out))
    from pyspark.sql import functions as F

    nodes = _nodes(spark, docs)
    rows = nodes.collect()
    by = {(r["page_id"], r["pos"]): r for r in rows if r["pos"] is not None}

    def walk(r):
        up = by.get((r["page_id"], r["parent"]))
        while up is not None and up["tag"] not in ("i", "u"):
            up = by.get((r["page_id"], up["parent"]))
        return None if up is None else up["pos"]

    got = extract.nearest(nodes, F.lit(True), F.col("tag").isin("i", "u"), "outer").collect()
    assert sorted((r["page_id"], r["start"], r["tag"], r["outer"] if r["outer"] is not None else -1) for r in got) == sorted((r["page_id"], r["start"], r["tag"], -1 if (w := walk(r)) is None else w) for r in rows)


def test_clip_counts_utf16_units(spark):
    from pyspark.sql import functions as F

    texts = ["a" * 300, "😀" * 200, "a" + "😀" * 200, "", None]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(extract.clip(F.col("t"))).collect()]
    assert got == ["a" * 240, "😀" * 120, "a" + "😀" * 119, "", None]


def test_skips(judged):
    assert {r["skip_reason"]: r["n"] for r in extract.skips(judged.where("page_id = 1")).collect()} == {"noControl": 4, "noName": 1, "noImage": 0, "spriteMissing": 1, "duplicateOnPage": 0}
    assert judged.where("page_id = 2 and skip_reason is null").count() == 1 and judged.where("skip_reason = 'duplicateOnPage'").count() == 2


def test_links(spark):
    doc = '<a href="/a">1</a><a href="/a#x">2</a><a href="http://other/b">3</a><a href="/c.pdf">4</a><a href="mailto:x">5</a><a href="">6</a><a href="https://x.org/p">7</a><a href="b?c">8</a>'
    pages = spark.createDataFrame([(1, "https://x.org/p", doc)], "page_id long, url string, html string")
    assert [r["link"] for r in extract.outbound_links(pages).orderBy("pos").collect()] == ["https://x.org/a", "https://x.org/b?c"]


ROBOTS = "User-agent: *\nDisallow: /private # all\nAllow: /private/ok\nDisallow: /*.json$\nDisallow:\n\nUser-agent: other\nDisallow: /"


@pytest.mark.parametrize(("path", "want"), [("/", True), ("/private/x", False), ("/private/ok", True), ("/a/b.json", False), ("/a.json?x", True), ("/a.json.b.json", False)])
def test_robots(spark, path, want):
    assert robots.allows(robots.rules_for(ROBOTS), path) is want


def test_robots_groups(spark):
    assert robots.allows(robots.rules_for("User-agent: *\nDisallow: /\n\nUser-agent: marlstone-harvester\nDisallow: /x"), "/y") is True
    assert robots.allows(robots.rules_for(""), "/y") is True
    assert robots.allows(robots.rules_for("User-agent: *\nDisallow: /a\nAllow: /a"), "/ab") is True
    urls = spark.createDataFrame([("o", "/private/ok"), ("o", "/private"), ("q", "/private")], "origin string, path string")
    rules = robots.rule_table(spark.createDataFrame([("o", ROBOTS), ("z", None)], "origin string, text string"))
    assert {(r["origin"], r["path"]): r["allowed"] for r in robots.decide(urls, rules).collect()} == {("o", "/private/ok"): True, ("o", "/private"): False, ("q", "/private"): True}


def test_patterns_against_expressions(spark):
    """Rules and paths over a small alphabet: both matchers agree with regular expressions."""
    import itertools
    import re

    patterns = ["".join(x) for n in range(1, 5) for x in itertools.product("/a*", repeat=n)]
    patterns += [p + "$" for p in patterns]
    paths = ["/" + "".join(x) for n in range(4) for x in itertools.product("/ab", repeat=n)]
    want = lambda p, u: re.match("(?s)" + ".*".join(map(re.escape, p.removesuffix("$").split("*"))) + ("$" if p.endswith("$") else ""), u) is not None
    assert all(robots.fits(p, u) is want(p, u) for p in patterns for u in paths)
    rules = spark.createDataFrame([(f"o{k}", False, p) for k, p in enumerate(patterns)], "origin string, allow boolean, path string")
    urls = spark.createDataFrame([(f"o{k}", u) for k in range(len(patterns)) for u in paths], "origin string, path string")
    got = {(r["origin"], r["path"]): r["allowed"] for r in robots.decide(urls, rules).collect()}
    assert got == {(f"o{k}", u): not want(p, u) for k, p in enumerate(patterns) for u in paths}
    plan = robots.decide(urls, rules)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_hostile_pattern_is_quick():
    import time

    began = time.perf_counter()
    assert not robots.fits("/" + "*a" * 30 + "$", "/" + "a" * 5000 + "b")
    assert time.perf_counter() - began < 1


def test_redirects():
    hops = {"a": {"redirect": "b"}, "b": {"html": "x"}, "l": {"redirect": "m"}, "m": {"redirect": "l"}, "r": {"redirect": "no"}} | {f"c{k}": {"redirect": f"c{k + 1}"} for k in range(9)}
    go = lambda u: fetch.follow_redirects(u, lambda x: x != "no", lambda x: hops[x])
    assert go("a") == {"html": "x", "chain": ["a", "b"]}
    assert go("l")["error"] == "redirect loop" and "robots" in go("r")["error"] and go("c0")["error"] == "more than 5 redirects"


def _noting(folder):
    """A getter that notes what it is asked, as a file each."""
    folder.mkdir()

    def get(url):
        import uuid

        (folder / uuid.uuid4().hex).write_text(url)
        return {"error": "HTTP 404"} if url.endswith("3") else {"body": b"x", "content_type": None, "url": url}

    return get


def test_nothing_is_fetched_twice(spark, tmp_path):
    get = _noting(tmp_path / "asked")
    urls = spark.createDataFrame([(f"http://h{k % 3}.org/{k}",) for k in range(12)] + [(None,), ("http://h0.org/0",)], "url string")
    for rows, n in ((urls.where("url is null"), 0), (urls.where("url not like '%5'"), 11), (urls, 12), (urls, 12), (urls.limit(0), 12)):
        out = web.fetch_once(rows, get, str(tmp_path / "pages"), delay_s=0.0, buckets=2, portion_urls=4)
        assert sorted(f.read_text() for f in (tmp_path / "asked").iterdir()) == sorted(f"http://h{k % 3}.org/{k}" for k in range(12) if k != 5 or n == 12)[:n]
        assert out.count() == rows.where("url is not null").distinct().count()
    assert spark.read.parquet(str(tmp_path / "pages" / "answers")).where("error is not null").count() == 1
    assert (tmp_path / "pages" / "urls" / "portion=3").is_dir()  # 11 urls in three portions, then one more


def test_a_run_that_broke_off_goes_on(spark, tmp_path):
    """Portions that were laid out but not asked come with the next run, and only they."""
    get = _noting(tmp_path / "asked")
    urls = spark.createDataFrame([(f"http://h.org/{k}",) for k in range(10)], "url string")
    path = str(tmp_path / "pages")
    web.fetch_once(urls.where("url like '%/1' or url like '%/2'"), get, path, delay_s=0.0, buckets=2)
    next(web.lay_out(urls.where("url < 'http://h.org/7'"), f"{path}/urls"))
    assert web.fetch_once(urls.where("url < 'http://h.org/7'"), get, path, delay_s=0.0).count() == 7
    assert len(list((tmp_path / "asked").iterdir())) == 7


def test_web_from_sql_by_origin(spark, tmp_path):
    """An origin is one task's, and its requests keep their distance; images come as bytes."""
    import os
    import time

    def get(url):
        return {"body": f"{os.getpid()} {time.monotonic()}".encode(), "content_type": "image/png", "url": url}

    urls = spark.createDataFrame([(f"http://h{k % 2}.org/{k}",) for k in range(8)] + [("data:image/png;base64,eA==",), ("data:,%",)], "url string")
    list(web.lay_out(urls, str(tmp_path / "urls"), buckets=4, portion_urls=3))
    web.register(spark, get, 0.2)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW images USING marlstone_web OPTIONS (path '{tmp_path}/urls', kind 'image')")
    got = {r["url"]: r for r in spark.sql("SELECT * FROM images").collect()}
    assert len(got) == 10 and got["data:image/png;base64,eA=="]["body"] == b"x"
    for host in ("h0", "h1"):
        asked = [bytes(r["body"]).decode().split() for u, r in got.items() if u.startswith(f"http://{host}.")]
        times = sorted(float(t) for _, t in asked)
        assert len({p for p, _ in asked}) == 1 and all(b - a >= 0.19 for a, b in zip(times, times[1:], strict=False))
    with pytest.raises(Exception, match="kinds page, image"):
        spark.read.format("marlstone_web").option("kind", "sound").load(str(tmp_path / "urls")).count()


def test_resolve_against_a_walk(spark):
    import random

    rng = random.Random(2)
    table = {f"u{k}": (rng.choice([None, *(f"u{rng.randrange(45)}" for _ in range(4))]), rng.choice([None] * 9 + ["HTTP 500"]), rng.random() < 0.05) for k in range(40)}

    def walk(u, most):
        chain = [u]
        for _ in range(most + 1):
            to, error, refused = table.get(u, (None, "HTTP 404", False))
            if refused or error:
                return None, chain, "disallowed by robots.txt" if refused else error
            if to is None:
                return u, chain, None
            if to in chain:
                return None, chain, "redirect loop"
            chain.append(to)
            u = to
        return None, chain, f"more than {most} redirects"

    hops = spark.createDataFrame([(u, *x) for u, x in table.items()], "url string, redirect string, error string, refused boolean")
    starts = spark.createDataFrame([(u,) for u in [*table, "nowhere", "u1"]], "url string")
    for most in (1, 5):
        got = {r["url"]: (r["final"], r["chain"], r["error"]) for r in crawl.resolve(starts, hops, most).collect()}
        assert got == {u: walk(u, most) for u in [*table, "nowhere"]}


def test_table_functions(spark):
    from marlstone.functions import table_functions

    table_functions.register(spark)
    rows = spark.sql("SELECT x.tag, x.parent FROM VALUES ('<p>a<b>c'), (NULL), ('') v(h), LATERAL html_elements(v.h) x").collect()
    assert sorted(map(tuple, rows)) == [("b", 0), ("p", -1)]


def test_crawl(spark):
    link = lambda *names: "".join(f'<a href="/{n}">{n}</a>' for n in names)
    store = spark.createDataFrame(
        [
            ("http://h/", "http://h/", link("a", "b", "c"), None),
            ("http://h/a", "http://h/a2", link("a2", "d"), None),
            ("http://h/b", None, None, "HTTP 404"),
            ("http://g/", None, None, "disallowed by robots.txt"),
        ],
        "url string, final_url string, html string, error string",
    )
    from pyspark.sql import functions as F

    fetch = lambda urls: urls.join(store, "url", "left").withColumn("error", F.when(F.col("html").isNull() & F.col("error").isNull(), "HTTP 404").otherwise(F.col("error")))
    seeds = spark.createDataFrame([("http://h/", "docs", 0), ("http://g/", "news", 1), ("http://h/", "news", 2)], "url string, sector string, pos int")
    visits, pages = crawl.crawl(seeds, fetch, pages_per_host=12, follow=2)
    assert [(r["url"], r["round"]) for r in visits.where("host = 'h'").orderBy("round").collect()] == [("http://h/", 0), ("http://h/a", 1), ("http://h/b", 2)]
    assert crawl.outcomes(visits).first().asDict() == {"pages": 2, "failed": 1, "disallowed": 1}
    assert {r["sector"] for r in pages.collect()} == {"docs"}
    visits, _ = crawl.crawl(seeds, fetch, pages_per_host=2, follow=8)
    assert visits.where("host = 'h'").count() == 2
    assert crawl.sector_conflicts(seeds).count() == 1


def test_pool(spark, judged):
    found = judged.where("skip_reason is null").drop("skip_reason")
    assert pool.add(found, found, ["page_id", "pos"]).count() == 0
    empty = found.limit(0)
    rows = pool.add(found.unionByName(found), empty, ["page_id", "pos"]).orderBy("id").collect()
    assert [r["id"] for r in rows] == [f"fi-{k:04d}" for k in range(1, 11)]
    have = spark.createDataFrame([("fi-10420",), ("bad",), (None,)], "id string")
    assert pool.last_number(have) == 10420 and pool.last_number(have.limit(0)) == 0


def test_seeds_and_logs(spark, tmp_path):
    (tmp_path / "docs.txt").write_text("# head\nhttps://a.org/x#frag # why\n\nnot a url\nftp://b\n")
    (tmp_path / "news.txt").write_text("http://n.org/\n")
    rows, errors = text.seeds(spark, str(tmp_path))
    assert [(r["url"], r["sector"]) for r in rows.orderBy("pos").collect()] == [("https://a.org/x", "docs"), ("http://n.org/", "news")]
    assert sorted((r["file"], r["line"]) for r in errors.collect()) == [("docs.txt", 4), ("docs.txt", 5)]
    assert text.seeds(spark, str(tmp_path), "news")[0].count() == 1
    (tmp_path / "log").write_text("# c\n\nfi-1.png  dropped\nfi-2.png\nfi-1.png orphaned x\n")
    assert {r["name"]: r["reason"] for r in text.read_removal_log(spark, str(tmp_path / "log")).collect()} == {"fi-1.png": "orphaned", "fi-2.png": "unknown"}
    for n in ("batch-01.jsonl", "batch-01-input.jsonl", "batch-03-input.jsonl"):
        (tmp_path / n).write_text("{}\n")
    found = text.batches(spark, str(tmp_path / "batch-*"))
    assert text.next_batch(found) == 4 and text.pending_batch(found) == 3


def test_written_nodes_are_read_few_times(spark):
    """What images, texts and controls are is found when the nodes are written, not by every step that reads them again."""
    pages = spark.createDataFrame([(1, "https://x.org/p", "<a href='/q'><img src='i.png' alt='I'></a>")], "page_id long, url string, html string")
    found = extract.candidates(pages)
    assert found.count() == 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 12
    assert plan.count("(?U)") <= 20


def test_texts_are_put_together_by_as_many_tasks_as_images_ask_for(spark, monkeypatch):
    docs = [f"<p>Lead {k}</p><a href='/q{k}'><img src='i.png' alt=''>Text {k}</a><svg><title>no</title></svg>" for k in range(40)]
    pages = spark.createDataFrame([(k, f"https://x.org/{k}", d) for k, d in enumerate(docs)], "page_id long, url string, html string")
    rows = lambda df: sorted((r["page_id"], r["accessible_name"], r["surrounding_text"]) for r in df.collect())
    monkeypatch.setattr(extract, "IMAGES", 8)
    tasks, given = [], extract.heard
    monkeypatch.setattr(extract, "heard", lambda *a: tasks.append(a[-1]) or given(*a))
    assert rows(extract.candidates(pages)) == [(k, f"Text {k}", f"Text {k}") for k in range(40)]
    assert tasks == [11]


def test_pages_of_one_file_are_parsed_by_many_tasks(spark, monkeypatch):
    """A file of one row group is one task's; what parses its pages is dealt to as many as joins have."""
    given, parts = extract.explode_nodes, []
    monkeypatch.setattr(extract, "explode_nodes", lambda pages, *a, **k: parts.append(pages.rdd.getNumPartitions()) or given(pages, *a, **k))
    pages = spark.range(0, 40, 1, 1).selectExpr("id AS page_id", "'https://x.org/' AS url", "'<a href=x><img src=i alt=I></a>' AS html")
    assert extract.candidates(pages).count() == 40 and parts == [4]


def test_some_tags_are_judged_as_among_all(spark):
    docs = [PAGE, SAME, "<button>a<svg><title>T<b>no</b> U</title><path/></svg></button>" * 2, "<button><svg><path/></svg></button><svg><path/></svg><a href=x><img src=i alt=I></a>"]
    pages = spark.createDataFrame([(k, "https://x.org/#top", d) for k, d in enumerate(docs)], "page_id long, url string, html string")
    from pyspark.sql import functions as F

    rows = lambda df: sorted(map(str, df.drop("surrounding_text").collect()))
    every = extract.judged(pages, F.lit("docs"), "2024-05-06").persist()
    assert rows(extract.judged(pages, F.lit("docs"), "2024-05-06", around=False, tags=("svg",))) == rows(every.where("implementation = 'inline-svg'"))
    assert rows(extract.judged(pages, F.lit("docs"), "2024-05-06", around=False)) == rows(every)
    assert every.where("implementation = 'inline-svg'").groupBy("skip_reason").count().count() == 5


@pytest.mark.parametrize("name", ["skip_reasons", "control_markup"])
def test_what_is_around_is_asked_only_where_it_is_read(spark, monkeypatch, name):
    from marlstone.plans import catalog

    kinds, given = [], extract.heard
    monkeypatch.setattr(extract, "heard", lambda nodes, asked, *a: kinds.extend(r[0] for r in asked.select("key.kind").distinct().collect()) or given(nodes, asked, *a))
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() == {"skip_reasons": 5, "control_markup": 150}[name]
    assert sorted(kinds) == ["in", "label"]
