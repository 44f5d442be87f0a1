"""Selection, review, validation, archive, export, regions and sessions."""

import base64
import json
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.operators import archive, export, region, review, session, validate
from marlstone.operators import select as S
from marlstone.plans import stages
from marlstone.plans.schemas import ITEM, Settings
from marlstone.sources import jsonl, sinks


def naive(pool, taken, caps):
    """Scans the whole pool for each choice."""
    ids, images = {t["id"] for t in taken}, {(t["image_sha256"], t["element_role"]) for t in taken}
    count = {c: Counter(t[c] for t in taken) for c in ("page_url", "domain", "subtype", "sector")}
    out = ["alreadySelected" if r["id"] in ids else "noImage" if caps.require_image and not (r["image_file"] and r["image_sha256"]) else "remaining" for r in pool]
    live, chosen = [k for k, o in enumerate(out) if o == "remaining"], []
    while len(chosen) < caps.add and live:
        k = min(live, key=lambda i: (count["sector"][pool[i]["sector"]], count["subtype"][pool[i]["subtype"]], i))
        live.remove(k)
        r = pool[k]
        if caps.require_image and (r["image_sha256"], r["element_role"]) in images:
            out[k] = "duplicateImage"
        elif count["page_url"][r["page_url"]] >= 2:
            out[k] = "pageCap"
        elif count["domain"][r["domain"]] >= caps.domain_cap:
            out[k] = "domainCap"
        else:
            out[k] = "chosen"
            chosen.append(k)
            images.add((r["image_sha256"], r["element_role"]))
            for c in count:
                count[c][r[c]] += 1
    return [(r["id"], o, chosen.index(k) if k in chosen else None) for k, (r, o) in enumerate(zip(pool, out, strict=True))]


row = st.fixed_dictionaries(
    {
        "id": st.integers(0, 40).map(str), "page_url": st.sampled_from("abcde"), "domain": st.sampled_from("xyz"), "sector": st.sampled_from(["s1", "s2", None]),
        "subtype": st.sampled_from(["t1", "t2", "t3"]), "image_file": st.sampled_from(["f", "", None]), "image_sha256": st.sampled_from(["h1", "h2", "h3", "h4", None]), "element_role": st.sampled_from(["link", "button"]),
    }
)


def counts(taken):
    out = {c: Counter(t[c] for t in taken) for c in S.COUNTED}
    return out | {"image": Counter((t["image_sha256"], t["element_role"]) for t in taken)}


@settings(max_examples=150, deadline=None)
@given(st.lists(row, max_size=40), st.lists(row, max_size=5), st.integers(0, 15), st.sampled_from([20, 60, 250]), st.booleans())
def test_greedy_is_the_naive_scan(pool, taken, add, goal, images):
    caps = S.Caps(add, goal, require_image=images)
    pool = [r | {"pos": k} for k, r in enumerate(pool)]
    want = naive(pool, taken, caps)
    open_ = [r for r, (_, o, _) in zip(pool, want, strict=True) if o not in ("alreadySelected", "noImage")]
    assert [(r["id"], r["outcome"], r["chosen_seq"]) for r in S.greedy(open_, counts(taken), caps)] == [x for x in want if x[1] not in ("alreadySelected", "noImage")]


@pytest.mark.parametrize("seed", range(2))
def test_select_is_the_naive_scan(spark, seed, monkeypatch):
    """Heads of one to three rows run out again and again; longer ones give what the whole pool gives."""
    import random

    rng = random.Random(seed)
    make = lambda k: {"id": f"i{k}", "page_url": rng.choice("abcdefgh"), "domain": rng.choice("wxyz"), "sector": rng.choice(["s1", "s2", None]), "subtype": rng.choice("tuv"), "image_file": rng.choice(["f"] * 8 + ["", None]), "image_sha256": rng.choice([f"h{n}" for n in range(30)] + [None]), "element_role": rng.choice(["link", "button"])}
    pool = [make(k) | {"pos": k} for k in range(150)]
    taken = [make(k) for k in range(140, 150)]
    schema = "id string, page_url string, domain string, sector string, subtype string, image_file string, image_sha256 string, element_role string"
    frame = lambda rows, more="": spark.createDataFrame([tuple(r.values()) for r in rows], schema + more)
    rankings, ranked = [], S.ranked
    monkeypatch.setattr(S, "ranked", lambda *a: rankings.append(a) or ranked(*a))
    for head, caps in ((1, S.Caps(12, 60)), (4, S.Caps(12, 60, require_image=False))):
        rankings.clear()
        got = S.select(frame(pool, ", pos long").repartition(3), frame(taken), caps, head=head).orderBy("pos").collect()
        assert len(rankings) == 1  # however often heads run out
        assert [(r["id"], r["outcome"], r["chosen_seq"]) for r in got] == naive(pool, taken, caps)


def test_domain_caps():
    assert [S.Caps(goal=g, headroom=h).domain_cap for g, h in ((250, 1), (100, 1), (250, 3), (100, 3), (1, 1))] == [13, 5, 38, 15, 1]
    s = Settings()
    assert (s.share(s.sector_min_share), s.share(s.sector_max_share), s.share(s.subtype_min_share), s.domain_cap()) == (20, 63, 13, 13)


def item(n=1, **over):
    base = dict.fromkeys(ITEM.fieldNames()) | {
        "id": f"fi-{n:04d}", "status": "unreviewed", "page_url": f"https://www.a{n}.org/p", "domain": f"a{n}.org", "sector": "docs", "image_url": "https://a.org/i.png", "implementation": "img", "element_role": "link",
        "element_html": "<a href=x></a>", "surrounding_text": "", "observed_alt": "A", "accessible_name": "A", "accessible_name_source": "alt", "category": 1, "subtype": "linked-standalone-logo", "retrieved": "2024-01-02",
    }
    return base | over


def frame(spark, items):
    rows = spark.createDataFrame([tuple(i.get(f) for f in ITEM.fieldNames()) for i in items], ITEM)
    return rows.withColumn("pos", F.monotonically_increasing_id())


READY = {"status": "ready", "image_file": "pool/images/fi-0001.png", "image_sha256": "a" * 64, "review_verdict": "keep", "review_reason": "r", "alt_quality": "good"}
SVG = {"implementation": "inline-svg", "image_url": None, "image_svg": '<svg xmlns="x"/>'}
BAD = [
    ({}, None), (READY, None), (SVG, None), ({"id": "fi-10421"}, None), ({"observed_alt": ""}, None), ({"observed_alt": None}, None), ({"image_url": "data:image/png,x"}, None),
    ({"element_role": "area", "implementation": "area", "image_coord_space": "10x20"}, None),
    ({"id": "fi-1"}, "id_form"), ({"status": "new", "review_verdict": "keep", "review_reason": "r", "alt_quality": "good"}, "status_value"), ({"domain": ""}, "domain_filled"),
    ({"domain": "www.a1.org"}, "domain_is_host"), ({"sector": None}, "sector_filled"), ({"implementation": "font", "image_svg": None}, "implementation_value"), ({"element_role": "x"}, "element_role_value"),
    ({"image_url": "ftp://x"}, "image_url_needed"), (SVG | {"image_url": "https://a/b"}, "image_url_unneeded"), (SVG | {"image_svg": None}, "image_svg_needed"), (SVG | {"image_svg": "<svg>"}, "image_svg_document"),
    ({"image_svg": "<svg xmlns=1>"}, "image_svg_unneeded"), ({"element_role": "area", "image_coord_space": "010x2"}, "coord_space_form"), ({"image_coord_space": "1x2"}, "coord_space_area"), ({"element_html": ""}, "element_html_filled"),
    ({"element_html": "a"}, "element_html_tag"), ({"surrounding_text": None}, "surrounding_text_string"), ({"accessible_name": ""}, "accessible_name_filled"), ({"accessible_name_source": "x"}, "name_source_value"),
    ({"subtype": "constructor"}, "subtype_value"), ({"category": 2}, "category_of_subtype"), ({"retrieved": "2024-1-2"}, "retrieved_form"), (READY | {"image_file": None}, "ready_file"), (READY | {"image_sha256": "A" * 64}, "ready_sha256"),
    ({"image_file": ""}, "image_file_blank"), (READY | {"status": "dropped", "review_verdict": "no"}, "reviewed_verdict"), (READY | {"review_reason": ""}, "reviewed_reason"),
    (READY | {"status": "dropped", "alt_quality": "x"}, "reviewed_quality"), (READY | {"alt_quality": "weak"}, "ready_good"), (READY | {"review_verdict": "drop"}, "ready_keep"), ({"review_reason": "x"}, "unreviewed_review_reason"),
]


def test_every_rule(spark):
    items = [item(1, **over) | {"id": over.get("id", f"fi-{1000 + k}")} for k, (over, _) in enumerate(BAD)]
    found = {}
    for r in validate.check(frame(spark, items)).collect():
        found.setdefault(r["id"], []).append(r["problem"])
    for i, (over, want) in zip(items, BAD, strict=True):
        assert found.get(i["id"], []) == ([want] if want else []), over
    assert len(validate.rules(F.lit(True), F.lit("x")) if spark else []) == 35  # the last rule counts once for each of three fields


def test_page_url_and_duplicates(spark):
    rows = validate.check(frame(spark, [item(1), item(1), item(2, page_url="nothing")])).collect()
    assert sorted(r["problem"].split("_of_")[0] for r in rows) == ["duplicate_id", "page_url_web"]


def test_absent_keys(spark, tmp_path):
    whole = item(1)
    less = {k: v for k, v in item(2).items() if k not in ("image_coord_space", "observed_alt", "image_svg")}
    (tmp_path / "c.jsonl").write_text(json.dumps(whole) + "\n\n{broken\n" + json.dumps(less) + "\n[1]\n")
    rows, errors = jsonl.read(spark, str(tmp_path / "c.jsonl"), ITEM)
    assert sorted(r["line"] for r in errors.collect()) == [3, 5]
    assert {(r["line"], r["problem"]) for r in validate.check(rows).collect()} == {(4, "coord_space_form"), (4, "observed_alt_present"), (4, "image_svg_unneeded")}
    assert jsonl.read(spark, str(tmp_path / "none.jsonl"), ITEM)[0].count() == 0
    with pytest.raises(ValueError, match="c.jsonl:3"):
        jsonl.read_strict(spark, str(tmp_path / "c.jsonl"), ITEM)
    assert jsonl.read_lenient(spark, str(tmp_path / "c.jsonl"), ITEM).where("id is not null").count() == 2
    assert jsonl.read_first(spark, [str(tmp_path / "none"), str(tmp_path / "c.jsonl")], ITEM).count() >= 2


def test_coverage(spark):
    items = [item(k, page_url="https://p.org/", domain="p.org", sector="blogs" if k < 3 else "docs") for k in range(70)]
    got = {(r["kind"], r["value"]): (r["n"], r["bound"]) for r in validate.coverage(frame(spark, items)).collect()}
    assert got["sector_short", "news"] == (0, 20) and got["sector_over", "docs"] == (67, 63) and got["sector_unknown", "blogs"] == (3, None)
    assert got["domain_over", "p.org"] == (70, 13) and got["page_url_over", "https://p.org/"] == (70, 2) and ("subtype_short", "linked-standalone-logo") not in got
    out = json.loads(validate.report(frame(spark, items)).first()["report"])
    assert out["caps"]["perPage"] == 2 and out["by"]["sector"] == {"blogs": 3, "docs": 67} and out["problems"] == 0


def verdicts(spark, rows):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows, 1)], "item_id string, verdict string, alt_quality string, reason string, subtype string, line int")


WHY = "  a reason of enough characters  "


def test_review(spark):
    corpus = frame(spark, [item(1, image_file="f"), item(2, image_file="f"), item(3), item(4, **READY)])
    good = verdicts(spark, [("fi-0001", "keep", "good", WHY, None), ("fi-0002", "drop", "wrong", WHY, "standalone-navigational-link")])
    after, problems = review.apply(corpus, good)
    assert problems.isEmpty()
    got = {r["id"]: (r["status"], r["review_reason"], r["subtype"], r["category"]) for r in after.collect()}
    assert got["fi-0001"][:2] == ("ready", WHY.strip()) and got["fi-0002"] == ("dropped", WHY.strip(), "standalone-navigational-link", 1) and got["fi-0003"][0] == "unreviewed"
    assert {r["status"]: r["n"] for r in review.counts(corpus, after).collect()} == {"ready": 1, "dropped": 1}
    bad = [
        (" ", "keep", "good", WHY, None), ("fi-0001", "keep", "good", WHY, None), ("fi-0001", "drop", "weak", WHY, None), ("fi-9999", "keep", "x", "", None), ("fi-0004", "drop", "weak", WHY, None),
        ("fi-0002", "maybe", "meh", "short", "constructor"), ("fi-0003", "keep", "weak", WHY, None),
    ]
    after, problems = review.apply(corpus, verdicts(spark, bad))
    assert sorted((r["line"], r["problem"]) for r in problems.collect()) == [
        (1, "item_id_blank"), (3, "repeated_in_batch"), (4, "not_in_corpus"), (5, "already_decided"), (6, "alt_quality_value"), (6, "reason_short"), (6, "subtype_value"), (6, "verdict_value"),
        (7, "keep_not_good"), (7, "keep_without_image"),
    ]
    assert after.where("status = 'unreviewed'").count() == 3
    batch = review.batch_input(corpus, 2)
    assert batch.columns[:14][0] == "item_id" and batch.columns[12:14] == ["proposed_category", "proposed_subtype"] and batch.count() == 2


PNG = b"\x89PNG data"


def test_archive(spark):
    url = "data:image/png;base64," + base64.b64encode(PNG).decode()
    items = [
        item(1, image_url=url), item(2, image_url="https://h/a.png"), item(3, image_url="https://h/soft"), item(4, **SVG), item(5, **SVG, status="dropped"), item(6, implementation="inline-svg", image_url=None),
        item(7, image_url="https://h/a.png") | {"id": "bad"}, item(8), item(9, image_url="data:,%zz"), item(10, **READY),
    ]

    def get(u):
        return {"body": PNG, "content_type": "image/png", "url": u} if u.endswith("a.png") else {"body": b"<html>", "content_type": "text/html", "url": u}

    present = spark.createDataFrame([("fi-0008.gif", "b" * 64), ("fi-0008.png", "c" * 64)], "name string, sha256 string")
    got = {r["id"]: r for r in archive.archive(frame(spark, items), present, get, 0).collect()}
    assert set(got) == {"fi-0001", "fi-0002", "fi-0003", "fi-0004", "fi-0006", "bad", "fi-0008", "fi-0009"}
    import hashlib

    assert got["fi-0001"]["image_sha256"] == hashlib.sha256(PNG).hexdigest() and got["fi-0002"]["image_file"] == "pool/images/fi-0002.png"
    assert got["fi-0004"]["content"].decode() == SVG["image_svg"] and got["fi-0008"]["image_file"] == "pool/images/fi-0008.gif"
    assert all(got[k]["error"] for k in ("fi-0003", "fi-0006", "bad", "fi-0009"))
    assert archive.merge(frame(spark, items), archive.archive(frame(spark, items), present, get, 0)).where("image_file is not null").count() == 5
    assert archive.archive(frame(spark, items), present, get, 0, dry_run=True).where("content is not null").isEmpty()


def test_cleanup(spark):
    files = spark.createDataFrame([(n,) for n in ("fi-0001.png", "fi-0002.png", "fi-0003.png", "fi-0004.png", "fi-0005.png", "x.png")], "name string")
    corpus = frame(spark, [item(1, **READY), item(2, status="dropped", image_file="pool/images/fi-0002.png"), item(3, image_file="pool/images/fi-0003.png"), item(9, **READY | {"image_file": "pool/images/fi-0009.png"})])
    listed = frame(spark, [item(4), item(2)])
    plan = {r["name"]: r["class"] for r in archive.cleanup_plan(files, corpus, listed).collect()}
    assert plan == {"fi-0001.png": "keep", "fi-0002.png": "dropped", "fi-0003.png": "keep", "fi-0004.png": "unselected", "fi-0005.png": "orphaned", "x.png": "orphaned"}
    rows = archive.cleanup_plan(files, corpus, listed)
    assert archive.removals(rows).count() == 3 and archive.removals(rows, True).count() == 4
    assert [r["id"] for r in archive.stranded(corpus, files).collect()] == ["fi-0009"]
    log = spark.createDataFrame([("x.png", "old")], "name string, reason string")
    assert archive.log_entries(archive.removals(rows), log).count() == 2


def test_export(spark):
    items = frame(spark, [item(1, **READY, image_svg=None), item(2, **READY | {"alt_quality": "weak"}), item(3)])
    out = export.export(items)
    assert len(out.columns) == 17 and [r["id"] for r in out.collect()] == ["fi-0001"]
    assert export.sizes(items).first().asDict() == {"unreviewed": 1, "ready": 2, "dropped": 0, "held": 1}
    assert export.missing(items, spark.createDataFrame([("fi-0001.png",)], "name string")).isEmpty() and export.pages(items) == 1


def test_region_and_session(spark):
    html = '<area shape="rect" coords="{}">'
    d = spark.createDataFrame([("area", html.format(c)) for c in (" 5,1,2,3", "1,x,2,3", "1,2")] + [("link", html.format("1,2,3,4"))], "role string, html string")
    got = [r["r"] for r in d.select(region.parse_region(F.col("role"), F.col("html"), F.lit("30x30")).alias("r")).collect()]
    assert [g and list(g["coords"]) for g in got] == [[0, 5, 1, 2, 3], [1, 2, 3], None, None]
    note = d.limit(1).select(region.region_note(region.region_shape(region.parse_region(F.col("role"), F.col("html"), F.lit("30x30"))), F.lit(30.0), F.lit(30.0)).alias("n")).first()["n"]
    assert note == "outlined rect, top left of the map: x 0 to 1, y 2 to 5 of 30 by 30"
    shown = {r["id"]: r for r in session.shown(frame(spark, [item(1), item(2, accessible_name="", accessible_name_source="?", observed_alt=None), item(3, observed_alt="")])).collect()}
    assert shown["fi-0001"]["source"] == "the image's alt attribute" and shown["fi-0002"]["announced"] == "" and shown["fi-0002"]["source"] == "text in the markup"
    assert shown["fi-0002"]["alt"].startswith("(no alt") and "deliberately" in shown["fi-0003"]["alt"]
    events = spark.createDataFrame([("s", "1", "accepted", None, 1), ("s", "1", "rejected", "w", 2), ("s", "2", "accepted", None, 3)], "session_id string, id string, status string, reason string, t int").withColumn("timestamp", F.timestamp_seconds("t"))
    r = session.results(events, 8).first()
    assert (r["reviewed"], r["accepted"], r["rejected"], r["percent"]) == (2, 1, 1, 25)


def test_stages(spark, tmp_path):
    folder, corpus, listed, log, out = (str(tmp_path / n) for n in ("images", "corpus", "list", "log", "out"))
    url = "data:image/png;base64," + base64.b64encode(PNG).decode()
    pool_path = str(tmp_path / "pool")
    sinks.append_jsonl(frame(spark, [item(k, image_url=url, element_role="link" if k % 2 else "button") for k in range(1, 5)]), pool_path)
    assert stages.shortlist(spark, pool_path, corpus, listed, dry_run=True) == 0 and not jsonl.exists(spark, listed)
    assert stages.shortlist(spark, pool_path, corpus, listed) == 0
    (tmp_path / "images").mkdir()
    assert stages.archive(spark, listed, folder) == 0
    assert stages.verify(spark, listed, folder, log) == 0
    assert stages.select(spark, listed, corpus) == 0  # equal bytes in two roles: two stay
    items = jsonl.read_strict(spark, corpus, ITEM)
    assert items.count() == 2
    (tmp_path / "v.jsonl").write_text(json.dumps({"item_id": "fi-0001", "verdict": "keep", "alt_quality": "good", "reason": WHY, "subtype": None}) + "\n")
    assert stages.apply_review(spark, corpus, str(tmp_path / "v.jsonl")) == 0 and stages.apply_review(spark, corpus, str(tmp_path / "v.jsonl")) == 2
    assert stages.check(spark, corpus) == 0 and stages.export(spark, corpus, folder, out) == 0
    assert spark.read.json(out).first()["id"] == "fi-0001"
    assert stages.cleanup(spark, folder, corpus, listed, log) == 1 and stages.cleanup(spark, folder, corpus, listed, log, drop_unselected=True, apply=True) == 0
    assert sorted(p.name for p in (tmp_path / "images").glob("*.png")) == ["fi-0001.png", "fi-0002.png"]
    assert stages.cleanup(spark, folder, corpus, str(tmp_path / "none"), log) == 2


def test_images_follow_redirects(spark):
    from marlstone.sources import fetch

    hops = {"https://a/1": {"redirect": "https://b/2"}, "https://b/2": {"body": PNG, "content_type": "image/png", "url": "https://b/2"}, "https://l/1": {"redirect": "https://l/1"}}
    get = lambda url: hops.get(url, {"error": "HTTP 404"})
    assert fetch.image_bytes("https://a/1", get) == (PNG, "image/png", None)
    assert fetch.image_bytes("https://l/1", get)[2] == "redirect loop" and fetch.image_bytes("https://n/1", get)[2] == "HTTP 404"


def test_robots_rules_are_asked_for_politely(spark, monkeypatch):
    """Rules behind redirects count, unreadable ones allow; the request for them keeps its distance, too."""
    import time

    from marlstone.sources import fetch

    asked = []

    def get(url):
        asked.append((url, time.monotonic()))
        if url == "http://r/robots.txt":
            return {"redirect": "http://r/rules"}
        if url == "http://r/rules":
            return {"body": b"User-agent: *\nDisallow: /no", "content_type": "text/plain", "url": url}
        if url.endswith("robots.txt"):
            return {"error": "HTTP 500"}
        return {"body": b"<p>", "content_type": "text/html", "url": url}

    polite = fetch.politely(get, 0.2)
    followed = fetch.followed(polite)
    assert followed("http://r/robots.txt")["body"].startswith(b"User") and followed("http://x/robots.txt")["error"] == "HTTP 500"
    assert followed("http://r/p")["body"] == b"<p>"
    times = [t for u, t in asked if u.startswith("http://r/")]
    assert len(times) == 3 and all(b - a >= 0.19 for a, b in zip(times, times[1:], strict=False))


def test_overwrite_survives_a_crash(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_jsonl(frame(spark, [item(1)]), path)
    sinks.overwrite_jsonl(frame(spark, [item(2)]), path)
    assert [r["id"] for r in spark.read.json(path).collect()] == ["fi-0002"] and not jsonl.exists(spark, path + ".old") and not jsonl.exists(spark, path + ".new")
    (tmp_path / "t").rename(tmp_path / "t.old")  # between the two renames
    sinks.recover(spark, path)
    assert [r["id"] for r in spark.read.json(path).collect()] == ["fi-0002"]


def test_lines_of_large_files(spark, tmp_path):
    """Files are read in blocks; numbers go on over them, whatever the line ends."""
    text = "".join(f"line {k} " + "x" * (k % 50) + ("\r\n" if k % 7 == 0 else "\n") + ("\n" if k % 11 == 0 else "") for k in range(5000))
    (tmp_path / "a.txt").write_text(text, newline="")
    (tmp_path / "b.txt").write_text("only\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {(r["file"].rsplit("/", 1)[-1], r["line"]): r["value"] for r in jsonl.lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = text.replace("\r\n", "\n").split("\n")[:-1]
    assert got == {**{("a.txt", k + 1): v for k, v in enumerate(want)}, ("b.txt", 1): "only"}


def test_a_whole_run(spark, tmp_path):
    """From seeds to the export, with pages and images from a table and a reviewer that writes verdicts."""
    from marlstone.sources import text

    where = {k: str(tmp_path / k) for k in ("seeds", "pool", "shortlist", "corpus", "images", "log", "reviews", "out")}
    for k in ("seeds", "images", "reviews"):
        (tmp_path / k).mkdir()
    (tmp_path / "seeds" / "docs.txt").write_text("http://a.org/\nhttp://b.org/\n")
    html = "".join(f'<a href="/p{k}"><img src="http://img/{k}.png" alt="Name {k}"></a>' for k in range(3))
    fetcher = lambda urls: urls.select("url", F.col("url").alias("final_url"), F.lit(html).alias("html"), F.lit(None).cast("string").alias("error"))
    get = lambda url: {"body": PNG + url.encode(), "content_type": "image/png", "url": url} if "/2" not in url else {"redirect": "http://img/9.png"}
    said: list[str] = []

    def reviewer(prompt_file, batch):
        assert sinks.size(spark, prompt_file) > 100
        rows = [json.loads(x) for f in (tmp_path / "reviews" / f"batch-{batch:02d}-input.jsonl").glob("part*") for x in f.read_text().splitlines()]
        lines = [{"item_id": r["item_id"], "verdict": "keep", "alt_quality": "good", "reason": WHY, "subtype": None} for r in rows]
        (tmp_path / "reviews" / f"batch-{batch:02d}.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n")
        return True

    s = Settings(pages_per_host=2, follow=1, batch_size=3, host_delay_s=0.0)
    # Without a reviewer the run ends with a frozen batch and nothing to export.
    assert stages.run(spark, where, s, get, fetcher, say=said.append) == 1 and text.pending_batch(text.batches(spark, where["reviews"] + "/batch-*")) == 1
    assert any(x.startswith("candidates: ") for x in said) and any("characters" in x for x in said)
    assert stages.review_batch(spark, where["corpus"], where["reviews"], lambda *_: False, s, said.append) == 2
    assert stages.review_batch(spark, where["corpus"], where["reviews"], lambda *_: True, s, said.append) == 2  # nothing was written
    assert stages.run(spark, where, s, get, fetcher, reviewer, said.append) == 0
    assert spark.read.json(where["out"]).count() == 2  # two of each page are listed, and bytes that are there already are not taken twice
    assert stages.verify(spark, where["corpus"], where["images"], where["log"], said.append) == 0
    assert stages.check(spark, where["corpus"], s, as_json=True, say=said.append) == 0 and json.loads(said[-1])["problems"] == 0
    assert stages.harvest(spark, where["seeds"], where["pool"], settings=Settings(pages_per_host=0), say=said.append) == 3
    with pytest.raises(SystemExit) as e:
        stages.main(["harvest", "--pages", "0"])
    assert e.value.code == 3


def test_places_go_on_from_file_to_file(spark, tmp_path):
    """A table of several files, then rows that are appended: `pos` is one order over all of them."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType, StructField, StructType

    from marlstone.sources import jsonl, sinks

    path, schema = str(tmp_path / "t"), StructType([StructField("k", LongType())])
    rows = lambda a, b: spark.range(a, b, 1, 3).select((a + b - 1 - F.col("id")).alias("k"), F.col("id").alias("pos"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        sinks.overwrite_jsonl(rows(0, 100), path)
        sinks.append_jsonl(rows(100, 150), path)
        sinks.append_jsonl(rows(150, 160), path)
    finally:
        spark.conf.unset(coalesce)
    got = jsonl.read_strict(spark, path, schema).orderBy("pos").collect()
    assert jsonl.lines(spark, path).select("file").distinct().count() > 5
    assert [r["pos"] for r in got] == list(range(1, 161))
    assert [r["k"] for r in got] == [*range(99, -1, -1), *range(149, 99, -1), *range(159, 149, -1)]


def test_urls_of_one_host_are_dealt_where_no_distance_is_kept(spark):
    from pyspark.sql import functions as F

    from marlstone.sources import fetch

    urls = spark.range(600).select(F.concat(F.lit("http://h.org/"), "id").alias("url"))
    tasks = lambda delay: fetch.fetch(urls, lambda u: {"body": u.encode(), "url": u}, delay).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks(0.0)) > 4 and sum(r["count"] for r in tasks(0.0)) == 600
    assert [r["count"] for r in tasks(1e-9)] == [600]
    assert [len(x) for x in fetch.portions(iter([{"a": "xx"}] * 5), ["a"], most=3)] == [3, 2] and [len(x) for x in fetch.portions(iter([{"a": "xx"}] * 5), ["a"], size=4)] == [2, 2, 1]


def test_polite_and_archived_urls_are_dealt(spark):
    """Small urls had all come to one task."""
    from pyspark.sql import functions as F

    from marlstone.plans import stages
    from marlstone.plans.schemas import Settings

    answer = lambda u: {"body": b"\x89PNG\r\n\x1a\n", "content_type": "image/png", "url": u}
    urls = spark.range(400).select("id", F.format_string("http://h%d.org/%d.png", F.col("id") % 2, "id").alias("url"))
    tasks = lambda df: len(df.groupBy(F.spark_partition_id()).count().collect())
    assert tasks(stages.polite_fetcher(spark, answer, Settings(host_delay_s=0.0))(urls)) > 2
    items = urls.select(F.format_string("fi-%04d", "id").alias("id"), F.lit("unreviewed").alias("status"), F.lit(None).cast("string").alias("image_file"), F.lit("img").alias("implementation"), F.col("url").alias("image_url"), F.lit(None).cast("string").alias("image_svg"))
    none = spark.createDataFrame([], "name string, sha256 string")
    got = archive.archive(items, none, answer, 0.0)
    assert got.where("note = 'fetched'").count() == 400 and tasks(got) > 4


def test_many_files_are_read_by_a_given_number_of_tasks(spark, tmp_path, monkeypatch):
    """What was there when it was listed, but for hidden files and folders; hashes by chunks are those of whole files."""
    import hashlib

    from marlstone.sources import blobs

    monkeypatch.setattr(blobs, "CHUNK", 3)
    for n in (400, 800):
        for k in range(n):
            (tmp_path / f"a {k}%.txt").write_bytes(b"x" * (k % 10))
        (tmp_path / ".dot").write_bytes(b"x")
        (tmp_path / "_under").write_bytes(b"x")
        (tmp_path / "README.md").write_bytes(b"x")
        (tmp_path / "sub").mkdir(exist_ok=True)
        files = blobs.contents(spark, str(tmp_path))
        assert files.rdd.getNumPartitions() == 16
        rows = files.collect()
        assert sorted((r["name"], r["size"], r["sha256"], bytes(r["content"])) for r in rows) == sorted((f"a {k}%.txt", k % 10, hashlib.sha256(b"x" * (k % 10)).hexdigest(), b"x" * (k % 10)) for k in range(n))
    listed = blobs.names(spark, str(tmp_path))
    assert sorted(map(tuple, blobs.contents(spark, str(tmp_path), content=False).collect())) == sorted((r["name"], r["size"], r["sha256"]) for r in rows)
    (tmp_path / "a 1%.txt").unlink()
    assert listed.count() == 800


def test_sessions_ask_the_state_store_no_more_than_they_must():
    from pyspark.sql import Row

    from marlstone.streaming import stateful

    calls, kept = [], {}

    class Value:
        exists = lambda self: "v" in kept
        get = lambda self: kept["v"]
        update = lambda self, v: calls.append("update") or kept.update(v=v)

    class Handle:
        getValueState = lambda self, *a: Value()
        listTimers = lambda self: calls.append("list") or [7]
        deleteTimer = lambda self, t: calls.append("delete")
        registerTimer = lambda self, t: calls.append(t)

    s = stateful.Session(1, 1000)
    s.init(Handle())
    row = lambda n, action, status=None: Row(n=n, action=action, status=status, reason=" why ", at_us=n * 1_000_000)
    go = lambda *rows: [tuple(r) for r in s.handleInputRows(("a",), iter(rows), None)]
    assert go(row(1, "choose", "accepted"), row(2, "submit")) == [] and calls == []
    assert go(row(5, "submit"), row(4, "choose", "accepted"), row(3, "start")) == [("a", "started", 0, None, None, 3_000_000), ("a", "decided", 1, "accepted", "why", 5_000_000)]
    assert calls == ["update", 6000]
    assert go(row(6, "cancel")) == [] and calls[2:] == ["list", "delete", 7000]
    assert go(row(7, "end")) == [("a", "ended", 1, None, None, 7_000_000)] and calls[5:] == ["update", "list", "delete"]
    assert go(row(8, "end")) == [] and len(calls) == 8


def test_the_choosing_task_keeps_rows_in_arrow():
    """Where all pages are full, every row is visited: few bytes a row, numbers for values, nulls among them."""
    import tracemalloc

    import pyarrow as pa

    from marlstone.operators import select as S

    n = 30_000
    none = lambda t: pa.nulls(n, t)
    rows = {"at": pa.array(range(n)), "pos": pa.array(range(n - 1, -1, -1)), "cut": pa.array([False] * n), "page_url": pa.array([None if k % 2 else "p" for k in range(n)]), "domain": pa.array(["d"] * n), "sector": pa.array([f"s{k % 3}" for k in range(n)]), "subtype": none(pa.string()), "image_sha256": pa.array([f"{k:064d}" for k in range(n)]), "element_role": none(pa.string()), "field": none(pa.string()), "key": none(pa.string()), "role": none(pa.string()), "n": none(pa.int64())}
    facts = pa.table({c: pa.nulls(3, v.type) for c, v in rows.items()} | {"field": ["page_url", "page_url", "image"], "key": pa.array([None, "p", f"{7:064d}"]), "role": pa.nulls(3, pa.string()), "n": [1, 2, 1]})
    table = pa.concat_tables([pa.table(rows), facts])
    tracemalloc.start()
    out = S._choice(S.Caps(add=40, goal=250), 0)(table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = out.to_pylist()
    assert [r for r in got if r["outcome"] == "chosen"] == [{"at": n - 1, "outcome": "chosen", "chosen_seq": 0}]
    assert next(r["outcome"] for r in got if r["at"] == 7) == "duplicateImage" and sum(r["outcome"] == "pageCap" for r in got) == n - 2
    assert most < 200 * n
