"""The stages over files, with exit codes: 0 done, 1 nothing to do, 2 refused, 3 arguments that make no sense.

Every stage says what it did through `say` (print): small aggregates and the first lines of what is wrong.
"""

from __future__ import annotations

import argparse
import shlex
import subprocess
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.columns import item_number
from marlstone.functions.url import origin_of, robots_path
from marlstone.operators import aggregates, extract, pool, review, robots, validate
from marlstone.operators import archive as A
from marlstone.operators import crawl as C
from marlstone.operators import export as E
from marlstone.operators import select as S
from marlstone.plans.schemas import ITEM, VERDICT, Settings
from marlstone.sources import blobs, fetch, jsonl, sinks, text
from marlstone.sources.scratch import clear, keep

DONE, NOTHING, REFUSED, USAGE = 0, 1, 2, 3
#: Lines of a report that are printed.
MOST_PROBLEMS, MOST_REMOVED = 40, 12
Say = Callable[[str], None]


def _items(spark: SparkSession, path: str) -> DataFrame:
    return jsonl.read_strict(spark, path, ITEM) if jsonl.exists(spark, path) else jsonl.read(spark, path, ITEM)[0]


def _first(df: DataFrame, line: str, most: int, say: Say) -> int:
    """Prints the first `most` rows by `line` (a format of their columns), and how many more there are; the number of all."""
    n = df.count()
    for r in df.limit(most).collect():
        say("  " + line.format(**r.asDict()))
    if n > most:
        say(f"  and {n - most} more")
    return n


def _tally(df: DataFrame, field: str, say: Say) -> None:
    for line in aggregates.lines(aggregates.tally(df, field), field):
        say(line)


def polite_fetcher(spark: SparkSession, get: fetch.Getter = fetch.http_get, settings: Settings = Settings()) -> Callable[[DataFrame], DataFrame]:
    """Robots rules first (redirects are followed; an unreadable file is permissive), then pages, hop by hop. Requests
    to one origin, that for its rules included, keep their distance."""

    def run(batches):
        polite, rules = fetch.politely(get, settings.host_delay_s), {}

        def allowed(url: str):
            origin = origin_of(url)
            if origin is None:
                return "unusable url"
            if origin not in rules:
                got = fetch.followed(polite, settings.max_redirects)(f"{origin}/robots.txt")
                rules[origin] = robots.rules_for("" if "error" in got else got["body"].decode("utf-8", "replace"))
            return robots.allows(rules[origin], robots_path(url)) or "disallowed by robots.txt"

        def page(url: str) -> dict:
            got = fetch.follow_redirects(url, allowed, lambda u: fetch.as_page(polite(u), settings.page_bytes), settings.max_redirects)
            return {"url": url, "final_url": got.get("url") or got["chain"][-1], "html": got.get("html"), "error": got.get("error")}

        yield from fetch.portions((page(url) for batch in batches for url in batch["url"]), ["url", "final_url", "html", "error"])

    # Without a distance to keep, an origin goes to several tasks, each of which asks for its rules once.
    origin = robots.origin(F.col("url"))
    return lambda urls: fetch.dealt(urls.select("url"), origin, F.struct(origin, F.pmod(F.xxhash64("url"), F.lit(8))), settings.host_delay_s).mapInPandas(run, "url string, final_url string, html string, error string")


def harvest(spark, seeds: str, pool_path: str, sector: str | None = None, retrieved: str | None = None, settings: Settings = Settings(), fetcher=None, dry_run: bool = False, say: Say = print) -> int:
    if settings.pages_per_host < 1 or settings.follow < 0:
        say("a crawl needs one page a host at least, and no fewer than 0 links to follow")
        return USAGE
    rows, errors = text.seeds(spark, seeds, sector)
    _first(errors.orderBy("file", "line"), "{file}:{line}: not a web address: {url}", MOST_PROBLEMS, say)
    if rows.isEmpty():
        say("no seeds: write urls into SECTOR.txt, one to a line")
        return REFUSED
    try:
        have = _items(spark, pool_path)
    except ValueError as e:
        say(f"the pool can't be read: {e}")
        return REFUSED
    visits, pages = C.crawl(rows, fetcher or polite_fetcher(spark, settings=settings), settings.pages_per_host, settings.follow)
    day = retrieved or spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd")).first()[0]
    seen = Observation("pages")
    watched = pages.observe(seen, F.count("*").alias("pages"), F.sum(F.length("html")).alias("characters"))
    images = keep(extract.judged(watched.select("page_id", "url", "html"), F.lit(None).cast("string"), day), "judged")
    found = images.where("skip_reason is null").drop("sector").join(pages.select("page_id", "sector"), "page_id").select("page_id", "pos", *ITEM.fieldNames())
    new = keep(pool.add(found, have, ["page_id", "pos"]).withColumn("pos", item_number(F.col("id"))), "new")
    out, n_found, n_new = C.outcomes(visits).first(), found.count(), new.count()
    say(f"pages: {out['pages']} read ({seen.get['characters'] or 0} characters), {out['failed']} failed, {out['disallowed']} not allowed")
    say(f"candidates: {n_found} found, {n_found - n_new} of them known, {n_new} new")
    for r in extract.skips(images).collect():
        say(f"  {r['n']:>6}  left out, {r['skip_reason']}")
    if not n_new:
        return NOTHING
    sinks.append_jsonl(new, pool_path, dry_run)
    return DONE


def shortlist(spark, pool_path: str, corpus_path: str, list_path: str, settings: Settings = Settings(), dry_run: bool = False, say: Say = print) -> int:
    items = _items(spark, pool_path)
    out = S.shortlist(items, _items(spark, corpus_path), _items(spark, list_path), settings.goal * settings.shortlist_times, settings.goal, settings.shortlist_headroom)
    return _take(items, out, list_path, dry_run, say)


def select(spark, source: str, corpus_path: str, settings: Settings = Settings(), dry_run: bool = False, say: Say = print) -> int:
    if settings.add < 1 or settings.goal < 1:
        say("add and goal must be 1 at least")
        return REFUSED
    items = _items(spark, source)
    return _take(items, S.select(items, _items(spark, corpus_path), S.Caps(settings.add, settings.goal)), corpus_path, dry_run, say)


def _take(items: DataFrame, outcome: DataFrame, path: str, dry_run: bool, say: Say) -> int:
    took = keep(S.chosen(items, outcome).drop("pos").withColumnRenamed("chosen_seq", "pos"), "took")
    _tally(outcome, "outcome", say)
    if took.isEmpty():
        return NOTHING
    for field in ("sector", "subtype"):
        say(f"chosen by {field}:")
        _tally(took, field, say)
    sinks.append_jsonl(took, path, dry_run)
    return DONE


def archive(spark, items_path: str, folder: str, get: fetch.Getter = fetch.http_get, settings: Settings = Settings(), dry_run: bool = False, say: Say = print) -> int:
    items = _items(spark, items_path)
    present = blobs.contents(spark, folder, content=False).select("name", "sha256") if jsonl.exists(spark, f"{folder}/*") else spark.createDataFrame([], "name string, sha256 string")
    got = keep(A.archive(items, present, get, settings.host_delay_s, dry_run), "archived")
    failed = got.where("error is not null")
    n_failed = _first(failed.orderBy("id").select("id", "error"), "{id}: {error}", MOST_PROBLEMS, say)
    _tally(got.where("note is not null"), "note", say)
    if got.where("error is null").isEmpty():
        return NOTHING if got.isEmpty() else REFUSED
    sinks.write_files(got, folder, dry_run)
    sinks.overwrite_jsonl(A.merge(items, got), items_path, dry_run)
    return NOTHING if n_failed else DONE


def verify(spark, items_path: str, folder: str, log_path: str, say: Say = print) -> int:
    log = text.read_removal_log(spark, log_path) if jsonl.exists(spark, log_path) else spark.createDataFrame([], "name string, reason string")
    found = keep(A.verify(_items(spark, items_path), blobs.contents(spark, folder, content=False), log), "verified")
    _tally(found, "finding", say)
    wrong = found.where("finding in ('missing', 'noHash', 'hashDiffers')").orderBy("id")
    n = _first(wrong, "{id}: {name}: {finding}", MOST_PROBLEMS, say)
    _first(found.where("finding = 'removed'").orderBy("name"), "{name} was removed", MOST_REMOVED, say)
    return REFUSED if n else DONE


def _batch(reviews: str, n: int, kind: str = ".jsonl") -> str:
    return f"{reviews.rstrip('/')}/batch-{n:02d}{kind}"


def batch_input(spark, corpus_path: str, reviews: str, settings: Settings = Settings(), dry_run: bool = False, say: Say = print) -> int:
    """Freezes the first unreviewed items as the input of the batch that waits for verdicts (or the next one), and
    writes what a reviewer is asked."""
    known = text.batches(spark, f"{reviews.rstrip('/')}/batch-*")
    n = text.pending_batch(known) or text.next_batch(known)
    rows = keep(review.batch_input(_items(spark, corpus_path), settings.batch_size), "batch")
    count = rows.count()
    if not count:
        say("nothing waits for a review")
        return NOTHING
    sinks.overwrite_jsonl(rows.coalesce(1), _batch(reviews, n, "-input.jsonl"), dry_run)
    sinks.write_text(spark, _batch(reviews, n, "-prompt.md"), prompt(n, count, reviews), dry_run)
    say(f"batch {n:02d}: {count} items in {_batch(reviews, n, '-input.jsonl')}")
    return DONE


def prompt(n: int, count: int, reviews: str) -> str:
    return (
        f"# Review batch {n:02d}\n\n"
        f"Items to judge: {count}, one to a line, in `{_batch(reviews, n, '-input.jsonl')}`.\n"
        f"Write a verdict for each into `{_batch(reviews, n)}`: item_id, verdict (keep or drop), alt_quality (good, weak or wrong), "
        f"a reason of {review.LEAST_REASON} characters at least, and subtype where the proposed one is not right.\n"
        "Judge by the archived image and the markup in the record; pages may have changed since.\n"
    )


def apply_review(spark, corpus_path: str, verdict_path: str, dry_run: bool = False, say: Say = print) -> int:
    verdicts = jsonl.read_strict(spark, verdict_path, VERDICT).withColumnRenamed("pos", "line")
    before = _items(spark, corpus_path)
    after, problems = review.apply(before, verdicts)
    if _first(problems.orderBy("line"), "line {line}, {item_id}: {problem}", MOST_PROBLEMS, say):
        say("nothing was applied")
        return REFUSED
    for r in review.counts(before, after).orderBy("status").collect():
        say(f"  {r['n']:>6}  {r['status']}")
    sinks.overwrite_jsonl(after, corpus_path, dry_run)
    return DONE


def apply_batch(spark, corpus_path: str, reviews: str, n: int | None = None, dry_run: bool = False, say: Say = print) -> int:
    """Applies batch `n`, or the last that was frozen. What should be there is looked at, not what its writer said."""
    n = n or text.last_input(text.batches(spark, f"{reviews.rstrip('/')}/batch-*"))
    if not n:
        say("no batch was given to a reviewer")
        return NOTHING
    if not sinks.size(spark, _batch(reviews, n)):
        say(f"{_batch(reviews, n)} has not been written, or is empty")
        return REFUSED
    return apply_review(spark, corpus_path, _batch(reviews, n), dry_run, say)


def review_batch(spark, corpus_path: str, reviews: str, reviewer: Callable[[str, int], bool], settings: Settings = Settings(), say: Say = print) -> int:
    """A batch from end to end: frozen, given to `reviewer` (path of the prompt, number) -> success, checked, applied."""
    if (code := batch_input(spark, corpus_path, reviews, settings, say=say)) != DONE:
        return code
    n = text.pending_batch(text.batches(spark, f"{reviews.rstrip('/')}/batch-*"))
    if not reviewer(_batch(reviews, n, "-prompt.md"), n):
        say(f"the reviewer failed on batch {n:02d}")
        return REFUSED
    if (code := apply_batch(spark, corpus_path, reviews, n, say=say)) != DONE:
        return code
    return check(spark, corpus_path, settings, say=say)


def command_reviewer(command: str) -> Callable[[str, int], bool]:
    """A reviewer that is a command; `{prompt_file}` and `{batch}` in it are filled in."""

    def run(prompt_file: str, batch: int) -> bool:
        words = [w.replace("{prompt_file}", prompt_file).replace("{batch}", str(batch)) for w in shlex.split(command)]
        return subprocess.run(words, stdin=subprocess.DEVNULL).returncode == 0

    return run


def check(spark, corpus_path: str, settings: Settings = Settings(), quiet: bool = False, as_json: bool = False, status: str | None = None, say: Say = print) -> int:
    """Problems and coverage of a corpus (or pool); 2 where a record breaks a rule."""
    if not jsonl.exists(spark, corpus_path):
        say("there are no records yet")
        return NOTHING
    items = _items(spark, corpus_path)
    problems = keep(validate.check(items), "problems")
    if as_json:
        say(validate.report(items, settings).first()["report"])
        return DONE if problems.isEmpty() else REFUSED
    n = _first(problems.orderBy("line", "problem"), "line {line}, {id}: {problem}", MOST_PROBLEMS, say)
    if not quiet:
        sizes = E.sizes(items).first()
        say(f"records: {sizes['unreviewed']} unreviewed, {sizes['ready']} ready, {sizes['dropped']} dropped; goal {settings.goal}")
        for field in ("sector", "subtype"):
            say(f"by {field}:")
            _tally(items, field, say)
        _first(validate.coverage(items, settings, status).orderBy("kind", "value"), "{kind}: {value} has {n}, bound {bound}", MOST_PROBLEMS, say)
    return REFUSED if n else DONE


def export(spark, corpus_path: str, folder: str, out: str, dry_run: bool = False, say: Say = print) -> int:
    items = _items(spark, corpus_path)
    if _first(E.missing(items, blobs.names(spark, folder)).orderBy("id"), "{id}: {name} is not in the archive", MOST_PROBLEMS, say):
        return REFUSED
    rows = items.where(E.exportable())
    sizes = E.sizes(items).first()
    say(f"exported: {sizes['ready'] - sizes['held']} records of {E.pages(items)} pages; held back {sizes['held']}, unreviewed {sizes['unreviewed']}, dropped {sizes['dropped']}")
    if rows.isEmpty():
        return NOTHING
    sinks.overwrite_jsonl(E.export(items), out, dry_run)
    return DONE


def cleanup(spark, folder: str, corpus_path: str, list_path: str, log_path: str, drop_unselected: bool = False, apply: bool = False, say: Say = print) -> int:
    if not jsonl.exists(spark, list_path) and not drop_unselected:
        say("without a shortlist nothing tells what is unselected")
        return REFUSED
    corpus, files = _items(spark, corpus_path), blobs.names(spark, folder)
    plan = keep(A.cleanup_plan(files, corpus, _items(spark, list_path)), "plan")
    _tally(plan, "class", say)
    gone = A.removals(plan, drop_unselected)
    if gone.isEmpty():
        return NOTHING
    if apply:
        if _first(A.stranded(corpus, files).orderBy("id"), "{id} is ready, and {name} is not in the archive", MOST_PROBLEMS, say):
            return REFUSED
        there = jsonl.exists(spark, log_path)
        log = text.read_removal_log(spark, log_path) if there else spark.createDataFrame([], "name string, reason string")
        sinks.append_log(A.log_entries(gone, log), log_path, first=not there)
        sinks.delete_files(gone, folder, dry_run=False)
    return DONE


def run(spark, where: dict[str, str], settings: Settings = Settings(), get: fetch.Getter = fetch.http_get, fetcher=None, reviewer: Callable[[str, int], bool] | None = None, say: Say = print) -> int:
    """All stages in order, from seeds to the export: each must not refuse; that nothing was new stops none.

    `where` has the paths seeds, pool, shortlist, corpus, images, log, reviews and out. Without a reviewer the run ends
    with a frozen batch, and goes on from its verdicts the next time.
    """
    w = where
    steps: list[tuple[str, Callable[[], int]]] = [
        ("harvest", lambda: harvest(spark, w["seeds"], w["pool"], settings=settings, fetcher=fetcher, say=say)),
        ("shortlist", lambda: shortlist(spark, w["pool"], w["corpus"], w["shortlist"], settings, say=say)),
        ("archive", lambda: archive(spark, w["shortlist"], w["images"], get, settings, say=say)),
        ("verify", lambda: verify(spark, w["shortlist"], w["images"], w["log"], say)),
        ("select", lambda: select(spark, w["shortlist"], w["corpus"], settings, say=say)),
        ("validate", lambda: check(spark, w["corpus"], settings, quiet=True, say=say)),
    ]
    if reviewer:
        steps.append(("review", lambda: review_batch(spark, w["corpus"], w["reviews"], reviewer, settings, say)))
    else:
        steps.append(("batch-input", lambda: batch_input(spark, w["corpus"], w["reviews"], settings, say=say)))
    steps.append(("export", lambda: export(spark, w["corpus"], w["images"], w["out"], say=say)))
    code = NOTHING
    for name, step in steps:
        say(f"== {name}")
        code = step()
        if code >= REFUSED:
            return code
    return code


class _Parser(argparse.ArgumentParser):
    def error(self, message: str):
        self.print_usage(sys.stderr)
        self.exit(USAGE, f"{self.prog}: {message}\n")


def main(args: list[str]) -> int:
    p = _Parser(prog="marlstone")
    p.add_argument("stage", choices=("run", "harvest", "shortlist", "select", "archive", "verify", "batch-input", "next-batch", "review", "apply-review", "validate", "export", "cleanup"))
    for name, default in (("seeds", "seeds"), ("pool", "pool/candidates.jsonl"), ("shortlist", "pool/shortlist.jsonl"), ("corpus", "corpus/items.jsonl"), ("images", "pool/images"), ("log", "pool/images-removed.txt"), ("reviews", "review"), ("verdicts", None), ("out", "corpus/export.jsonl"), ("sector", None), ("reviewer", None), ("status", None)):
        p.add_argument(f"--{name}", default=default)
    for name, default in (("goal", 250), ("add", 60), ("pages", 12), ("follow", 8), ("batch", None)):
        p.add_argument(f"--{name}", type=int, default=default)
    for name in ("dry-run", "apply", "drop-unselected", "json", "quiet"):
        p.add_argument(f"--{name}", action="store_true")
    a = p.parse_args(args)
    if a.stage in ("harvest", "run") and (a.pages < 1 or a.follow < 0):
        p.error("--pages must be 1 at least, and --follow 0")
    if a.stage == "review" and not a.reviewer:
        p.error("a review needs the command of a --reviewer")
    s = Settings(goal=a.goal, add=a.add, pages_per_host=a.pages, follow=a.follow)
    spark = SparkSession.builder.appName(f"marlstone-{a.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for path in (a.pool, a.shortlist, a.corpus):
        sinks.recover(spark, path)
    source = a.shortlist if jsonl.exists(spark, a.shortlist) else a.pool
    reviewer = command_reviewer(a.reviewer) if a.reviewer else None

    def next_batch() -> int:
        print(text.next_batch(text.batches(spark, f"{a.reviews}/batch-*")))
        return DONE

    stages = {
        "run": lambda: run(spark, vars(a), s, reviewer=reviewer),
        "harvest": lambda: harvest(spark, a.seeds, a.pool, a.sector, settings=s, dry_run=a.dry_run),
        "shortlist": lambda: shortlist(spark, a.pool, a.corpus, a.shortlist, s, a.dry_run),
        "select": lambda: select(spark, source, a.corpus, s, a.dry_run),
        "archive": lambda: archive(spark, source, a.images, settings=s, dry_run=a.dry_run),
        "verify": lambda: verify(spark, a.corpus, a.images, a.log),
        "batch-input": lambda: batch_input(spark, a.corpus, a.reviews, s, a.dry_run),
        "next-batch": next_batch,
        "review": lambda: review_batch(spark, a.corpus, a.reviews, reviewer, s),
        "apply-review": lambda: apply_review(spark, a.corpus, a.verdicts, a.dry_run) if a.verdicts else apply_batch(spark, a.corpus, a.reviews, a.batch, a.dry_run),
        "validate": lambda: check(spark, a.corpus, s, a.quiet, a.json, a.status),
        "export": lambda: export(spark, a.corpus, a.images, a.out, a.dry_run),
        "cleanup": lambda: cleanup(spark, a.images, a.corpus, a.shortlist, a.log, a.drop_unselected, a.apply),
    }
    try:
        return stages[a.stage]()
    finally:
        clear(spark)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
