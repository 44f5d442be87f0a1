"""Archiving images, checking the archive against records, and planning what can be deleted."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.columns import basename, filled, stem
from marlstone.functions.media import MAX_BYTES, name_type
from marlstone.sources.fetch import Getter, dealt, image_bytes, politely, portions

FOLDER = "pool/images"
ARCHIVED = "id string, image_file string, image_sha256 string, content binary, error string, note string"


def needs_archive() -> Column:
    inline = F.col("implementation") == "inline-svg"
    return F.col("status").isin("unreviewed", "ready") & ~filled(F.col("image_file")) & (inline | filled(F.col("image_url")))


def archive(items: DataFrame, present: DataFrame, get: Getter, delay_s: float = 1.0, dry_run: bool = False) -> DataFrame:
    """ARCHIVED rows for the items that need a copy; `present` is (name, sha256) of the archive's files.

    In order: the id must be usable; a copy that is there is adopted; inline graphics are their own bytes; else the
    url is read. A failure is a row's own and stops no other. Where there is a distance to keep, urls of one host go to one task.
    """
    there = present.where(F.col("name").rlike(r"^fi-\d{4,}\.[a-z0-9]+$")).groupBy(stem(F.col("name")).alias("id")).agg(F.min_by(F.struct("name", "sha256"), "name").alias("copy"))
    todo = items.where(needs_archive()).join(there, "id", "left")
    usable, adopted, inline = F.col("id").rlike(r"^fi-\d{4,}$"), F.col("copy").isNotNull(), F.col("implementation") == "inline-svg"
    none = F.lit(None)
    row = lambda df, file, sha, content, error, note: df.select("id", file.cast("string").alias("image_file"), sha.cast("string").alias("image_sha256"), content.cast("binary").alias("content"), error.cast("string").alias("error"), note.cast("string").alias("note"))
    bad = row(todo.where(F.coalesce(~usable, F.lit(True))), none, none, none, F.lit("no usable id"), none)
    old = row(todo.where(usable & adopted), F.concat(F.lit(FOLDER + "/"), "copy.name"), F.col("copy.sha256"), none, none, F.lit("adopted"))
    own = todo.where(usable & ~adopted & inline)
    data = F.encode("image_svg", "UTF-8")
    drawn = row(own.where("image_svg is not null"), F.concat(F.lit(FOLDER + "/"), "id", F.lit(".svg")), F.sha2(data, 256), data, none, F.lit("inline"))
    blank = row(own.where("image_svg is null"), none, none, none, F.lit("no image_svg"), none)
    far = todo.where(usable & ~adopted & ~inline).select("id", "image_url")
    if dry_run:
        return bad.union(old).union(row(own.where("image_svg is not null"), none, none, none, none, F.lit("would write"))).union(blank).union(row(far, none, none, none, none, F.lit("would fetch")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        polite = politely(get, delay_s)

        def copy(id_: str, url: str) -> dict:
            data, kind, error = image_bytes(url, polite)
            if error is None and len(data) > MAX_BYTES:
                error = f"{len(data)} bytes, more than {MAX_BYTES}"
            ext = None
            if error is None:
                ext, error = name_type(url, kind, data)
            return {"id": id_, "name": ext and f"{FOLDER}/{id_}.{ext}", "content": data if error is None else None, "error": error}

        yield from portions((copy(*r) for b in batches for r in zip(b["id"], b["image_url"], strict=True)), ["id", "name", "content", "error"])

    host = F.regexp_extract("image_url", r"^([A-Za-z]+:(?://[^/?#]*)?)", 1)
    got = dealt(far, host, F.col("id"), delay_s).mapInPandas(run, "id string, name string, content binary, error string")
    fetched = row(got, F.col("name"), F.sha2("content", 256), F.col("content"), F.col("error"), F.when(F.col("error").isNull(), F.lit("fetched")))
    return bad.union(old).union(drawn).union(blank).union(fetched)


def merge(items: DataFrame, archived: DataFrame) -> DataFrame:
    """Items with the files and digests that archiving gave them."""
    new = archived.where("image_file is not null").select(F.col("id").alias("_id"), F.col("image_file").alias("_file"), F.col("image_sha256").alias("_sha"))
    joined = items.join(new, items["id"] == new["_id"], "left")
    swap = {"image_file": F.coalesce("_file", "image_file"), "image_sha256": F.coalesce("_sha", "image_sha256")}
    return joined.select(*(swap.get(c, F.col(c)).alias(c) for c in items.columns))


def verify(items: DataFrame, files: DataFrame, removal_log: DataFrame) -> DataFrame:
    """(id, name, finding): missing, removed, noHash, hashDiffers or ok for records with a file, orphan for files without one."""
    named = items.where(filled(F.col("image_file"))).select("id", basename(F.col("image_file")).alias("name"), "image_sha256")
    disk = files.select("name", F.col("sha256").alias("_disk"))
    log = removal_log.select("name", F.col("reason").alias("_reason"))
    joined = named.join(disk, "name", "left").join(log, "name", "left")
    finding = (
        F.when(F.col("_disk").isNull() & F.col("_reason").isNotNull(), "removed")
        .when(F.col("_disk").isNull(), "missing")
        .when(~filled(F.col("image_sha256")), "noHash")
        .when(F.col("image_sha256") != F.col("_disk"), "hashDiffers")
        .otherwise("ok")
    )
    orphans = disk.join(named.select("name").distinct(), "name", "left_anti").select(F.lit(None).cast("string").alias("id"), "name", F.lit("orphan").alias("finding"))
    return joined.select("id", "name", finding.alias("finding")).unionByName(orphans)


def cleanup_plan(files: DataFrame, corpus: DataFrame, shortlist: DataFrame) -> DataFrame:
    """(name, class): keep, dropped, unselected or orphaned for each file of the archive."""
    records = corpus.where("image_file is not null").select(basename(F.col("image_file")).alias("name"), "status", "pos")
    decided = records.groupBy("name").agg(F.max_by(F.struct(F.col("status")), "pos").alias("last"), F.bool_or(F.coalesce(F.col("status") == "ready", F.lit(False))).alias("kept"))
    listed = shortlist.select(F.col("id").alias("_id"), F.lit(True).alias("listed")).distinct()
    joined = files.select("name").join(decided, "name", "left").join(listed, stem(F.col("name")) == F.col("_id"), "left")
    unknown = F.col("last").isNull() | F.col("last.status").isNull()
    kind = F.when(F.col("kept"), "keep").when(F.col("last.status") == "dropped", "dropped").when(unknown & F.col("listed"), "unselected").when(unknown, "orphaned").otherwise("keep")
    return joined.select("name", kind.alias("class"))


def removals(plan: DataFrame, drop_unselected: bool = False) -> DataFrame:
    return plan.where(F.col("class").isin("dropped", "orphaned", *(["unselected"] if drop_unselected else [])))


def stranded(corpus: DataFrame, files: DataFrame) -> DataFrame:
    """Ready items whose file is not in the archive; nothing is deleted while there are any."""
    ready = corpus.where((F.col("status") == "ready") & F.col("image_file").isNotNull()).select("id", basename(F.col("image_file")).alias("name"))
    return ready.join(files.select("name"), "name", "left_anti")


def log_entries(removed: DataFrame, log: DataFrame) -> DataFrame:
    """(name, reason) that the removal log doesn't have yet."""
    return removed.select("name", F.col("class").alias("reason")).join(log.select("name"), "name", "left_anti")
