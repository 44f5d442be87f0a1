"""Writers. Each takes dry_run, and then writes nothing; tables are written as new snapshots, never over what is read."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.fetch import dealt


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _json(df: DataFrame, drop: tuple[str, ...] = ("pos", "_keys", "page_id")):
    return df.drop(*drop).write.option("ignoreNullFields", "false")


def append_jsonl(df: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Adds rows, nulls kept as fields, in order of `pos` where there is one. The new files' names come behind those there."""
    if not dry_run:
        spark, base = df.sparkSession, path.rstrip("/")
        made_path = f"{base}.add-{uuid.uuid4().hex}"
        _json(df.orderBy("pos") if "pos" in df.columns else df).json(made_path)
        fs, made = _fs(spark, made_path)
        fs.mkdirs(_fs(spark, base)[1])
        numbers = [int(m[1]) for x in fs.listStatus(_fs(spark, base)[1]) if (m := re.match(r"part-(\d+)", x.getPath().getName()))]
        first = max(numbers, default=-1) + 1
        for k, name in enumerate(sorted(x.getPath().getName() for x in fs.globStatus(_fs(spark, f"{made_path}/part-*")[1]))):
            _rename(fs, _fs(spark, f"{made_path}/{name}")[1], _fs(spark, f"{base}/part-{first + k:05d}-{name.split('-', 2)[2]}")[1])
        fs.delete(made, True)
    return df


def overwrite_jsonl(df: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """A new table beside the old one, which it then replaces: the old one is renamed, and goes when the new one is there.

    At every moment one of PATH, PATH.old and PATH.new is whole; `recover` puts it in place after a crash.
    """
    if not dry_run:
        spark = df.sparkSession
        base = path.rstrip("/")
        _json(df.orderBy("pos") if "pos" in df.columns else df).mode("overwrite").json(f"{base}.new")
        fs, old = _fs(spark, f"{base}.old")
        now, new = _fs(spark, base)[1], _fs(spark, f"{base}.new")[1]
        fs.delete(old, True)
        if fs.exists(now):
            _rename(fs, now, old)
        _rename(fs, new, now)
        fs.delete(old, True)
    return df


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"{a} could not be renamed to {b}")


def move(spark: SparkSession, a: str, b: str) -> None:
    """One rename, so that `b` is there whole or not at all."""
    fs, old = _fs(spark, a)
    _rename(fs, old, _fs(spark, b)[1])


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all that it holds."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def recover(spark: SparkSession, path: str) -> None:
    """After a crash between the two renames of `overwrite_jsonl`: the old table comes back."""
    fs, now = _fs(spark, path.rstrip("/"))
    old = _fs(spark, f"{path.rstrip('/')}.old")[1]
    if not fs.exists(now) and fs.exists(old):
        _rename(fs, old, now)


def write_files(rows: DataFrame, folder: str, dry_run: bool = False) -> DataFrame:
    """(image_file, content): each content under its base name in `folder`, through pyarrow's file systems."""
    todo = rows.where("content is not null and image_file is not null").select(F.substring_index("image_file", "/", -1).alias("name"), "content")
    if not dry_run:

        def run(part) -> None:
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(folder)
            store.create_dir(base, recursive=True)
            for r in part:
                with store.open_output_stream(f"{base}/{r['name']}", compression=None) as out:
                    out.write(bytes(r["content"]))

        todo.foreachPartition(run)
    return todo


def delete_files(gone: DataFrame, folder: str, dry_run: bool = True) -> DataFrame:
    """(name): deletes these files of `folder`, task by task; dry by default. Names that aren't there are passed over."""
    names = dealt(gone.select("name"), F.col("name"), F.col("name"), 0).distinct()  # names are small, deleting takes time
    if not dry_run:

        def run(part) -> None:
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(folder)
            for r in part:
                if store.get_file_info(f"{base}/{r['name']}").type == fs.FileType.File:
                    store.delete_file(f"{base}/{r['name']}")

        names.foreachPartition(run)
    return names


LOG_HEAD = "# Images that were deleted, and why: a name, then a reason. Records may still name them."


def append_log(entries: DataFrame, path: str, first: bool, dry_run: bool = False) -> DataFrame:
    """(name, reason) rows as lines; a new log begins with a comment."""
    rows = entries.orderBy("name").select(F.concat_ws("  ", "name", "reason").alias("value"))
    if not dry_run:
        if first:
            entries.sparkSession.createDataFrame([(LOG_HEAD,)], "value string").write.mode("append").text(path)
        rows.coalesce(1).write.mode("append").text(path)
    return rows


def write_text(spark: SparkSession, path: str, text: str, dry_run: bool = False) -> str:
    """One small file, such as a prompt."""
    if not dry_run:
        fs, p = _fs(spark, path)
        out = fs.create(p, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
    return text


def size(spark: SparkSession, path: str) -> int:
    """Bytes at a path, file or folder; 0 where nothing is."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def write_sessions(reports: DataFrame, folder: str, dry_run: bool = False) -> DataFrame:
    """(session_id, report): a file validation-SESSION.json each, written task by task."""
    if not dry_run:
        name = F.concat(F.lit("validation-"), "session_id", F.lit(".json"))
        write_files(reports.select(name.alias("image_file"), F.encode("report", "utf-8").alias("content")), folder)
    return reports


def append_batch(df: DataFrame, path: str, batch: int) -> int:
    """Adds the rows of one batch of a stream to a folder of JSON lines, and returns how many. The files carry the batch's
    number: one that runs again takes the place of what it wrote before."""
    spark, base = df.sparkSession, path.rstrip("/")
    _json(df).mode("overwrite").json(f"{base}.batch{batch}")
    fs, made = _fs(spark, f"{base}.batch{batch}")
    mine = f"part-batch{batch}-"
    fs.mkdirs(_fs(spark, base)[1])
    for old in fs.globStatus(_fs(spark, f"{base}/{mine}*")[1]):
        fs.delete(old.getPath(), False)
    for k, new in enumerate(fs.globStatus(_fs(spark, f"{base}.batch{batch}/part-*")[1])):
        _rename(fs, new.getPath(), _fs(spark, f"{base}/{mine}{k:05d}.json")[1])
    fs.delete(made, True)
    return spark.read.text(f"{base}/{mine}*").count() if fs.globStatus(_fs(spark, f"{base}/{mine}*")[1]) else 0
