"""Archived files: names without reading them, or their SHA-256, with or without the bytes.

A folder is listed once, by one task that gives nothing but names; many tasks read the files. Spark's own source for files
is left for stores that pyarrow doesn't reach: it opens files slowly, and makes a task of every 32.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.fetch import dealt
from marlstone.sources.scratch import keep

#: Names a listing gives at a time; files and bytes that come out of a reading task at a time; bytes that are hashed at a time.
NAMES, FILES, BYTES, CHUNK = 20_000, 1_000, 32 * 1024 * 1024, 1024 * 1024


def _reached(folder: str) -> bool:
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(folder)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _shown(name: Column) -> Column:
    """Dot files and README.md are left out, and, as Spark does, what begins with _ but for key=value."""
    return ~name.startswith(".") & (name != "README.md") & ~(name.startswith("_") & ~F.contains(name, F.lit("=")))


def names(spark: SparkSession, folder: str) -> DataFrame:
    """`name` of each file; contents are not read. Dot files and README.md are left out."""
    if not _reached(folder):
        files = spark.read.format("binaryFile").load(folder).select(F.substring_index("path", "/", -1).alias("name"))
        return files.where(_shown(F.col("name")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for _ in batches:
            found = [x.base_name for x in store.get_file_info(fs.FileSelector(base)) if x.type == fs.FileType.File]
            for k in range(0, len(found), NAMES):
                yield pd.DataFrame({"name": found[k : k + NAMES]})

    # Written, so that it is a state of the folder, whatever is deleted later.
    return keep(spark.range(0, 1, 1, 1).mapInPandas(run, "name string").where(_shown(F.col("name"))), "names")


def contents(spark: SparkSession, folder: str, content: bool = True) -> DataFrame:
    """(name, size, sha256, content), without the last one if it isn't wanted."""
    columns = ["name", "size", "sha256", *(["content"] if content else [])]
    if not _reached(folder):
        files = spark.read.format("binaryFile").load(folder)
        rows = files.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")
        return rows.where(_shown(F.col("name"))).select(*columns)

    def read(stream) -> tuple:
        if content:
            data = stream.read()
            return len(data), hashlib.sha256(data).hexdigest(), data
        size, digest = 0, hashlib.sha256()
        while part := stream.read(CHUNK):
            size += len(part)
            digest.update(part)
        return size, digest.hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        rows, held = [], 0
        for batch in batches:
            for name in batch["name"]:
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows.append((name, *read(stream)))
                held += rows[-1][1] if content else 0
                if len(rows) >= FILES or held >= BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    name = F.col("name")
    return dealt(names(spark, folder), name, name, 0).mapInPandas(run, "name string, size long, sha256 string" + (", content binary" if content else ""))
