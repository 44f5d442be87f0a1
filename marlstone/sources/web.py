"""The network as a data source of Spark, with committed offsets: nothing is asked twice.

`lay_out` adds the urls that a folder doesn't have yet, as further portions: files `portion=n/bucket=k`. All urls of an
origin are in one bucket. The source `marlstone_web` reads such a folder: as a batch, all of it; as a stream, the portions
after the offset that the query's checkpoint has committed. A partition is a bucket, so that one task keeps the distance
of an origin's requests; it waits that long before its first one, too, so the distance holds from batch to batch.

`fetch_once` runs that stream into a table, one portion a batch. A run that breaks off asks again for one portion at
most: its pages are in the table once, whatever happens. Null urls are left out, repeated ones are asked once, errors and
redirects are rows like others.

    web.register(spark)
    spark.read.format("marlstone_web").option("kind", "image").load(folder)
    CREATE TEMPORARY VIEW pages USING marlstone_web OPTIONS (path '...', kind 'page')
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from marlstone.functions.columns import origin
from marlstone.sources import sinks
from marlstone.sources.fetch import Getter, as_page, http_get, image_bytes, politely
from marlstone.sources.jsonl import exists, unique

NAME = "marlstone_web"
#: Buckets of origins, and about how many urls a portion has.
BUCKETS, PORTION_URLS = 256, 1_000_000
#: Bytes of answers that a task holds before it sends them on.
HELD_BYTES = 8 * 1024 * 1024

SCHEMAS = {
    "page": pa.schema([(c, pa.string()) for c in ("url", "html", "final_url", "redirect", "error")]),
    "image": pa.schema([("url", pa.string()), ("body", pa.binary()), ("content_type", pa.string()), ("error", pa.string())]),
}
DDL = {"page": "url string, html string, final_url string, redirect string, error string", "image": "url string, body binary, content_type string, error string"}


def _folders(path: str, prefix: str) -> dict[int, str]:
    """The numbered folders `prefix`=n of a path."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return {int(f.base_name.removeprefix(prefix + "=")): f.path for f in found if f.base_name.startswith(prefix + "=")}


def _urls(path: str, bucket: int, portions: range) -> Iterator[str]:
    """The urls of a bucket, file by file."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    store, base = fs.FileSystem.from_uri(path)
    for n in portions:
        for f in store.get_file_info(fs.FileSelector(f"{base}/portion={n}/bucket={bucket}", allow_not_found=True)):
            if f.base_name.endswith(".parquet"):
                with store.open_input_file(f.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(1024, columns=["url"]):
                        yield from batch.column("url").to_pylist()


def _ask(kind: str, url: str, get: Getter) -> dict:
    if kind == "image":
        body, content_type, error = image_bytes(url, get)
        return {"url": url, "body": body, "content_type": content_type, "error": error}
    page = as_page(get(url))
    return {"url": url, "html": page.get("html"), "final_url": page.get("url"), "redirect": page.get("redirect"), "error": page.get("error")}


def _answers(urls: Iterator[str], kind: str, get: Getter, delay_s: float) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size, however large the answers are."""
    polite, rows, size = politely(get, delay_s, at_once=False), [], 0
    for url in urls:
        rows.append(_ask(kind, url, polite))
        size += 1024 + sum(len(v) for v in rows[-1].values() if v)
        if size >= HELD_BYTES:
            yield pa.RecordBatch.from_pylist(rows, SCHEMAS[kind])
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, SCHEMAS[kind])


class _Buckets(InputPartition):
    """One bucket of some portions."""

    def __init__(self, bucket: int, start: int, end: int):
        super().__init__((bucket, start, end))


def _partitions(path: str, start: int, end: int) -> list[_Buckets]:
    held = {k for n, folder in _folders(path, "portion").items() if start <= n < end for k in _folders(f"{path}/portion={n}", "bucket")}
    return [_Buckets(k, start, end) for k in sorted(held)]


def source(get: Getter = http_get, delay_s: float = 1.0) -> type[DataSource]:
    """The data source, with the getter that it asks."""

    class Batch(DataSourceReader):
        def __init__(self, path: str, kind: str):
            self.path, self.kind = path, kind

        def partitions(self) -> list[InputPartition]:
            return _partitions(self.path, 0, len(_folders(self.path, "portion"))) or [_Buckets(0, 0, 0)]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            bucket, start, end = partition.value
            return _answers(_urls(self.path, bucket, range(start, end)), self.kind, get, delay_s)

    class Stream(DataSourceStreamReader):
        def __init__(self, path: str, kind: str):
            self.path, self.kind = path, kind

        def initialOffset(self) -> dict:
            return {"portions": 0}

        def latestOffset(self) -> dict:
            return {"portions": len(_folders(self.path, "portion"))}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            return _partitions(self.path, start["portions"], end["portions"])

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            bucket, start, end = partition.value
            return _answers(_urls(self.path, bucket, range(start, end)), self.kind, get, delay_s)

    class Web(DataSource):
        @classmethod
        def name(cls) -> str:
            return NAME

        def _given(self) -> tuple[str, str]:
            path, kind = self.options.get("path"), self.options.get("kind", "page")
            if not path or kind not in SCHEMAS:
                raise ValueError(f"{NAME} needs a path, and one of the kinds {', '.join(SCHEMAS)}")
            return path.rstrip("/"), kind

        def schema(self) -> str:
            return DDL[self._given()[1]]

        def reader(self, schema) -> DataSourceReader:
            return Batch(*self._given())

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Stream(*self._given())

    return Web


def register(spark: SparkSession, get: Getter = http_get, delay_s: float = 1.0) -> None:
    spark.dataSource.register(source(get, delay_s))


def lay_out(urls: DataFrame, path: str, buckets: int = BUCKETS, portion_urls: int = PORTION_URLS) -> Iterator[int]:
    """Adds the urls that `path` doesn't have yet, portion by portion; yields the number of each when it can be read.

    The number of buckets is set when a folder is begun, and kept.
    """
    spark = urls.sparkSession
    path = path.rstrip("/")
    if exists(spark, f"{path}/buckets"):
        buckets = int(spark.read.text(f"{path}/buckets").first()[0])
    else:
        sinks.write_text(spark, f"{path}/buckets", str(buckets))
    begun = len(_folders(path, "portion"))
    new = urls.select("url").where("url is not null").distinct()
    if begun:
        new = new.join(spark.read.schema("url string").parquet(f"{path}/portion=*/bucket=*"), "url", "left_anti")
    new = new.withColumn("bucket", F.pmod(F.xxhash64(origin("url")), F.lit(buckets)).cast("int"))
    found = f"{path}/_new-{unique()}"
    new.write.parquet(f"{found}/all")
    new = spark.read.parquet(f"{found}/all")
    portions = -(-new.count() // portion_urls)
    if portions:
        new = new.withColumn("portion", F.pmod(F.xxhash64("url"), F.lit(portions)).cast("int"))
        new.repartition("portion", "bucket").write.partitionBy("portion", "bucket").parquet(f"{found}/split")
        for n, k in enumerate(sorted(_folders(f"{found}/split", "portion"))):
            sinks.move(spark, f"{found}/split/portion={k}", f"{path}/portion={begun + n}")
            yield begun + n
    sinks.remove(spark, found)


def fetch_once(urls: DataFrame, get: Getter, path: str, kind: str = "page", delay_s: float = 1.0, buckets: int = BUCKETS, portion_urls: int = PORTION_URLS) -> DataFrame:
    """The answers for `urls`, of which `path` keeps all that was asked (errors, too): a rerun asks for new urls only.

    `path/urls` holds what is asked, `path/answers` what came, `path/offsets` how far the stream has committed.
    """
    spark, path = urls.sparkSession, path.rstrip("/")
    register(spark, get, delay_s)

    def go_on() -> None:
        stream = spark.readStream.format(NAME).option("kind", kind).load(f"{path}/urls")
        stream.writeStream.format("parquet").option("path", f"{path}/answers").option("checkpointLocation", f"{path}/offsets").trigger(availableNow=True).start().awaitTermination()

    if exists(spark, f"{path}/offsets"):
        go_on()  # what a run that broke off had laid out
    for _ in lay_out(urls, f"{path}/urls", buckets, portion_urls):
        go_on()
    if not exists(spark, f"{path}/answers"):
        return spark.createDataFrame([], DDL[kind])
    return spark.read.schema(DDL[kind]).parquet(f"{path}/answers").join(urls.select("url").distinct(), "url", "left_semi")
