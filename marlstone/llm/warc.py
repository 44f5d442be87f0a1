"""WARC archives: written with an index first, read back by coalesced byte ranges.

`write` puts one gzip member per record into WARC 1.1 files of the shared folder and returns the index, a row per
record: page_id, url, payload_digest, record_type, refers_to, file, offset, length. `read` takes any selection of
index rows, sorts them by file and offset, joins ranges that lie close together into one read, and returns the
records. Of records with equal payloads of at least REVISIT_BYTES, that with the largest page_id is a response, the
others are revisits of it; smaller ones are responses all. Rows that repeat the largest page_id with the same payload
are responses each; a null page_id is smaller than any other, and a group of nulls alone is all responses.

A null html is an empty payload, a null url leaves its header out, control characters of urls are percent-encoded, very
long payloads are written and read whole, further columns are ignored, an empty table gives an empty index. A task that is run again writes new files under new
names; the index holds only those of the attempt that Spark committed. Files are opened with pyarrow.fs, so the shared
folder may be any store that it reaches (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, salted_join, written

REVISIT_BYTES = 1000
#: Repeated payloads (a row of some 100 bytes each) are broadcast up to so many; beyond, payloads are shuffled to them.
BROADCAST_WINNERS = 100_000
#: A new file begins when one is larger.
FILE_BYTES = 1 << 30
#: Selected records of one stretch of a file of this size are read by one task in one go.
STRETCH_BYTES = 8 << 20
#: Bytes of archives that a task reads, about.
TASK_BYTES = 4 * STRETCH_BYTES
#: Ranges with at most this gap between them become one read.
GAP_BYTES = 64 << 10
#: Fixed value, so that a rerun writes the same records.
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, url string, payload_digest string, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC record; page ids stand in record ids. A revisit has the HTTP head of its response and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {WARC_DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's fields; raises ValueError where lengths or the digest of the payload don't agree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload does not match its digest")
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


def _store(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(root)
    uri = root[: len(root) - len(base)] if root.endswith(base) else ""
    out, name, at = None, "", 0
    try:
        for b in batches:
            rows, place = b.to_pydict(), []
            for page_id, url, payload, digest, kind, refers in zip(*(rows[c] for c in ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to")), strict=True):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(base, recursive=True)
                    name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(name, compression=None)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = pack.compress(record(page_id, url, payload, digest, kind, refers)) + pack.flush()
                out.write(member)
                place.append((uri + name, at, len(member)))
                at += len(member)
            kept = [b.column(c) for c in ("page_id", "url", "payload_digest", "record_type", "refers_to")]
            places = [pa.array([p[k] for p in place], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.record_batch([*kept, *places], ["page_id", "url", "payload_digest", "record_type", "refers_to", "file", "offset", "length"])
    finally:
        if out is not None:
            out.close()


def write(pages: DataFrame, root: str | None = None, broadcast_winners: int = BROADCAST_WINNERS) -> DataFrame:
    """Writes a record for each row of (page_id, url, html) and returns the index."""
    spark = pages.sparkSession
    root = root or new_path(spark, "warc")
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    groups = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("payload_digest", "size").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
    # Only payloads that repeat have a winner. While these are few, no payload is shuffled.
    winners = written(groups.where("n > 1 and winner is not null").drop("n"), "winners")
    if winners.limit(broadcast_winners + 1).count() <= broadcast_winners:
        rows = rows.join(F.broadcast(winners), ["payload_digest", "size"], "left")
    else:
        rows = salted_join(rows, winners, ["payload_digest", "size"], F.struct("page_id", "url"))
    again = F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("page_id"))
    rows = rows.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("winner")))
    return written(rows.drop("winner", "size").mapInArrow(lambda it: _store(it, root), INDEX), "warc-index")


def ranges(rows: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = STRETCH_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted (offset, length) pairs -> reads (start, end, numbers of the pairs in it)."""
    start = end = -1
    inside: list[int] = []
    for k, (offset, length) in enumerate(rows):
        if inside and (offset - end > gap or max(end, offset + length) - start > most):
            yield start, end, inside
            inside = []
        if not inside:
            start = end = offset
        inside.append(k)
        end = max(end, offset + length)
    if inside:
        yield start, end, inside


def _fetch(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    name, source = None, None
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    for b in batches:
        files, offsets, lengths = (b.column(c).to_pylist() for c in ("file", "offset", "length"))
        i = 0
        while i < len(files):
            j = i
            while j < len(files) and files[j] == files[i]:
                j += 1
            if files[i] != name:
                if source is not None:
                    source.close()
                store, path = fs.FileSystem.from_uri(files[i])
                name, source = files[i], store.open_input_file(path)
            places = list(zip(offsets[i:j], lengths[i:j], strict=True))
            for start, end, inside in ranges(places):
                source.seek(start)
                raw = source.read(end - start)
                found = [parse(zlib.decompress(raw[places[k][0] - start : places[k][0] - start + places[k][1]], 31)) for k in inside]
                if not payloads:
                    for x in found:
                        x["payload"] = None
                yield pa.record_batch([pa.array([x[c] for x in found], t) for c, t in zip(names, types, strict=True)], names)
            i = j
    if source is not None:
        source.close()


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the given index rows; `payloads` false leaves that column null."""
    tasks = index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / STRETCH_BYTES))
    # Index rows are small, and what they stand for is not: tasks are as many as the bytes ask for.
    total = tasks.agg(F.sum("length")).first()[0] or 0
    tasks = tasks.repartition(1 + total // TASK_BYTES, "file", "stretch").sortWithinPartitions("file", "offset")
    return tasks.mapInArrow(lambda it: _fetch(it, payloads), RECORD)
