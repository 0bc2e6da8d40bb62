"""Deterministic sharded WARC writer and reader (operator 2).

Records are range-sorted by (page_id, payload digest).  Which of equal payloads is the response is
settled on narrow rows first; the verdicts then travel as notes in the same range partitioning as the
payloads, which are shuffled once.  Each task writes its records as gzip members, starts a new file
once a file has SHARD bytes, and moves each finished file from a temporary to its final name.  Headers
and digests are made anew, without a clock or random number, so a task that runs again writes the same
bytes.  The manifest of the files is written last; readers read no file that isn't in it.

Defined results: a null html is an empty payload; a null url is an empty target; rows that repeat a page_id
and payload are records of their own, of the same kind; page_ids that repeat with another payload count
as other pages of that number; a null page_id is always a response and is written without a number; other
columns are ignored; an empty table writes an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common

#: Compressed bytes after which a file is closed, and payload bytes from which equal payloads are revisits.
SHARD, LEAST = 64 << 20, 1000
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "file string, records long, bytes long, sha256 string"


def record(kind: str, page: int | None, url: str, digest: str, size: int, payload: bytes | None, refers: int | None) -> bytes:
    """A response or revisit record; the payload's size and digest are in both."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{b32}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    else:
        head += [f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info(name: str) -> bytes:
    body = f"software: propweave\r\nformat: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
    return f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{name}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without a time
    return c.compress(data) + c.flush()


class Shards:
    """One task's files."""

    def __init__(self, folder: str, part: int, attempt: int, limit: int):
        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.part, self.attempt, self.limit, self.seq, self.out = part, attempt, limit, 0, None
        self.done: list[tuple] = []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.seq:05d}.warc.gz"
            self.temp = f"{self.path}/_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temp), 0, -1, hashlib.sha256()
            self.put(info(self.name))
        self.put(data)
        if self.size >= self.limit:
            self.close()

    def put(self, data: bytes) -> None:
        packed = member(data)
        self.out.write(packed)
        self.sha.update(packed)
        self.size += len(packed)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, f"{self.path}/{self.name}")
            self.done.append((self.name, self.records, self.size, self.sha.hexdigest()))
            self.out, self.seq = None, self.seq + 1


def write(pages: DataFrame, folder: str, shard: int = SHARD, least: int = LEAST) -> DataFrame:
    """Writes pages (page_id, url, html) below folder, a URI that driver and executors share; gives the manifest."""
    spark = pages.sparkSession
    common.small_batches(spark)
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    base = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    narrow = common.cut(base.select("page_id", "digest", "size").where(f"size >= {least} and page_id is not null"), "digests")
    # the sums are partial before the shuffle, and the join's hot keys can be split
    groups = narrow.groupBy("digest", "size").agg(F.max("page_id").alias("refers"), F.count("*").alias("n")).where("n > 1").drop("n")
    notes = narrow.join(groups, ["digest", "size"]).where("page_id <> refers").select("page_id", "digest", "refers").distinct()
    notes = common.cut(notes, "revisits")
    wide = base.select("page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers"), "size", "url", "payload")
    marks = notes.select("page_id", "digest", F.lit(0).alias("kind"), "refers", F.lit(None).cast("long").alias("size"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    dealt = wide.unionAll(marks).repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        out = Shards(folder, task.partitionId(), task.taskAttemptId(), shard)
        note = None
        for batch in batches:
            for page, digest, kind, refers, size, url, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    note = (page, digest, refers)
                elif note and note[:2] == (page, digest):
                    out.add(record("revisit", page, url, digest, size, None, note[2]))
                else:
                    out.add(record("response", page, url, digest, size, data, None))
        out.close()
        if out.done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out.done)], ["file", "records", "bytes", "sha256"])

    where = f"{folder}/manifest"
    dealt.mapInArrow(run, MANIFEST).write.parquet(where)
    return spark.read.schema(MANIFEST).parquet(where)


def records(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one gzip member each."""
    data, d, out = b"", zlib.decompressobj(31), []
    while True:
        if not data and not (data := stream.read(chunk)):
            if out:
                raise ValueError("a member ends early")
            return
        out.append(d.decompress(data))
        data = d.unused_data
        if d.eof:
            yield b"".join(out)
            d, out = zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    return fields, block[: int(fields["Content-Length"])]


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of all records in the manifest; a revisit's payload is null."""
    spark = manifest.sparkSession
    n = max(1, min(manifest.count(), 20_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        number = lambda urn: int(x) if (x := urn[10:-1]) else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in records(stream):
                        fields, block = parse(data)
                        if (kind := fields["WARC-Type"]) not in ("response", "revisit"):
                            continue
                        digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                        http, _, body = block.partition(b"\r\n\r\n")
                        size = int(http.decode().rpartition("Content-Length: ")[2])
                        if kind == "response" and (len(body) != size or hashlib.sha1(body).hexdigest() != digest):
                            raise ValueError(f"{name}: the payload of {fields['WARC-Record-ID']} doesn't fit its digest")
                        rows.append((number(fields["WARC-Record-ID"]), size, digest, kind, number(fields["WARC-Refers-To"]) if kind == "revisit" else None, body if kind == "response" else None))
                        held += len(body)
                        if held > 16 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return manifest.select("file").repartitionByRange(n, "file").mapInArrow(run, kind)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_path(spark, "warc")
    manifest = write(common.table(spark, sf_dir, "pages"), folder)
    return read(manifest, folder).drop("payload")


SQL = """
with p as (select page_id, coalesce(html, '') as t from pages),
d as (select page_id, cast(strlen(t) as bigint) as payload_bytes, sha1(t) as payload_digest from p),
m as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as top from d)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from m
"""
