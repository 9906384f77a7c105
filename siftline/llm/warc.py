"""WARC archives: a deterministic sharded writer, and a reader.

Pages are dealt out to shards by ranges of page_id whose borders depend on the
data alone, sorted, and written record by record, each a gzip member of its own;
a file is closed when it has reached a compressed size.  Headers, record ids and
digests are made anew from the payload.  A file is written under a temporary
name and renamed when it is whole, so that a retried task replaces its
predecessor's files with the same bytes.  What is in the archive is what the
manifest says: a table of files, written last.

Of equal payloads, the record with the smallest page_id is a response and the
others revisit it.  Which is which is settled on narrow rows; the verdicts
travel to the shards beside the pages, so that payloads are shuffled once.

Files are reached through Arrow's file systems, by the URI of the folder.

Defined results: a null html is an empty payload.  A null page_id is larger than
any number and its records carry none.  Rows that repeat an id and a payload are
records of their own; if that id is the smallest, all of them are responses.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm.tables import stage

ROLL_BYTES = 32 << 20  # compressed size at which a file is closed
SHARD_BYTES = 64 << 20  # payload bytes of a shard, about
MOST_SHARDS = 4096
PER_SHARD = 64  # ids in the sample of borders, for each shard
REVISIT_BYTES = 0  # smallest payload that is written once
LEVEL = 3
READ_BYTES = 1 << 20
DATE = "2024-01-31T00:00:00Z"
LAST_ID = 2**63 - 1

WRITTEN_SCHEMA = "file string, shard long, records long, bytes long, first_id long, last_id long"
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs
_CRLF = b"\r\n"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def verdicts(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """key, size, sha1, refers_to (null for responses): narrow rows."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    narrow = stage(pages.select("key", F.octet_length(html).cast("long").alias("size"), F.sha1(html).alias("sha1")), "digests")
    first = (
        narrow.filter(F.col("size") >= revisit_bytes)
        .groupBy(F.col("sha1").alias("same"))
        .agg(F.min("key").alias("least"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    refers = F.when(F.col("key") > F.col("least"), F.col("least"))
    return stage(narrow.join(first, F.col("sha1") == F.col("same"), "left").select("key", "size", "sha1", refers.alias("refers_to")), "verdicts")


def borders(rows: DataFrame) -> list[int]:
    """First ids of all shards but the first: quantiles of a sample by hash, the same on every run.

    The sample has about ``PER_SHARD`` ids for each of at most ``MOST_SHARDS`` shards.
    """
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    shards = min(MOST_SHARDS, max(1, -(-(total or 0) // SHARD_BYTES)))
    if shards == 1:
        return []
    share = min(1.0, shards * PER_SHARD / n)
    hashed = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = np.sort(np.array([r[0] for r in rows.filter(hashed).select("key").distinct().collect()], np.int64))
    at = (np.arange(1, shards) * len(sample)) // shards
    return sorted(set(sample[at].tolist())) if len(sample) else []


def _header(kind: str, fields: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}"] + [f"{k}: {v}" for k, v in fields]
    return "\r\n".join(lines).encode() + 2 * _CRLF


def _clean(url: str | None) -> str:
    return " ".join((url or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record as a gzip member; a revisit has the HTTP header alone."""
    digest = base32(hashlib.sha1(payload).digest())
    name = uuid.uuid5(_NAMES, f"{page_id}:{digest}")
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(_NAMES, f'{refers_to}:{digest}')}>"),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return member.compress(_header("revisit" if revisit else "response", fields) + block + 2 * _CRLF) + member.flush()


class _Shard:
    """The files of one shard, closed one after the other as they fill up."""

    def __init__(self, folder: str, shard: int, roll: int) -> None:
        self.fs, self.path = file_system(folder)
        self.shard, self.roll, self.number, self.done, self.out = shard, roll, 0, [], None
        context = TaskContext.get()
        self.attempt = context.taskAttemptId() if context else 0

    def add(self, page_id: int | None, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/_temporary-{self.attempt}-{self.name}"
            self.out, self.records, self.bytes, self.first = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, page_id
        self.out.write(data)
        self.records, self.bytes, self.last = self.records + 1, self.bytes + len(data), page_id
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.path}/{self.name}")
            self.done.append((self.name, self.shard, self.records, self.bytes, self.first, self.last))
            self.number, self.out = self.number + 1, None


def write_archive(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write page_id, url and html to archives below ``folder``; the manifest, a table of its files."""
    pages = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(LAST_ID)).alias("key"), "url", "html")
    judged = verdicts(pages, revisit_bytes)
    first_ids = np.array(borders(judged), np.int64)
    fs, path = file_system(folder)
    fs.create_dir(f"{path}/warc", recursive=True)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = np.searchsorted(first_ids, batch.column("key").to_numpy(), "right")
            yield pa.record_batch([pa.array(shard), *batch.columns], names=["shard", *batch.schema.names])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, files, judged_key, revisits = None, [], None, {}
        for batch in batches:
            for shard, key, url, html, refers in zip(*(batch.column(c) for c in ("shard", "key", "url", "html", "refers_to")), strict=True):
                shard, key, refers = shard.as_py(), key.as_py(), refers.as_py()
                if out is None or out.shard != shard:
                    if out is not None:
                        out.close()
                        files += out.done
                    out = _Shard(f"{folder}/warc", shard, roll)
                if key != judged_key:
                    judged_key, revisits = key, {}
                if refers is not None:  # verdicts come before the pages of their id, the payload's digest in place of the URL
                    revisits[url.as_py()] = refers
                    continue
                payload = (html.as_py() or "").encode()
                to = revisits.get(hashlib.sha1(payload).hexdigest()) if revisits else None
                page_id = None if key == LAST_ID else key
                out.add(page_id, record(page_id, url.as_py(), payload, to))
        if out is not None:
            out.close()
            files += out.done
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("file", "shard", "records", "bytes", "first_id", "last_id"), f, strict=True)) for f in files],
            schema=pa.schema([("file", pa.string())] + [(c, pa.int64()) for c in ("shard", "records", "bytes", "first_id", "last_id")]),
        )

    page = pages.select("key", F.lit(1).alias("page"), "url", "html", F.lit(None).cast("long").alias("refers_to"))
    verdict = judged.filter("refers_to is not null").select(
        "key", F.lit(0).alias("page"), F.col("sha1").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to"
    )
    columns = "shard long, key long, page int, url string, html string, refers_to long"
    dealt = page.unionByName(verdict.distinct()).mapInArrow(deal, columns)
    shards = len(first_ids) + 1
    sorted_ = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "page", "url", F.sha1("html"))
    written = sorted_.mapInArrow(write, WRITTEN_SCHEMA)
    written.write.mode("overwrite").parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open archive, member by member."""
    waiting = b""
    while True:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            waiting = waiting or source.read(READ_BYTES)
            if not waiting:
                if parts:
                    raise ValueError("an archive ends inside a record")
                return
            parts.append(member.decompress(waiting))
            waiting = member.unused_data
        head, _, rest = b"".join(parts).partition(2 * _CRLF)
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record of the manifest's files.

    Length and digest of a response are taken from its payload; a revisit states them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(f"{folder}/warc")
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for fields, block in records(source):
                        kind, page, refers = fields["WARC-Type"], fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                        size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response":
                            payload = block.partition(2 * _CRLF)[2]
                            size, digest = len(payload), base32(hashlib.sha1(payload).digest())
                        rows.append((page and int(page), size, digest, kind, refers and int(refers)))
                names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.parquet(f"{folder}/manifest").select("file")
    # A file to a task; a number keeps small lists from being put together again.
    return files.repartition(max(1, files.count())).mapInArrow(read, READ_SCHEMA)
