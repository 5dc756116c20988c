"""WARC archives: one gzip member a record, written by tasks, and a reader that splits archives at any byte.

``write_archives`` writes one archive a partition. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the
one with the smallest id is a response and the others revisit it; equality is that of SHA-256. ``read_archives`` gives each
task a byte range. The task looks for gzip's magic number in its range and takes a place for the start of a record only if
the bytes there inflate to a WARC header; from then on it goes from member to member. It owns the records that start in its
range and reads beyond the range's end to finish the last one, so no index is needed and each record is read once.

Files are reached with pyarrow's file systems by URI, as Spark has no sink for binary members; the folder must be shared. Spark's
name for an object store, ``s3a``, is read as pyarrow's, ``s3``.
A task writes to a name of its own attempt and renames it, so a retried task leaves one whole file.

Defined cases: null html is an empty payload, a null or odd URL is written as an escaped one, a null id is written as an
empty one and never chosen for the response while another id has the payload. Rows that repeat the smallest id are all
responses. An empty table gives no archive and no record. A record that is damaged or cut off is an error, or with ``skip_damaged``
passed over up to the next header. A task holds one record and an output batch of bounded bytes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import ROW_BYTES, broadcast_if_small, short_batches, stored, whole

REVISIT_BYTES = 100
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 18
OUT_BYTES = 8 << 20
GZIP_LEVEL = 4
DATE = "2024-01-01T00:00:00Z"

_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LENGTH = re.compile(rb"^content-length:\s*(\d+)\s*$", re.I | re.M)

RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def with_revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, html, digest, first``: ``first`` is the id of the response that a row revisits, else null.

    Digests are compared first, without their payloads; payloads move only if the repeated digests are too many to broadcast.
    """
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(id_col).alias("order"),
        F.col(url_col).alias("url"),
        whole(html_col).alias("html"),
        F.sha2(whole(html_col), 256).alias("digest"),
    )
    same = rows.where(F.octet_length("html") >= revisit_bytes).groupBy("digest").agg(F.min("order").alias("first"), F.count("*").alias("n"))
    repeated = stored(same.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-repeated")
    found = rows.join(broadcast_if_small(repeated, 3 * ROW_BYTES), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("order").eqNullSafe(F.col("first"))
    return found.select("id", "url", "html", "digest", F.when(revisit, F.col("first").cast("string")).alias("first"))


def record(id_: str | None, url: str | None, html: str, digest: str, first: str | None) -> bytes:
    """One record: HTTP headers and payload, or for a revisit the headers alone."""
    payload = html.encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{id_ or ''}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=chr(37) + ':/?#[]@!$&()*+,;=~')}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if first is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def spelled(uri: str) -> str:
    """A URI as pyarrow spells it."""
    scheme, mark, rest = uri.partition("://")
    return f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri


def located(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(spelled(uri))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``with_revisits``; the archives' ``path`` and ``bytes``, one row each, as a stored table."""

    def write(batches):
        task = TaskContext.get()
        system, base = located(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():06d}.warc.gz"
        own, size = f"{base}/.{name}.{task.taskAttemptId()}", 0
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                out = out or system.open_output_stream(own)
                packed = member(record(row["id"], row["url"], row["html"], row["digest"], row["first"]))
                out.write(packed)
                size += len(packed)
        if out:
            out.close()
            system.move(own, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size]})

    short_batches(rows.sparkSession)
    return stored(rows.mapInArrow(write, "path string, bytes long"), "warc-archives")


class Archive:
    """Members of one archive, reached by position."""

    def __init__(self, path: str):
        system, place = located(path)
        self.file = system.open_input_file(place)
        self.size = self.file.size()

    def find(self, start: int, end: int) -> int | None:
        """The first place in [start, end) where a record starts."""
        at = start
        while at < end:
            data = self.file.read_at(min(READ_BYTES, end - at) + len(_MAGIC) - 1, at)
            place = data.find(_MAGIC)
            while place >= 0:
                if self.header(at + place):
                    return at + place
                place = data.find(_MAGIC, place + 1)
            at += READ_BYTES
        return None

    def header(self, at: int) -> bool:
        """Whether a WARC header with a type can be inflated from here."""
        opened, head = zlib.decompressobj(31), b""
        try:
            while at < self.size and not opened.eof and b"\r\n\r\n" not in head and len(head) < 1 << 16:
                data = self.file.read_at(4096, at)
                at += len(data)
                head += opened.decompress(data)
                if not b"WARC/1.".startswith(head[:7]):
                    return False
        except zlib.error:
            return False
        return head.startswith(b"WARC/1.") and b"\r\nwarc-type:" in head.partition(b"\r\n\r\n")[0].lower()

    def member(self, at: int) -> tuple[bytes, int]:
        """A whole member and the place behind it."""
        opened, parts = zlib.decompressobj(31), []
        while not opened.eof:
            data = self.file.read_at(READ_BYTES, at)
            if not data:
                raise ValueError("an archive ends inside a record")
            parts.append(opened.decompress(data))
            at += len(data)
        return b"".join(parts), at - len(opened.unused_data)

    def records(self, start: int, end: int, skip_damaged: bool = False):
        """The records that start in [start, end)."""
        end = min(end, self.size)
        at = self.find(start, end)
        while at is not None and at < end:
            try:
                data, behind = self.member(at)
            except (zlib.error, ValueError):
                if not skip_damaged:
                    raise
                at = self.find(at + 1, end)
                continue
            yield parsed(data)
            at = behind if behind >= end or self.header(behind) else self.find(behind, end)


def parsed(data: bytes) -> tuple:
    """A row of ``RECORDS`` from a record. A revisit's payload size and digest are what its headers say of the payload."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode()
    block = block[: int(fields.get("content-length", len(block)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")

    def plain(name):
        return fields[name].strip("<>").removeprefix("urn:page:") or None if name in fields else None

    if kind == "revisit":
        told = _LENGTH.search(http)
        return plain("warc-record-id"), kind, fields.get("warc-target-uri"), plain("warc-refers-to"), int(told[1]) if told else None, fields.get("warc-payload-digest", "").removeprefix("sha256:"), None
    return plain("warc-record-id"), kind, fields.get("warc-target-uri"), plain("warc-refers-to"), len(payload), hashlib.sha256(payload).hexdigest(), payload


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True, skip_damaged: bool = False) -> DataFrame:
    """The records of archives given by ``path`` and ``bytes``: columns of ``RECORDS``."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names])

    def batch(rows):
        return pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*rows))}, schema=schema)

    def read(batches):
        for ranges in batches:
            for row in ranges.to_pylist():
                rows, held = [], 0
                for found in Archive(row["path"]).records(row["start"], row["start"] + split_bytes, skip_damaged):
                    rows.append(found if with_payload else found[:-1] + (None,))
                    held += len(found[-1] or b"") if with_payload else 100
                    if held > OUT_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    ranges = archives.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    spread = max(1, ranges.count())
    return ranges.repartition(min(spread, 100_000), "path", "start").mapInArrow(read, RECORDS)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``bytes`` of the archives in a folder, for folders that this library didn't write."""
    system, base = located(folder)
    found = [(f"{folder.rstrip('/')}/{x.base_name}", x.size) for x in system.get_file_info(pyarrow.fs.FileSelector(base)) if x.is_file and x.base_name.endswith(".warc.gz")]
    return spark.createDataFrame(found, "path string, bytes long")
