"""WARC archives written by a deterministic sharded writer, and read back.

``write_archive`` range-sorts the records by page id (cut points come from a hash sample of the ids, so they are the
same on every run), writes each range as gzip members, rolls to a new file by compressed size, and commits in two
steps: every file is written under a temporary name of its task attempt and renamed to its final name, and the
manifest of all files is written last. A retried or speculative task writes the same bytes to the same final name.
``read_archive`` reads the files that the manifest lists, and checks each against its size and digest.

Only the keys (id, digest, size) are grouped to decide which record of equal payloads is the response. That decision
rides along as a small row that sorts right before its page, so the html is shuffled once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, shuffle_partitions, split_points

#: Date of the regenerated headers: a fixed value keeps the archive bytes equal from run to run.
WARC_DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("records", T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType()),
    T.StructField("first_id", T.LongType()), T.StructField("last_id", T.LongType()),
])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType()), T.StructField("intact", T.BooleanType()),
])


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{payload_digest}')}>"


def _header_value(text: str | None) -> str:
    """A header value on one line: controls and blanks at the ends would break the header block."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in (text or "")).strip()


def encode(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header, which states the payload's length, and drops the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page_id, payload_digest)}", f"WARC-Date: {WARC_DATE}",
             f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, payload_digest)}",
                  f"X-Refers-To-Page-ID: {refers_to}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def decode(stream: io.BufferedIOBase):
    """Records of a WARC stream as (headers, block)."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        stream.read(4)
        yield headers, block


def parse(headers: dict[str, str], block: bytes) -> dict:
    """A record's row. ``intact`` says that the stated block and payload digests hold."""
    head, _, body = block.partition(b"\r\n\r\n")
    stated = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = headers["warc-type"] == "revisit"
    claimed = headers["warc-payload-digest"].removeprefix("sha1:")
    intact = headers["warc-block-digest"] == f"sha1:{digest(block)}" and (
        revisit or (len(body) == stated and digest(body) == claimed))
    as_id = lambda name: int(headers[name]) if name in headers else None
    return {"page_id": as_id("x-page-id"), "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"],
            "payload_bytes": stated, "payload_digest": claimed, "refers_to": as_id("x-refers-to-page-id"),
            "payload": None if revisit else body, "intact": intact}


class _Roller:
    """Writes gzip members to numbered files of one shard; a file is rolled once it holds ``roll_bytes``."""

    def __init__(self, folder: str, shard: int, attempt: str, roll_bytes: int):
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.roll_bytes = shard, attempt, roll_bytes
        self.number, self.out = 0, None

    def add(self, page_id: int | None, record: bytes):
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.part = f"{self.root}/_temporary-{self.name}.{self.attempt}"
            self.out, self.hash = self.files.open_output_stream(self.part), hashlib.sha256()
            self.n = self.size = 0
            self.first = page_id
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without a time stamp
        data = packer.compress(record) + packer.flush()
        self.out.write(data)
        self.hash.update(data)
        self.n, self.size, self.last = self.n + 1, self.size + len(data), page_id
        if self.size >= self.roll_bytes:
            yield self.close()

    def close(self) -> dict:
        self.out.close()
        self.files.move(self.part, f"{self.root}/{self.name}")
        self.out, self.number = None, self.number + 1
        return {"file": self.name, "records": self.n, "bytes": self.size, "sha256": self.hash.hexdigest(),
                "first_id": self.first, "last_id": self.last}


def write_archive(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = 0, roll_bytes: int = 16 << 20) -> DataFrame:
    """Write every row of ``pages`` as a WARC record under ``folder``; return the manifest (one row per file).

    Of rows with equal payloads of at least ``min_bytes``, the one with the largest id is the response and the others
    are revisits of it; smaller payloads are all responses. A null html is an empty payload, a null url leaves out
    the target header. Rows with a null id are responses without an id, and sort first. Repeated rows (one id more
    than once) are each written; those with the winning id and payload are all responses. Extra columns are ignored.
    An empty table gives an archive without files. ``folder`` must be a new folder on a file system that all
    executors share. Files are rolled at ``roll_bytes`` of compressed data, so a reader never holds more at once.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    n = shuffle_partitions(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("body"))
    keys = rows.select("id", F.sha1("body").alias("digest"), F.length("body").alias("size"))
    winner = (keys.where((F.col("size") >= min_bytes) & F.col("id").isNotNull())
              .groupBy("digest").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    # One small row per page that revisits another, to be sorted right before its page.
    note = (keys.where(F.col("size") >= min_bytes).join(winner, "digest").where("id < keep")
            .select("id", "digest", "keep").distinct())
    points = split_points(rows, "id", n)

    @F.pandas_udf(T.IntegerType())
    def shard_of(ids: pd.Series) -> pd.Series:
        where = np.searchsorted(points, ids.fillna(np.iinfo(np.int64).min).astype(np.int64).to_numpy(), "right")
        return pd.Series(where.astype(np.int32))

    empty = F.lit(None)
    both = (rows.select("id", F.lit(1).alias("is_page"), "url", "body", empty.cast("string").alias("digest"),
                        empty.cast("long").alias("keep"))
            .unionByName(note.select("id", F.lit(0).alias("is_page"), empty.cast("string").alias("url"),
                                     empty.cast("binary").alias("body"), "digest", "keep")))
    dealt = (both.withColumn("shard", shard_of("id")).repartitionById(len(points) + 1, "shard")
             .sortWithinPartitions("id", "is_page", "digest", "url", "body"))
    target = arrow_schema(MANIFEST)

    def write(batches):
        from pyspark import TaskContext

        attempt, roller = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}", None
        done: list[dict] = []
        last, revisits = None, {}
        for batch in batches:
            c = {x: batch.column(x).to_pylist() for x in batch.schema.names}
            for page_id, is_page, url, body, hexed, keep, shard in zip(
                    c["id"], c["is_page"], c["url"], c["body"], c["digest"], c["keep"], c["shard"], strict=True):
                if page_id != last:
                    last, revisits = page_id, {}
                if not is_page:
                    revisits[hexed] = keep
                    continue
                raw = hashlib.sha1(body).digest()
                roller = roller or _Roller(folder, shard, attempt, roll_bytes)
                done += roller.add(page_id, encode(page_id, url, body, base64.b32encode(raw).decode(),
                                                   revisits.get(raw.hex())))
        if roller is not None and roller.out is not None:
            done.append(roller.close())
        yield pa.RecordBatch.from_pylist(done, schema=target)

    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root)
    manifest = dealt.mapInArrow(write, MANIFEST)
    manifest.write.mode("errorifexists").parquet(f"{folder}/_manifest")  # committed last: its _SUCCESS ends the write
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def read_archive(spark: SparkSession, folder: str, *, payloads: bool = True) -> DataFrame:
    """Records of the files that the manifest in ``folder`` lists, one row each.

    ``intact`` is false where a record's digests do not hold. A file that is missing or differs from its manifest
    entry ends the read with an error. With ``payloads=False`` the payload column stays null (its digest is still
    checked). An archive without files gives no rows.
    """
    bounded_batches(spark)
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("file", "bytes", "sha256")
    # The paths come from the manifest, never from a listing: files of failed attempts are not read.
    work = listed.repartition(shuffle_partitions(spark), "file")
    target = arrow_schema(RECORDS)

    def read(batches):
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, size, sha in zip(*(batch.column(x).to_pylist() for x in ("file", "bytes", "sha256")), strict=True):
                with files.open_input_stream(f"{root}/{name}", compression=None) as f:
                    data = f.read()
                if len(data) != size or hashlib.sha256(data).hexdigest() != sha:
                    raise ValueError(f"{name} differs from its manifest entry")
                found, held = [], 0
                for headers, block in decode(gzip.GzipFile(fileobj=io.BytesIO(data))):
                    row = parse(headers, block)
                    if not payloads:
                        row["payload"] = None
                    found.append(row)
                    held += len(row["payload"] or b"") + 256
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema=target)
                        found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=target)

    return work.mapInArrow(read, RECORDS)

