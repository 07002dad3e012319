"""WARC archives as a chunked record table.

Writing: every payload becomes rows (record, chunk number) of at most `chunk_bytes`, and every row one WARC
record: the first a `response`, the others `continuation` segments that follow it in the same file. The rows go
through Spark's text writer with the record end as line separator, so archives land on any file system Spark
writes to, under its output committer. Of equal payloads of at least `min_revisit` bytes one is kept, the others
are `revisit` records that name it.

Reading: a task streams its archives through buffers of `chunk_bytes` and emits the same rows. Each carries the
number of bytes and the SHA-256 of the payload up to and with its chunk, so the last row of a record states the
whole payload, no record is assembled anywhere, and memory does not depend on its length. Archives may be plain
or gzip (members of any number). The files are listed by Spark and opened in the tasks through pyarrow's file systems.

Defined cases: a null payload is empty and always a response; a null identifier comes last when the response of a
group is chosen; rows that repeat the response's identifier and payload are responses too; control characters and
blanks in a URI are percent-encoded and a null URI is the record's identifier; an empty table gives archives without records. A record cut off by the end of its file has `intact` false, as
has one whose digest is not the stated one; text between records is skipped. A continuation that does not follow
its record directly is a record of its own. Columns other than the three named ones are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, written

CHUNK_BYTES = 64 * 1024
MIN_REVISIT = 100
# Groups of equal payloads are broadcast up to this many (60 bytes each), and joined by a shuffle beyond.
BROADCAST_GROUPS = 100_000
_ID = "urn:record:"
_END = "\r\n\r\n"
_HEAD_LIMIT = 64 * 1024

CHUNKS = ("file string, offset long, record_id string, record_type string, refers_to string, target_uri string, stated_digest string, "
          "chunk_no long, data binary, payload_bytes long, payload_digest string, last boolean, intact boolean")


# --------------------------------------------------------------------------
# Writing
# --------------------------------------------------------------------------
def _uri(c: Column) -> Column:
    """Percent-encode what may not stand in a header line."""
    out = c
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def to_chunks(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
              chunk_bytes: int = CHUNK_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows (record_id, refers_to, target_uri, payload_bytes, payload_digest, chunks, chunk_no, data); `refers_to` is
    set for revisits, which have one row without data."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{uri_col}`").cast("string").alias("uri"),
                        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    digest, length = F.sha2("payload", 256), F.octet_length("payload").cast("long")
    least = F.min(F.struct(F.col("id").isNull().alias("unknown"), F.col("id")))
    groups = (rows.where(length >= min_revisit).select("id", F.unhex(digest).alias("key"))
              .groupBy("key").agg(least.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    groups = written(groups.select("key", F.col("first.id").alias("first")))
    few = groups.count() <= BROADCAST_GROUPS
    held = rows.select("id", "uri", "payload", F.unhex(digest).alias("key"), length.alias("n"))
    held = held.join(F.broadcast(groups) if few else groups, "key", "left")
    again = (F.col("n") >= min_revisit) & F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    name = lambda c: F.concat(F.lit(_ID), F.coalesce(F.url_encode(c.cast("string")), F.lit("null")))
    count = F.when(again, F.lit(1)).otherwise(F.greatest(F.ceil(F.col("n") / chunk_bytes), F.lit(1)))
    named = held.select(
        name(F.col("id")).alias("record_id"), F.when(again, name(F.col("first"))).alias("refers_to"),
        F.coalesce(_uri("uri"), name(F.col("id"))).alias("target_uri"), F.col("n").alias("payload_bytes"),
        F.lower(F.hex("key")).alias("payload_digest"), count.cast("int").alias("chunks"), "payload")
    cut = named.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
    piece = F.substring(F.col("payload"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))
    return cut.withColumn("data", F.when(F.col("refers_to").isNotNull(), F.lit(b"")).otherwise(piece)).drop("payload")


def write(chunks: DataFrame, path: str, date: Column | None = None, compression: str = "gzip") -> None:
    """Write the rows of `to_chunks`, each as one WARC record, in their order; a task writes one archive.

    The chunks of a record must follow each other, as they do in the output of `to_chunks`.
    """
    stamp = F.date_format(F.current_timestamp() if date is None else date, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    first, revisit = F.col("chunk_no") == 0, F.col("refers_to").isNotNull()
    segmented = F.col("chunks") > 1
    head = F.when(first, F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                  F.col("payload_bytes").cast("string"), F.lit(_END))).otherwise(F.lit(""))
    block = F.concat(head.cast("binary"), F.col("data"))

    def line(key: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{key}: "), value.cast("string"), F.lit("\r\n"))
        return text if when is None else F.when(when, text).otherwise(F.lit(""))

    number = F.col("chunk_no") + 1
    own = F.when(first, F.col("record_id")).otherwise(F.concat("record_id", F.lit(":segment:"), number.cast("string")))
    angle = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).when(first, F.lit("response")).otherwise(F.lit("continuation"))),
        line("WARC-Record-ID", angle(own)), line("WARC-Date", stamp), line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        line("WARC-Refers-To", angle(F.col("refers_to")), revisit),
        line("WARC-Segment-Number", number, segmented), line("WARC-Segment-Origin-ID", angle(F.col("record_id")), ~first),
        line("WARC-Segment-Total-Length", F.col("payload_bytes"), segmented & (number == F.col("chunks"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest"), first),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length("block")),
        F.lit("\r\n"))
    record = F.concat(header.cast("binary"), F.col("block")).cast("string")
    chunks.withColumn("block", block).select(record.alias("value")).write.option("lineSep", _END).option("compression", compression).text(path)


# --------------------------------------------------------------------------
# Reading
# --------------------------------------------------------------------------
def _open(uri: str):
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), "rb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, compression=None)


class _Archive:
    """Bytes of one archive, unpacked if need be, through one buffer of a few steps."""

    def __init__(self, source, step: int):
        self.source, self.step, self.at, self.ended = source, step, 0, False
        self.buffer, self.pos, self.rest = bytearray(), 0, source.read(step)
        self.inflate = zlib.decompressobj(31) if self.rest[:2] == b"\x1f\x8b" else None

    def _fill(self) -> None:
        del self.buffer[:self.pos]
        self.pos = 0
        data = self.rest or self.source.read(self.step)
        self.rest = b""
        if not data:
            self.ended = True
            if self.inflate is not None:
                self.buffer += self.inflate.flush()
        elif self.inflate is None:
            self.buffer += data
        else:
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            self.buffer += self.inflate.decompress(data, self.step)
            self.rest = self.inflate.unconsumed_tail or self.inflate.unused_data

    def _held(self) -> int:
        return len(self.buffer) - self.pos

    def _seek(self, mark: bytes, limit: int) -> int:
        """Bytes up to and with the first mark within `limit` bytes, or 0."""
        while (cut := self.buffer.find(mark, self.pos, self.pos + limit)) < 0 and self._held() < limit and not self.ended:
            self._fill()
        return cut + len(mark) - self.pos if cut >= 0 else 0

    def take(self, n: int) -> bytes:
        """n bytes, fewer only at the end."""
        while self._held() < n and not self.ended:
            self._fill()
        out = bytes(self.buffer[self.pos:self.pos + n])
        self.pos += len(out)
        self.at += len(out)
        return out

    def line(self, limit: int = _HEAD_LIMIT) -> bytes:
        """Up to and with the next line feed, or `limit` bytes; empty at the end."""
        return self.take(self._seek(b"\n", limit) or limit)

    def until_blank(self, limit: int) -> bytes:
        """Up to and with the first empty line if it lies within `limit` bytes, else nothing."""
        return self.take(self._seek(b"\r\n\r\n", limit))


def _bare(value: str | None) -> str | None:
    return value and value.strip().strip("<>")


def _headers(archive: _Archive) -> dict[str, str]:
    out, last = {}, None
    while (raw := archive.line()) not in (b"\r\n", b"\n", b""):
        text = raw.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and last:
            out[last] = f"{out[last]} {text.strip()}".strip()
        else:
            key, _, value = text.partition(":")
            last = key.strip().lower()
            out[last] = value.strip()
    return out


def chunks_of(file: str, source, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """The rows of one archive. One row is held back until it is known whether a segment follows."""
    archive, row, sha, segment = _Archive(source, chunk_bytes), None, None, 0
    while raw := archive.line():
        if not raw.startswith(b"WARC/"):
            continue
        begin = archive.at - len(raw)
        head = _headers(archive)
        left = int(head.get("content-length") or 0)
        number = int(head.get("warc-segment-number") or 0)
        kind, name = head.get("warc-type"), _bare(head.get("warc-record-id"))
        follows = kind == "continuation" and row is not None and number == segment + 1 and row["record_id"] == _bare(head.get("warc-segment-origin-id"))
        if not follows:
            if row is not None:
                yield _ended(row)
            sha = hashlib.sha256()
            stated = re.fullmatch(r"sha256:([0-9a-fA-F]{64})", head.get("warc-payload-digest", ""))
            row = {"file": file, "offset": begin, "record_id": name, "record_type": kind, "refers_to": _bare(head.get("warc-refers-to")),
                   "target_uri": head.get("warc-target-uri"), "stated_digest": stated and stated[1].lower(), "chunk_no": -1,
                   "payload_bytes": 0, "whole": True}
            if head.get("content-type", "").startswith("application/http"):
                left -= len(archive.until_blank(min(left, _HEAD_LIMIT)))
        segment = number
        empty = row["chunk_no"] < 0 and not left
        while left or empty:
            data = archive.take(min(left, chunk_bytes))
            if left and not data:
                break
            if row["chunk_no"] >= 0:
                yield {**row, "last": False, "intact": None}
            sha.update(data)
            left, empty = left - len(data), False
            row = {**row, "chunk_no": row["chunk_no"] + 1, "data": data, "payload_bytes": row["payload_bytes"] + len(data), "payload_digest": sha.copy().hexdigest()}
        if left:
            row = {**row, "whole": False}
            if row["chunk_no"] < 0:
                row = {**row, "chunk_no": 0, "data": b"", "payload_digest": sha.hexdigest()}
    if row is not None:
        yield _ended(row)


def _ended(row: dict) -> dict:
    right = row["record_type"] == "revisit" or row["stated_digest"] in (None, row["payload_digest"])
    return {**row, "last": True, "intact": row["whole"] and right}


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of all archives under a path (columns: CHUNKS); without data only the last row of each record."""
    schema = pa.schema([
        (n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[t])
        for n, t in (c.split() for c in CHUNKS.split(", "))])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in schema}, schema=schema)

    def parse(files: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in files:
            for file in found.column("path").to_pylist():
                with _open(file) as source:
                    rows, held = [], 0
                    for r in chunks_of(file, source, chunk_bytes):
                        if not with_data:
                            if not r["last"]:
                                continue
                            r["data"] = None
                        rows.append(r)
                        held += len(r["data"] or b"") + 200
                        if held >= 8 * chunk_bytes:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    listed = spark.read.format("binaryFile").load(path).select("path")
    return listed.mapInArrow(parse, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: record_id, record_type, refers_to, target_uri, payload_bytes, payload_digest, intact.

    A revisit gets the size and digest of the payload it refers to, as read from there.
    """
    ends = chunks.where("last").drop("chunk_no", "data", "last")
    found = ends.where("record_type <> 'revisit'").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min(F.struct("payload_bytes", "payload_digest", "intact")).alias("of"))
    again = ends.where("record_type = 'revisit'").join(found, "refers_to", "left")
    right = F.coalesce(F.col("of.intact") & ((F.col("of.payload_digest") == F.col("stated_digest")) | F.col("stated_digest").isNull()), F.lit(False))
    again = again.withColumns({"payload_bytes": F.col("of.payload_bytes"), "payload_digest": F.col("of.payload_digest"),
                               "intact": F.col("intact") & right}).drop("of")
    return ends.where("record_type <> 'revisit' OR record_type IS NULL").unionByName(again)


def identifier(c: Column) -> Column:
    """The integer identifier in a record's name; null for other names."""
    return F.regexp_extract(c, f"^{_ID}(-?[0-9]+)$", 1).try_cast("long")


def archived(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, min_revisit: int = MIN_REVISIT, **columns: str) -> DataFrame:
    """Write all rows to archives in the shared folder and read them back: the rows of `records`."""
    spark, path = pages.sparkSession, scratch(pages.sparkSession)
    write(to_chunks(pages, chunk_bytes=chunk_bytes, min_revisit=min_revisit, **columns), path)
    return records(written(read_chunks(spark, path, chunk_bytes, with_data=False)))


def sql() -> str:
    """DuckDB SQL for one row per page: what the archives must give back."""
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS least FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > least OR (page_id IS NULL AND least IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > least OR (page_id IS NULL AND least IS NOT NULL) THEN least END AS refers_to FROM f"""
