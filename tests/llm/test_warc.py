"""WARC archives: exact round trip, segments, revisits, foreign and damaged archives."""

import gzip
import hashlib
import io

import pytest

from spanlight.llm import warc
from spanlight.llm.common import scratch

PAGES = "page_id long, url string, html string, data string, chunks int, n int, payload string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, 4, "y") for r in rows], PAGES)


def _expected(rows):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        known = [x for x in groups[h or ""] if x is not None]
        least = min(known) if known and len(body) >= 100 else None
        revisit = least is not None and i != least
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", least if revisit else None, True))
    return sorted(out, key=str)


def _found(records):
    return sorted(((int(i) if (i := r.record_id.removeprefix("urn:record:")) != "null" else None, r.payload_bytes, r.payload_digest, r.record_type,
                    None if r.refers_to is None else int(r.refers_to.removeprefix("urn:record:")), r.intact) for r in records.collect()), key=str)


ROWS = [
    (5, "http://a/ b\r\nX: 1", "é" * 700), (3, "http://a/2", "é" * 700), (9, None, "é" * 700), (4, "http://a/3", "short"), (6, "http://a/4", "short"),
    (7, "http://a/5", None), (8, "http://a/6", ""), (1, "http://a/7", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n" * 40),
    (2, "http://a/8", "日本語\n" * 900), (None, "http://a/9", "日本語\n" * 900), (-12, "http://a/9", "x" * 100), (13, "http://a/9", "x" * 100)]


@pytest.mark.parametrize("chunk_bytes,compression", [(64, "gzip"), (101, "none"), (65536, "gzip")])
def test_round_trip(spark, chunk_bytes, compression):
    path = scratch(spark)
    warc.write(warc.to_chunks(_pages(spark, ROWS), chunk_bytes=chunk_bytes), path, compression=compression)
    chunks = warc.read_chunks(spark, path, chunk_bytes)
    assert _found(warc.records(chunks)) == _expected(ROWS)
    # The chunks put together are the payload, none is longer than asked for, and each knows the digest so far.
    text = {}
    for r in sorted(chunks.where("record_type = 'response'").collect(), key=lambda r: (r.file, r.offset, r.chunk_no)):
        assert len(r.data) <= chunk_bytes
        key = (r.record_id, r.file, r.offset)
        assert (r.chunk_no == 0) == (key not in text)
        text[key] = text.get(key, b"") + bytes(r.data)
        assert (r.payload_bytes, r.payload_digest) == (len(text[key]), hashlib.sha256(text[key]).hexdigest())
    kept = {i: h for i, _, h in ROWS}
    assert {k[0]: v for k, v in text.items()} == {f"urn:record:{i}": (kept[i] or "").encode() for i in (3, 4, 6, 7, 8, 1, 2, -12)}


def test_archive_is_plain_warc(spark, tmp_path):
    """A reader that knows nothing but the format finds every record by its stated length."""
    path = scratch(spark)
    warc.write(warc.to_chunks(_pages(spark, ROWS).coalesce(1), chunk_bytes=300), path)
    (file,) = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    body, kinds = gzip.decompress(open(file.removeprefix("file:"), "rb").read()), []
    while body:
        head, _, rest = body.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        block, rest = rest[:int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        assert " " not in fields["WARC-Target-URI"] and "X" not in fields
        assert rest.startswith(b"\r\n\r\n")
        body = rest[4:]
        kinds.append(fields["WARC-Type"])
    assert kinds.count("revisit") == 4 and kinds.count("response") == 8 and kinds.count("continuation") > 20


def test_repeated_rows_and_groups_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", 0)
    rows = [(1, "u", "y" * 200)] * 3 + [(2, "u", "y" * 200)] * 2 + [(None, "u", "z" * 200)] * 2
    assert _found(warc.archived(_pages(spark, rows))) == sorted(
        [(1, 200, hashlib.sha256(b"y" * 200).hexdigest(), "response", None, True)] * 3
        + [(2, 200, hashlib.sha256(b"y" * 200).hexdigest(), "revisit", 1, True)] * 2
        + [(None, 200, hashlib.sha256(b"z" * 200).hexdigest(), "response", None, True)] * 2, key=str)


def test_empty_table(spark):
    assert warc.archived(_pages(spark, []).coalesce(1)).count() == 0


def _record(kind, name, block, extra="", length=None):
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <{name}>\r\n{extra}Content-Length: {len(block) if length is None else length}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives():
    """Records of other writers: gzip members, no digests, folded headers, junk between records, segments elsewhere, a cut end."""
    long = bytes(range(256)) * 400
    parts = [
        _record("warcinfo", "i", b"software: x\r\n"), _record("resource", "a", long, "WARC-Target-URI:\r\n http://a/\r\n"),
        b"junk\r\nmore junk\r\n", _record("response", "b", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody", "Content-Type: application/http; msgtype=response\r\n"),
        _record("response", "c", b"one", "WARC-Segment-Number: 1\r\n"),
        _record("continuation", "d", b"two", "WARC-Segment-Origin-ID: <c>\r\nWARC-Segment-Number: 2\r\n"),
        _record("continuation", "e", b"four", "WARC-Segment-Origin-ID: <c>\r\nWARC-Segment-Number: 4\r\n"),
        _record("resource", "f", b"bad", "WARC-Payload-Digest: sha256:" + "0" * 64 + "\r\n"),
        _record("resource", "g", b"")]
    cut = _record("resource", "h", b"not all of it", length=500)
    for packed in (b"".join(parts), b"".join(gzip.compress(p) for p in parts)):
        for step in (64, 1000, 65536):
            whole = packed + (cut if packed[:2] != b"\x1f\x8b" else gzip.compress(cut))
            ends = [r for r in warc.chunks_of("f", io.BytesIO(whole), step) if r["last"]]
            assert [(r["record_id"], r["payload_bytes"], r["intact"]) for r in ends] == [
                ("i", 13, True), ("a", len(long), True), ("b", 4, True), ("c", 6, True), ("e", 4, True), ("f", 3, False), ("g", 0, True),
                ("h", len(b"not all of it\r\n\r\n"), False)]
            assert ends[1]["payload_digest"] == hashlib.sha256(long).hexdigest() and ends[1]["target_uri"] == "http://a/"
            assert ends[3]["payload_digest"] == hashlib.sha256(b"onetwo").hexdigest()


def test_long_payload_in_bounded_memory():
    """A payload of 64 MB is read in pieces: the reader never holds more than a few of them."""
    class Zeros:
        def __init__(self, head, n):
            self.head, self.left, self.most = head, n, 0

        def read(self, n):
            self.most = max(self.most, n)
            if self.head:
                out, self.head = self.head[:n], self.head[n:]
                return out
            out = bytes(min(n, self.left))
            self.left -= len(out)
            return out

    size = 64 << 20
    source = Zeros(f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <z>\r\nContent-Length: {size}\r\n\r\n".encode(), size)
    for n, r in enumerate(warc.chunks_of("f", source, 65536), 1):
        assert len(r["data"]) <= 65536
    assert n == size // 65536 and r["payload_bytes"] == size and source.most <= 65536


def test_query_matches_sql(spark, duck, data_dir):
    from spanlight.llm.queries import ORACLE_SQL, QUERIES

    got = QUERIES["op13_warc"](spark, data_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = duck.sql(ORACLE_SQL["op13_warc"]).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
