"""WARC archives: round trips, revisits, foreign archives, and odd rows."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from parcelscope.llm import hot, queries, warc

from conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, digest string, size int, chunk int, revisit boolean"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, True) for r in rows], SCHEMA)


def _expected(rows):
    first = {}
    for i, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        again = len(b) >= 100 and b in first and i != first[b]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None, True))
    return sorted(map(str, out))


def _round_trip(spark, pages, folder, **how):
    manifest = warc.write_archives(warc.records(pages), folder, **how)
    got = warc.digest(warc.payloads(warc.read_chunks(manifest, how.get("chunk", warc.CHUNK))))
    return manifest, sorted(str(tuple(r)) for r in got.collect())


ROWS = [(i, f"http://h/{i % 7}", f"<p>{'word ' * (i % 60)}{i % 5}</p>") for i in range(300)]
ODD = [(1000, None, None), (1001, "http://h/ \r\nX-Evil: 1", ""), (None, "http://n", "n" * 150), (None, "http://n", "m" * 150), (1003, "u", "m" * 150),
       (1004, "http://é", "é漢字😀" * 5000), (1005, "http://é", "é漢字😀" * 5000), (1006, "a", "\r\n\r\nWARC/1.1\r\n\r\n" * 40), (7, ROWS[7][1], ROWS[7][2]),
       (-5, "neg", "é漢字😀" * 5000), (1007, "x", "y" * 99), (1008, "x", "y" * 99), (1009, "x", "y" * 100), (1010, "x", "y" * 100)]


@pytest.mark.parametrize("how", [{}, {"chunk": 1000, "archive": 20_000, "segment": 3000}, {"chunk": 7, "segment": 1}])
def test_round_trip(spark, tmpdir_path, how):
    rows = ROWS + ODD
    manifest, got = _round_trip(spark, _pages(spark, rows).repartition(4), tmpdir_path, **how)
    assert got == _expected(rows)
    segments = manifest.collect()
    assert sum(s.stop - s.start for s in segments) == sum(os.path.getsize(os.path.join(tmpdir_path, f)) for f in os.listdir(tmpdir_path)
                                                          if f.endswith(".gz"))
    if "archive" in how:
        assert len({s.path for s in segments}) > 4 and len(segments) > len({s.path for s in segments})


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(str(tuple(r)) for r in queries.op13_warc(spark, SF_SMALL).collect()) == _expected(rows)


def test_chunks_carry_the_digest_so_far(spark, tmpdir_path):
    text = "0123456789" * 55
    manifest = warc.write_archives(warc.records(_pages(spark, [(1, "u", text)])), tmpdir_path, chunk=100)
    rows = sorted(warc.read_chunks(manifest, 64).collect(), key=lambda r: r.chunk)
    assert [r.chunk for r in rows] == list(range(9)) and [r.last for r in rows] == [False] * 8 + [True]
    for r in rows:
        upto = text[:64 * (r.chunk + 1)].encode()
        assert r.bytes_so_far == len(upto) and r.digest_so_far == hashlib.sha256(upto).hexdigest()
    assert b"".join(r.data for r in rows).decode() == text


def test_empty_table(spark, tmpdir_path):
    manifest, got = _round_trip(spark, _pages(spark, []), tmpdir_path)
    assert manifest.count() == 0 and got == []


def _record(kind, body, extra=""):
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{kind}>\r\n{extra}Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("form", ["plain", "whole", "members"])
def test_archives_of_other_programs(spark, tmpdir_path, form):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    body = bytes(range(256)) * 3000
    records = [_record("warcinfo", b"software: x\r\n"), _record("response", http + body, "Content-Type: application/http; msgtype=response\r\n"),
               _record("metadata", b""), _record("resource", b"\r\n\r\nlines\r\n\r\n")]
    path = os.path.join(tmpdir_path, "a.warc" + (".gz" if form != "plain" else ""))
    with open(path, "wb") as f:
        f.write({"plain": lambda: b"".join(records), "whole": lambda: gzip.compress(b"".join(records)),
                 "members": lambda: b"".join(map(gzip.compress, records))}[form]())
    rows = warc.read_chunks(warc.archives(spark, [path]), 1 << 16).collect()
    data = {}
    for r in sorted(rows, key=lambda r: r.chunk):
        data[r.record_type] = data.get(r.record_type, b"") + r.data
    assert data == {"warcinfo": b"software: x\r\n", "response": body, "metadata": b"", "resource": b"\r\n\r\nlines\r\n\r\n"}
    assert all(r.intact for r in warc.payloads(warc.read_chunks(warc.archives(spark, [path]))).collect())


def test_a_cut_off_archive_is_told(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "cut.warc")
    with open(path, "wb") as f:
        f.write(_record("resource", b"x" * 5000)[:3000])
    with pytest.raises(Exception, match="cut off"):
        warc.read_chunks(warc.archives(spark, [path])).collect()


def test_memory_does_not_grow_with_a_record(tmpdir_path):
    """A record of 64 MB, zeros mostly, is read in chunks; what the stream holds stays within a few blocks."""
    path = os.path.join(tmpdir_path, "big.warc.gz")
    with gzip.open(path, "wb", compresslevel=1) as f:
        f.write(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 67108864\r\n\r\n")
        for _ in range(64):
            f.write(bytes(1 << 20))
        f.write(b"\r\n\r\n")
    most = 0
    real = warc.Stream._fill

    def measured(self):
        nonlocal most
        out = real(self)
        most = max(most, len(self.held) + len(self.raw))
        return out

    warc.Stream._fill = measured
    try:
        last = None
        for last in warc.record_chunks(path, 0, None, 1 << 20):
            assert len(last[2]) <= 1 << 20
    finally:
        warc.Stream._fill = real
    assert last[3] == 1 << 26 and last[5] and last[4] == hashlib.sha256(bytes(1 << 26)).hexdigest()
    assert most <= (1 << 20) + 3 * warc.BLOCK


def test_groups_join_the_same_way_beyond_the_broadcast(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 != 1, F.col("id") % 200).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 10")
    a = sorted(map(str, hot.join_groups(rows, groups, ["k"], "n").collect()))
    hot_before = hot.HEAVY
    hot.HEAVY = 20
    try:
        b = sorted(map(str, hot.join_groups(rows, groups, ["k"], "n", limit=0).collect()))
    finally:
        hot.HEAVY = hot_before
    assert a == b and len(a) == 4000
