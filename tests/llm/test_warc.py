import gzip
import hashlib
import io
import json
import random

import pytest

from skyloom.llm import common, warc

duckdb = pytest.importorskip("duckdb")
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, first int")


def home(spark):
    return common.shared_folder(spark) + "/warc-tests"


def archives(spark, rows, archive=warc.ARCHIVE):
    whole = warc.write(warc.planned(pages(spark, rows)), home(spark), archive)
    return whole, warc.normalise(whole, home(spark))


def wanted(rows):
    """By plain Python."""
    firsts, out = {}, []
    for i, _, t in rows:
        p = (t or "").encode()
        if len(p) >= 100 and i is not None:
            firsts[p] = min(firsts.get(p, i), i)
    for i, _, t in rows:
        p = (t or "").encode()
        first = firsts.get(p)
        revisit = first is not None and first != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/é b\r\nX: y", "ä" * 50), (2, None, "ä" * 50), (9, "http://c", "ä" * 50), (None, "http://n", "ä" * 50), (3, "u", "x" * 99), (4, "u", "x" * 99), (6, "u", None), (7, "u", ""),
    (8, "u", "long " * 300_000), (1, "u", "long " * 300_000), (10, "u", "z\r\n\r\nWARC/1.1\r\n\r\n" * 9), (10, "u", "z\r\n\r\nWARC/1.1\r\n\r\n" * 9), (None, None, "q" * 200), (None, None, "q" * 200), (-3, "u", "-" * 100), (-2, "u", "-" * 100),
]


@pytest.mark.parametrize("archive", [1, 2000, warc.ARCHIVE])
def test_pages_come_back(spark, archive):
    whole, manifest = archives(spark, ROWS, archive)
    got = warc.read(manifest).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == wanted(ROWS)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert {r.url for r in got if r.page_id == 5} == {"http://a/%C3%A9%20b%0D%0AX:%20y"} and {r.url for r in got if r.page_id == 2} == {None}
    assert whole.agg({"records": "sum"}).first()[0] == manifest.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_archives_are_one_stream_and_then_members(spark):
    whole, manifest = archives(spark, ROWS)
    for r in whole.collect():
        raw = open(r.file.removeprefix("file:"), "rb").read()
        machine = __import__("zlib").decompressobj(31)
        machine.decompress(raw)
        assert machine.eof and not machine.unused_data
    for r in manifest.collect():
        raw = open(r.file.removeprefix("file:"), "rb").read()
        lines = [json.loads(x) for x in open(r.sidecar.removeprefix("file:"))]
        assert [x["offset"] for x in lines] == [sum(y["length"] for y in lines[:i]) for i in range(len(lines))]
        assert sum(x["length"] for x in lines) == len(raw) == r.bytes and len(lines) == r.records and r.problem is None
        for x in lines:
            one = gzip.decompress(raw[x["offset"] : x["offset"] + x["length"]])
            assert one.startswith(b"WARC/1.1\r\n") and x["id"].encode() in one and one.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    whole, manifest = archives(spark, [])
    assert whole.count() == manifest.count() == warc.read(manifest).count() == 0


def test_digests_joined_in_two_ways_agree(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "u", rng.choice(["hot " * 50, f"{i % 7} " * 60, f"{i} " * 40])) for i in range(3000)]
    monkeypatch.setattr(warc, "MOST_SENT", 2)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in warc.read(archives(spark, rows, 100_000)[1], False, 50_000).collect()), key=str) == wanted(rows)


def raw_records(n):
    return [b"".join(warc.record(i, f"http://x/{i}", hashlib.sha256(b"p%d" % i).hexdigest(), len(b"p%d" % i), b"p%d" % i, None)) + b"\r\n\r\n" for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_any_number_of_members(chunk, monkeypatch):
    monkeypatch.setattr(warc.inflated, "__defaults__", (chunk,))
    monkeypatch.setattr(warc, "CHUNK", chunk)
    records = raw_records(5)
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records)), b"".join(records), gzip.compress(b"".join(records[:2])) + b"\0" * 9 + gzip.compress(b"".join(records[2:]))):
        out, index = io.BytesIO(), io.BytesIO()
        assert warc.rewritten(io.BytesIO(data), out, index, "f") == (5, len(out.getvalue()), None)
        for x, r in zip(map(json.loads, index.getvalue().splitlines()), records, strict=True):
            assert gzip.decompress(out.getvalue()[x["offset"] :][: x["length"]]) == r


def test_damage_is_told_and_what_is_whole_stays():
    data = gzip.compress(b"".join(raw_records(5)), mtime=0)
    for cut, least in ((data[:-9], 4), (data[: len(data) // 2], 0), (data[:3], 0), (data + b"junk", 5), (b"", 0), (b"no gzip", 0), (gzip.compress(b"".join(raw_records(3)) + b"WARC/1.1\r\nContent-Length: x\r\n\r\n"), 3), (gzip.compress(b"".join(raw_records(3))[:-20]), 2)):
        out, index = io.BytesIO(), io.BytesIO()
        records, _, problem = warc.rewritten(io.BytesIO(cut), out, index, "f")
        assert records >= least and records == len(index.getvalue().splitlines()) and bool(problem) == (cut != b"")


def test_a_changed_payload_is_an_error():
    head, block = warc.record(1, "u", hashlib.sha256(b"a").hexdigest(), 1, b"b", None)
    with pytest.raises(warc.Damaged):
        warc.told(*warc.parsed(gzip.compress(head + block + b"\r\n\r\n")))
    with pytest.raises(warc.Damaged):
        warc.parsed(gzip.compress(head + block))


def test_other_makers_records():
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1-2>\r\nContent-Type: application/warc-fields\r\nContent-Length: 9\r\n\r\nsoftware:\r\n\r\n"
    fields, http, payload = warc.parsed(gzip.compress(info))
    assert warc.page_of(fields["warc-record-id"]) is None and payload == b"software:" and warc.told(fields, http, payload)[0] == 9


def test_query_equals_its_sql(spark):
    c = duckdb.connect()
    c.sql("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    got = warc.op13_warc(spark, "/root/testdata/sf0.01").select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(c.sql(f"SELECT {', '.join(COLUMNS)} FROM ({warc.ORACLE_SQL})").fetchall(), key=str)
