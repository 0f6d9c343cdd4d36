import base64
import io
import os
import zipfile
from hashlib import sha1

import pytest
from duck import same
from pyspark.sql import functions as F

from tessera.llm import warc


def reader(data):
    return lambda offset, n: data[offset : offset + n]


def zipped(members, method=zipfile.ZIP_STORED, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members:
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"a note PK\5\6 that looks like an end"])
def test_members_are_located(comment):
    data = zipped([("a/b", b"one"), ("c", b"two" * 1000)], comment=comment)
    assert [m.name for m in warc.directory(reader(data), len(data))] == ["a/b", "c"]
    at, n = warc.locate(reader(data), len(data), "c")
    assert data[at : at + n] == b"two" * 1000


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = zipped([("first", b"x" * 150), ("second", b"y" * 300), ("third", b"z")])
    assert b"PK\6\6" in data and b"PK\6\7" in data
    for name, want in (("first", b"x" * 150), ("second", b"y" * 300), ("third", b"z")):
        at, n = warc.locate(reader(data), len(data), name)
        assert data[at : at + n] == want


@pytest.mark.parametrize("data", [b"", b"no zip at all", zipped([("a", b"x")])[:-5]])
def test_no_zip(data):
    with pytest.raises(ValueError):
        warc.directory(reader(data), len(data))


def test_compressed_and_missing_members():
    data = zipped([("a", b"x" * 100)], zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        warc.locate(reader(data), len(data), "a")
    with pytest.raises(ValueError, match="no member"):
        warc.locate(reader(data), len(data), "b")


def test_records_round_trip():
    payload = "é\r\n\r\n🙂".encode()
    r = warc.parse(warc.record(7, "http://x/\r\ny", payload))
    assert (r.page_id, r.kind, r.payload, r.payload_bytes, r.refers_to, r.url) == (7, "response", payload, len(payload), None, "http://x/%0D%0Ay")
    v = warc.parse(warc.record(9, None, payload, 7))
    assert (v.page_id, v.kind, v.payload_bytes, v.refers_to, v.url) == (9, "revisit", len(payload), 7, None)
    assert v.digest == r.digest == base64.b32encode(sha1(payload).digest()).decode()
    assert warc.parse(warc.record(None, None, b"")).page_id is None


def odd_pages(spark):
    same_html = "<p>same</p>" * 50
    rows = [(5, "u", same_html), (3, None, same_html), (4, "u\nv", same_html), (4, "u", same_html), (1, "u", None), (2, "u", ""), (None, "u", same_html), (9, None, "🙂" * 40_000), (10, "u", "tiny"), (11, "u", "tiny")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)


def expected(pages, least):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    out = []
    for i, p in rows:
        ids = [j for j, q in rows if q == p and j is not None]
        refers = min(ids) if i is not None and len(p) >= least and min(ids) != i else None
        out.append((i, len(p), base64.b32encode(sha1(p).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "size"), [(0, 256 << 20), (100, 200)])
def test_odd_pages(spark, least, size):
    pages = odd_pages(spark)
    packages = warc.write(pages, least, package_bytes=size)
    assert packages.agg(F.sum("n_records")).first()[0] == 10
    if size == 200:
        assert packages.count() > 3
    got = warc.read(packages)
    rows = got.collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows], key=repr) == expected(pages, least)
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in rows)
    assert {bytes(r["payload"]).decode() for r in rows if r["page_id"] == 9} == {"🙂" * 40_000}


def test_no_pages(spark):
    packages = warc.write(odd_pages(spark).limit(0))
    assert packages.count() == 0 and warc.read(packages).count() == 0


def test_packages_are_plain_zips_of_gzip_members(spark):
    import gzip

    path = warc.write(odd_pages(spark).coalesce(1)).first()["path"].removeprefix("file://")
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
        text = gzip.decompress(z.read(warc.DATA))
        assert text.count(b"WARC/1.1\r\n") == 10 and z.read(warc.INDEX).count(b"\n") == 10


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", ["op3_chat", "op5_mixing", "op8_warc"])
def test_queries_equal_their_sql(spark, name):
    from tessera.llm import catalog

    same(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"), catalog.ORACLES[name], "/root/testdata/sf0.001")
