"""The registered queries themselves, over the smallest tables, against brute force."""

import os
import struct
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from test_katz import by_crc, check
from test_mixing_sharding import plain_shards
from tokenizers import Tokenizer

from tessera.llm import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_search_finds_the_nearest(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    got = {}
    for r in catalog.op4_ann(spark, SF).collect():
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), rel=1e-12)
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    hits = 0
    for q in (i for i in x if i % 20 == 0):
        want = [i for _, i in sorted((-float(x[q] @ x[i]), i) for i in x if i != q)[:20]]
        found = sorted(got.pop(q))
        assert [k for k, _ in found] == list(range(1, 21))
        hits += len(set(want) & {i for _, i in found}) / 20
    assert not got and hits >= 0.99 * sum(i % 20 == 0 for i in x)


def test_tokens_are_the_librarys(spark, documents):
    theirs = Tokenizer.from_file(public_tokenizers.path(catalog.TOKENIZER))
    want = []
    for r in documents:
        ids = theirs.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()))
    assert sorted(tuple(r) for r in catalog.op6_bpe(spark, SF).collect()) == sorted(want)


def test_scores_are_a_plain_models(spark, documents):
    check(catalog.op7_katz(spark, SF).collect(), [(r["doc_id"], r["text"]) for r in documents], by_crc)


def boxes(data, start, end):
    while start < end:
        size, kind = struct.unpack_from(">I4s", data, start)
        yield kind, start + 8, start + size
        start += size


def find(data, *path):
    start, end = 0, len(data)
    for name in path:
        start, end = next((a, b) for kind, a, b in boxes(data, start, end) if kind == name)
    return data[start:end]


def described(data):
    """Payload and feature of a container, by a reader of its own."""
    table = lambda name: find(data, b"moov", b"trak", b"mdia", b"minf", b"stbl", name)
    scale, duration = struct.unpack_from(">II", find(data, b"moov", b"trak", b"mdia", b"mdhd"), 12)
    each, n = struct.unpack_from(">II", table(b"stsz"), 4)
    starts = struct.unpack_from(f">{struct.unpack_from('>I', table(b'stco'), 4)[0]}I", table(b"stco"), 8)
    runs = [struct.unpack_from(">III", table(b"stsc"), 8 + 12 * k) for k in range(struct.unpack_from(">I", table(b"stsc"), 4)[0])]
    places = []
    for chunk, at in enumerate(starts, 1):
        count = [r[1] for r in runs if r[0] <= chunk][-1]
        places += [at + each * k for k in range(count)]
    assert len(places) == n
    keys = struct.unpack_from(f">{struct.unpack_from('>I', table(b'stss'), 4)[0]}I", table(b"stss"), 8)
    ranges = [(places[k - 1], each) for k in keys]
    digest = sha256(b"".join(struct.pack(">qq", *r) for r in ranges)).hexdigest()[:16]
    codec = table(b"stsd")[12:16].decode().strip()
    ends = ",".join(f"{o}+{s}" for o, s in (ranges[0], ranges[-1]))
    return b"".join(data[p : p + each] for p in places), f"codec={codec};duration={duration}/{scale};samples={n};keyframes={len(keys)}:{ends};ranges={digest}"


def test_media_digests_are_those_of_another_reader(spark, documents):
    from tessera.llm import media

    stored = {r["doc_id"]: bytes(r["media"]) for r in media.pack_texts(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")).collect()}
    want = []
    for r in documents:
        text = (r["text"] or "").encode()
        payload = text + b" " * (-len(text) % 192 if text else 192)
        data = stored[r["doc_id"]]
        read, feature = described(data)
        assert read == payload
        want.append((r["doc_id"], len(text), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), sha256(data).hexdigest(), feature))
    assert sorted(tuple(r) for r in catalog.op9_media(spark, SF).collect()) == sorted(want)


def test_shards_are_those_of_a_plain_sort(spark, documents):
    size = {r["doc_id"]: len((r["text"] or "").encode()) + 1 for r in documents}
    crc = {r["doc_id"]: zlib.crc32((r["text"] or "").encode()) for r in documents}
    place = plain_shards([(r["doc_id"], r["source"]) for r in documents], catalog.SHARDS, lambda i, s: f"{'n' if s is None else 'v' + s}\x1fv{size[i]}\x1fv{crc[i]}")
    want = [(i, size[i], crc[i], "rows", *place[i], None) for i in size]
    assert sorted(tuple(r) for r in catalog.op10_sharding(spark, SF).collect()) == sorted(want)
