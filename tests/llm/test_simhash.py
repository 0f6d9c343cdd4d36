import os
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import catalog, simhash

SF = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(values):
    """Smallest member that each is linked to, by all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "ÀB àb Zz q", "a\x0bb\x0cc\x85d \x1c e f", "w " * 700, " ".join(f"w{i % 97}" for i in range(70_000))])
def test_fingerprints(text):
    assert simhash.fingerprint(text.encode()) == plain(text)


def test_bit_counts():
    h = np.random.default_rng(0).integers(0, 1 << 64, 1000, dtype=np.uint64)
    assert simhash._bit_counts(h).tolist() == [int(((h >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


def near(rng, centre, n, bits):
    return {int(centre) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, bits + 1), replace=False)) for _ in range(n)}


@pytest.mark.parametrize(("hot", "small", "blocks"), [(20_000, 48, 5), (8, 48, 5), (20_000, 2, 6), (8, 2, 7), (8, 48, 6)])
def test_links_join_the_same_as_all_pairs(spark, monkeypatch, hot, small, blocks):
    monkeypatch.setattr(simhash, "SMALL_GROUP", small)
    rng = np.random.default_rng(3)
    values = set()
    for c in rng.integers(0, 1 << 64, 12, dtype=np.uint64):
        values |= near(rng, c, 40, 6)
    values = sorted(values)
    root = brute(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = simhash.star_components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), hot, blocks)).collect()
    mine = {r["node"]: r["root"] for r in got}
    by = {}
    for v, r in zip(signed, root, strict=True):
        by.setdefault(r, set()).add(mine.get(v, v))
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)


def test_blocks_follow_the_count_and_pivots_do_the_discarding():
    assert [simhash.blocks_for(n) for n in (0, 1 << 27, 1 << 28, 1 << 35)] == [5, 5, 6, 7]
    rng = np.random.default_rng(8)
    centre = rng.integers(0, 1 << 64, 3, dtype=np.uint64)
    fps = np.array(sorted(near(rng, centre[0], 60, 3) | near(rng, centre[1], 60, 9) | {int(centre[2])}), np.uint64)
    for n in (5, 6, 7):
        made, left, verified = simhash.pair_counts(fps, n)
        assert made >= left >= verified > 0 and made > left


def test_pivots_discard_no_link():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    b = a ^ np.array([sum(1 << int(x) for x in rng.choice(64, 3, replace=False)) for _ in a], np.uint64)
    fps = np.concatenate([a, b])
    i, j = simhash._survivors(simhash.pivot_table(fps), fps, np.arange(500), np.arange(500, 1000))
    assert len(i) == 500 and (j - i == 500).all()


def test_components_of_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = simhash.components(odd).collect()
    assert len(got) == len(rows)
    root = brute([plain(t) for _, t in rows])
    want = []
    for (i, t), r in zip(rows, root, strict=True):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None]
        want.append((i, f"{plain(t):016x}", min(ids, default=None)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert simhash.components(none).count() == 0


def test_one_of_each_group_stays(spark, odd, none):
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    root = brute([plain(r["text"]) for r in rows])
    assert root == list(range(len(rows)))
    groups = len(set(brute([plain(r["text"]) for r in odd.collect()])))
    assert len(rows) == groups
    assert 1 in {r["doc_id"] for r in rows} and 2 not in {r["doc_id"] for r in rows}
    assert simhash.deduplicate(none).count() == 0


def test_one_id_with_two_texts(spark):
    df = spark.createDataFrame([(5, "one thing entirely here"), (5, "another matter of course"), (3, "another matter of course")], "doc_id long, text string")
    kept = simhash.deduplicate(df)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(3, "another matter of course"), (5, "one thing entirely here")]


def test_chains_are_followed(spark):
    chain = [(1 << (3 * k)) - 1 for k in range(21)]
    edges = [(max(a, b), min(a, b)) for a, b in zip(chain, chain[1:], strict=False)]
    got = simhash.star_components(spark.createDataFrame(edges, "a long, b long"))
    assert got.select("root").distinct().count() == 1 and got.count() == 21
    assert simhash.star_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_group_gives_a_forest():
    rng = np.random.default_rng(5)
    fps = np.array(sorted(near(rng, rng.integers(0, 1 << 64, dtype=np.uint64), 400, 3)), np.uint64)
    a, b = simhash._forest(fps)
    assert len(a) < len(fps) and (np.bitwise_count(a ^ b) <= 3).all()


def test_only_id_and_text_are_read(spark, odd):
    plan = simhash.fingerprints(odd.withColumn("n", F.rand())).columns
    assert plan == ["doc_id", "fingerprint"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_the_query_equals_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    values = [plain(r["text"]) for r in rows]
    root = brute(values)
    least = {}
    for r, k in zip(rows, root, strict=True):
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    want = sorted((r["doc_id"], f"{v:016x}", least[k]) for r, v, k in zip(rows, values, root, strict=True))
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in catalog.op1_simhash(spark, SF).collect()) == want
