import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 64))
    return (centres[rng.integers(0, 20, 3000)] + 0.7 * rng.normal(size=(3000, 64))).astype(np.float32)


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")


def truth(ids, x, queries, k=20):
    x = x.astype(float)
    out = {}
    for q in queries:
        s = x @ x[ids.index(q)]
        out[q] = [i for _, i in sorted((-v, i) for v, i in zip(s.tolist(), ids, strict=True) if i != q)[:k]]
    return out


@pytest.mark.parametrize("how", [{}, {"row_block": 70}, {"cell_rows": 100, "probes": 12}])
def test_recall(spark, vectors, how):
    ids = list(range(len(vectors)))
    got = ann.search(frame(spark, ids, vectors), F.col("id") % 20 == 0, rerank=100, **how).collect()
    want = truth(ids, vectors, ids[::20])
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(want)
    hits = 0
    for q, rows_ in found.items():
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 21))
        order = [(-s, i) for _, i, s in rows_]
        assert order == sorted(order)
        for _, i, s in rows_:
            assert s == pytest.approx(float(np.dot(vectors[q].astype(float), vectors[i].astype(float))), rel=1e-12)
        hits += len({i for _, i, _ in rows_} & set(want[q]))
    assert hits / (20 * len(want)) > 0.95


def test_training_lowers_the_anisotropic_loss(vectors):
    x = vectors[:1500].astype(float)
    book = ann.train(x)
    plain = book._replace(eta=1.0)
    assert book.eta > 1
    assert ann.loss(x, book, ann.assign(x, book)) <= ann.loss(x, book, ann.assign(x, plain)) + 1e-12
    assert ann.loss(x, book, ann.assign(x, book, 3)) <= ann.loss(x, book, ann.assign(x, book, 1)) + 1e-12


def test_parallel_residuals_shrink(vectors):
    x = vectors[:1500].astype(float)

    def parallel(book):
        parts = ann._split(x)
        r = parts - book.centroids[np.arange(parts.shape[1]), ann.assign(x, book)]
        return float((((r * parts).sum(axis=(1, 2)) / np.linalg.norm(x, axis=1)) ** 2).mean())

    book = ann.train(x)
    assert parallel(book) < parallel(book._replace(eta=1.0))


def test_scans_equal_sums_of_centroids(vectors):
    x, q = vectors[:300].astype(float), vectors[300:310].astype(float)
    book = ann.train(x, rounds=2)
    codes = ann.assign(x, book)
    near = book.centroids[np.arange(codes.shape[1]), codes].reshape(len(x), -1)
    t, packed = ann.tables(q, book), ann.packed(codes)
    got = sum(t[k][packed[:, k]] for k in range(packed.shape[1]))
    assert np.allclose(got, near @ q.T, atol=1e-3)
    query, row = ann.scan(q, packed, book, 20)
    for i in range(len(q)):
        assert set(row[query == i]) == set(np.lexsort((np.arange(300), -got[:, i]))[:20])


def test_equal_vectors_keep_the_smallest_ids(spark):
    x = np.ones((400, 6), np.float32)
    got = ann.search(frame(spark, range(400), x), F.col("id") % 20 == 0, rerank=30, row_block=64).collect()
    for q in range(0, 400, 20):
        assert sorted(r["vec_id"] for r in got if r["query_id"] == q) == [i for i in range(21) if i != q][:20]


def test_cells_that_are_probed_hold_enough_rows():
    q, centroids = np.array([[1.0, 0.0], [0.0, 1.0]]), np.array([[1.0, 0.0], [0.5, 0.5], [0.0, 1.0], [9.0, 9.0]])
    got = ann.probed(q, np.array([1, 12]), centroids, np.array([3, 5, 6, 0]), 1)
    assert [x.tolist() for x in got] == [[0], [2, 1, 0]]


def test_rows_are_shuffled_once_however_many_queries(spark, vectors):
    few = ann.search(frame(spark, range(3000), vectors), F.col("id") == 0, cell_rows=100, probes=2)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Generate" not in plan
    assert few.count() == 20


def test_a_hot_id_is_spread_and_still_answered(spark, vectors):
    ids = [0] * 1500 + list(range(1, 1501))
    got = ann.search(frame(spark, ids, vectors), F.col("id") % 20 == 0, row_block=50, cell_rows=100, probes=1).collect()
    assert sorted(r["rank"] for r in got if r["query_id"] == 0) == list(range(1, 21))
    assert all(r["vec_id"] for r in got if r["query_id"] == 0)


def test_classes_of_equal_rows():
    x = np.array([[3.0, 1], [1, 1], [3, 1], [0, 2], [1, 1], [1, 1]])
    first, members, start, size = ann.classes(x)
    assert first.tolist() == [0, 1, 3] and members.tolist() == [0, 2, 1, 4, 5, 3] and start.tolist() == [0, 2, 5] and size.tolist() == [2, 3, 1]


def test_many_copies_crowd_nothing_out(spark, vectors):
    x = np.concatenate([vectors[:600], np.repeat(vectors[:1] * 1.5, 2000, axis=0)])
    order = np.random.default_rng(1).permutation(len(x))
    x, ids = x[order], list(range(len(x)))
    got = ann.search(frame(spark, ids, x), F.col("id") % 20 == 0, rerank=100).collect()
    want = truth(ids, x, ids[::20])
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found & {(q, i) for q, v in want.items() for i in v}) > 0.97 * 20 * len(want)


def test_odd_vectors(spark):
    good = [(i, [float(i % 7 + 1), 1.0, -2.0]) for i in range(30)]
    bad = [(40, None), (60, []), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [1.0, math.nan, 2.0]), (140, [1.0, math.inf, 2.0]), (160, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(good + good[:1] + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("id", F.lit(1))
    got = ann.search(df, F.col("id") % 20 == 0).collect()
    assert {r["query_id"] for r in got} == {0, 20} and {r["vec_id"] for r in got} <= set(range(30))
    assert len(got) == 40
    few = ann.search(df.filter("vec_id < 5"), F.col("id") % 20 == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2, 3, 4]
    assert ann.search(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert ann.search(df.filter("vec_id in (3, 4)"), F.col("id") % 20 == 0).count() == 0
