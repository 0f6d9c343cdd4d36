"""Approximate maximum inner product search: anisotropic product quantisation, four-bit table scans, exact reranking.

Training (on a bounded sample, SAMPLE rows drawn by hash): vectors are cut into subspaces of two dimensions
with 16 centroids each. The loss of a vector x with residual r weighs the part of r parallel to x ETA times as
much as the rest, since it alone changes inner products with queries that point at x. Assignments and
centroids are improved in turn, one subspace at a time with the others held, which never raises the loss.

Index: every row is encoded, two four-bit codes to a byte, and dealt into blocks by the hash of id and vector, so that copies
spread. Rows are shuffled once, to their block; queries, the small side, go to every block and stream past it. There the query's table of inner products with all
centroids is scanned by the codes; the RERANK best are scored exactly in double precision, and the best k go on to one merge by
query. Rows of a block with equal codes are scanned as one and scored exactly all together: however many copies or close
neighbours share a code, they crowd nothing out and none is left out. Ties go to the smaller id.

Every query meets every row's codes, so work grows as queries times rows: no coarse cells decide what is looked at, and
recall doesn't depend on how vectors lie. With `probes` the sample also gives coarse cells by k-means, one for each CELL_ROWS
rows of the table, but at most one for SAMPLE_ROWS rows of the sample. Rows lie in the cell of their nearest centroid, and a
query goes to the `probes` cells whose centroids have the largest inner products with it, or as many more as hold enough
candidates. That is for vectors in clusters: measure recall before using it. Memory of a task is a block and a batch of queries.

Edge cases. Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without an id or with another length than the most common one (of those, the longest). A row that repeats is a candidate
each time; a query id that repeats is searched once, with its smallest vector. Fewer than k candidates: all
are returned. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import drawn, stored

SAMPLE = 20_000
#: Threshold of the score-aware loss: queries count whose cosine with a vector is at least this.
COSINE = 0.2
SUB, CENTROIDS, ROUNDS = 2, 16, 8
#: Rows returned, and rows of a block that are scored exactly, for each query.
K, RERANK = 20, 100
#: Rows in a coarse cell on average, and rows of the sample for each cell at least.
CELL_ROWS, SAMPLE_ROWS = 4_096, 32
#: Most rows in a block of the index; small tables have blocks of a 16th of their rows, but not under 1,024.
ROW_BLOCK = 32_768
#: Rows and queries that are scanned at once.
_ROWS, _QUERIES = 2_048, 128


class Codebook(NamedTuple):
    centroids: np.ndarray  # subspaces x CENTROIDS x SUB, float64
    eta: float
    dim: int


def eta_of(dim: int, cosine: float = COSINE) -> float:
    """Weight of the parallel residual against the orthogonal one, by the threshold on the cosine."""
    return max(1.0, (dim - 1) * cosine**2 / (1 - cosine**2))


def _split(x: np.ndarray) -> np.ndarray:
    """rows x subspaces x SUB; an odd last dimension is filled with zero."""
    if x.shape[1] % SUB:
        x = np.column_stack([x, np.zeros(len(x))])
    return x.reshape(len(x), -1, SUB)


def assign(x: np.ndarray, book: Codebook, sweeps: int = 2, codes: np.ndarray | None = None) -> np.ndarray:
    """Codes (rows x subspaces, uint8) by coordinate descent on the anisotropic loss."""
    parts = _split(x)
    u = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
    if codes is None:
        codes = np.stack([((parts[:, s, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1) for s, c in enumerate(book.centroids)], axis=1).astype(np.uint8)
    residual = parts - book.centroids[np.arange(parts.shape[1]), codes]
    along = (residual * u).sum(axis=2)
    total = along.sum(axis=1)
    for _ in range(sweeps):
        for s, c in enumerate(book.centroids):
            r = parts[:, s, None, :] - c[None]
            dots = (r * u[:, s, None, :]).sum(axis=2)
            others = total - along[:, s]
            best = ((r**2).sum(axis=2) + (book.eta - 1) * (others[:, None] + dots) ** 2).argmin(axis=1)
            codes[:, s], along[:, s] = best, dots[np.arange(len(x)), best]
            total = others + along[:, s]
    return codes


def loss(x: np.ndarray, book: Codebook, codes: np.ndarray) -> float:
    """Mean anisotropic loss."""
    parts = _split(x)
    r = parts - book.centroids[np.arange(parts.shape[1]), codes]
    u = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
    return float(((r**2).sum(axis=(1, 2)) + (book.eta - 1) * (r * u).sum(axis=(1, 2)) ** 2).mean())


def train(x: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Codebook:
    """Codebooks for the rows of x (float64)."""
    rng, parts = np.random.default_rng(seed), _split(x)
    pick = rng.integers(0, len(x), (parts.shape[1], CENTROIDS))
    book = Codebook(np.stack([parts[p, s] for s, p in enumerate(pick)]).copy(), eta_of(x.shape[1]), x.shape[1])
    for _ in range(rounds):  # plain k-means first
        for s, c in enumerate(book.centroids):
            near = ((parts[:, s, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            n = np.bincount(near, minlength=CENTROIDS)
            sums = np.stack([np.bincount(near, parts[:, s, d], CENTROIDS) for d in range(SUB)], axis=1)
            c[n > 0] = sums[n > 0] / n[n > 0, None]
    u = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
    codes = None
    for _ in range(rounds):
        codes = assign(x, book, 1, codes)
        along = ((parts - book.centroids[np.arange(parts.shape[1]), codes]) * u).sum(axis=2)
        total = along.sum(axis=1)
        for s, c in enumerate(book.centroids):
            others, w = total - along[:, s], book.eta - 1
            # Minimise the sum over members of |x - c|^2 + w (others + u . (x - c))^2: a linear system for each centroid.
            left = w * u[:, s, :, None] * u[:, s, None, :] + np.eye(SUB)
            right = parts[:, s] + w * u[:, s] * (others + (u[:, s] * parts[:, s]).sum(axis=1))[:, None]
            for k in range(CENTROIDS):
                if (at := codes[:, s] == k).any():
                    c[k] = np.linalg.solve(left[at].sum(axis=0), right[at].sum(axis=0))
            along[:, s] = ((parts[:, s] - c[codes[:, s]]) * u[:, s]).sum(axis=1)
            total = others + along[:, s]
    return book


def packed(codes: np.ndarray) -> np.ndarray:
    """Two four-bit codes to a byte; an odd last one is paired with code 0."""
    if codes.shape[1] % 2:
        codes = np.column_stack([codes, np.zeros(len(codes), np.uint8)])
    return (codes[:, 0::2] | codes[:, 1::2] << 4).astype(np.uint8)


def tables(q: np.ndarray, book: Codebook) -> np.ndarray:
    """bytes x 256 x queries (float32): the inner product of each query with what each byte of codes stands for."""
    t = np.einsum("qsd,skd->skq", _split(q), book.centroids).astype(np.float32)
    if len(t) % 2:
        t = np.concatenate([t, np.zeros((1, *t.shape[1:]), np.float32)])
    low, high = t[0::2], t[1::2]
    return (high[:, :, None, :] + low[:, None, :, :]).reshape(len(low), 256, -1)


def _best(query: np.ndarray, row: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best `keep` of each query, ties to the smaller row."""
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    first = np.searchsorted(query, query)
    at = np.arange(len(query)) - first < keep
    return query[at], row[at], score[at]


def scan(q: np.ndarray, codes: np.ndarray, book: Codebook, keep: int = RERANK) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs: the rows of the `keep` best approximate scores for each query, by four-bit tables."""
    out_q, out_r = [], []
    for a in range(0, len(q), _QUERIES):
        t = tables(q[a : a + _QUERIES], book)
        floor = np.full(t.shape[2], -np.inf, np.float32)
        none = np.zeros(0, np.int64)
        held, fresh = (none, none, np.zeros(0, np.float32)), []
        for b in range(0, len(codes), _ROWS):
            c = codes[b : b + _ROWS]
            s = t[0][c[:, 0]]
            for k in range(1, c.shape[1]):
                s += t[k][c[:, k]]
            if b == 0 and len(c) > keep:
                r, query = np.nonzero(s >= np.partition(s, len(c) - keep, axis=0)[len(c) - keep])
            else:
                # Rows come in the order of their ids, so one that only equals the floor has enough before it.
                r, query = np.nonzero(s > floor[None, :])
            fresh.append((query, r + b, s[r, query]))
            if sum(len(x[0]) for x in fresh) > 4 * keep * t.shape[2] or b == 0:
                held = _best(*(np.concatenate(x) for x in zip(held, *fresh, strict=True)), keep)
                fresh = []
                last = np.searchsorted(held[0], np.arange(t.shape[2]), "right") - 1
                n = np.bincount(held[0], minlength=t.shape[2])
                floor = np.where(n >= keep, held[2][np.maximum(last, 0)] if len(held[0]) else -np.inf, -np.inf).astype(np.float32)
        held = _best(*(np.concatenate(x) for x in zip(held, *fresh, strict=True)), keep)
        out_q.append(held[0] + a)
        out_r.append(held[1])
    return np.concatenate(out_q), np.concatenate(out_r)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1)
    dim = lengths.first()
    return rows.filter(F.size("v") == (dim["dim"] if dim else 0))


def fit(rows: DataFrame, sample: int = SAMPLE, n_cells: int = 1) -> tuple[Codebook, np.ndarray] | None:
    """A codebook, and centroids of at most n_cells cells, from at most `sample` of the usable rows, drawn by the hash of the id; None if there are none."""
    got = drawn(rows, F.col("id"), sample).select("v").toPandas()["v"]
    if not len(got):
        return None
    x = np.unique(np.stack([np.asarray(x, np.float64) for x in got]), axis=0)
    return train(x), cells(x, max(1, min(n_cells, len(x) // SAMPLE_ROWS)))


def cells(x: np.ndarray, n: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """Centroids of n cells by k-means; one that loses all its rows stays where it is."""
    out = x[np.random.default_rng(seed).choice(len(x), n, replace=False)].copy()
    for _ in range(rounds if n > 1 else 0):
        near = nearest(x, out)
        sums = np.zeros_like(out)
        np.add.at(sums, near, x)
        size = np.bincount(near, minlength=n)
        out[size > 0] = sums[size > 0] / size[size > 0, None]
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row."""
    half = (centroids**2).sum(axis=1) / 2
    return np.concatenate([np.zeros(0, np.int64), *((x[i : i + _ROWS] @ centroids.T - half).argmax(axis=1) for i in range(0, len(x), _ROWS))])


def probed(q: np.ndarray, need: np.ndarray, centroids: np.ndarray, size: np.ndarray, probes: int) -> list[np.ndarray]:
    """For each query its cells, best first: `probes` of those that have rows, and further ones until they hold `need` rows."""
    full = np.flatnonzero(size)
    order = full[np.argsort(-(q @ centroids[full].T), axis=1, kind="stable")]
    enough = (np.cumsum(size[order], axis=1) < need[:, None]).sum(axis=1) + 1
    return [o[: max(probes, n)] for o, n in zip(order, enough.tolist(), strict=True)]


def classes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal rows: the first of each class in order of appearance, and the rows by class with each class's start and size."""
    _, first, of = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    rank = np.argsort(np.argsort(first))
    members, size = np.argsort(rank[of], kind="stable"), np.bincount(rank[of], minlength=len(first))
    return np.sort(first), members, np.cumsum(size) - size, size


def search(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    rerank: int = RERANK,
    sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
    probes: int | None = None,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows found for each row that is_query (a condition on `id`) holds for."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    n = rows.count()
    fitted = fit(rows, sample, -(-n // cell_rows) if probes else 1)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    book, centroids = fitted
    dim = book.dim

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim)
            codes = packed(assign(x, book)) if b.num_rows else np.zeros((0, 1), np.uint8)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(nearest(x, centroids).astype(np.int32))], names=["id", "v", "codes", "cell"])

    kind = rows.schema["v"].dataType.simpleString()
    index = stored(rows.mapInArrow(encode, f"id long, v {kind}, codes binary, cell int"), "ann-index")
    size = np.zeros(len(centroids), np.int64)
    for r in index.groupBy("cell").agg(F.count("*").alias("n")).collect():  # a row for each cell
        size[r["cell"]] = r["n"]
    blocks = -(-size // min(row_block, max(1_024, n // 16)))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                part = b.slice(i, _ROWS)
                at = probed(_matrix(part.column(1), dim), part.column(2).to_numpy() + k, centroids, size, probes or 1)
                which = np.repeat(np.arange(len(at)), [len(x) for x in at])
                cell = np.concatenate(at)
                again = np.repeat(np.arange(len(cell)), blocks[cell])
                block = np.concatenate([np.arange(x) for x in blocks[cell]])
                found = part.select(["id", "v"]).take(pa.array(which[again]))
                yield pa.RecordBatch.from_arrays([*found.columns, pa.nulls(len(again), pa.binary()), pa.array(cell[again].astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(np.ones(len(again), np.int32))], names=_UNIT)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, block = None, [], None
        for b in batches:
            for part in _runs(b):
                now = part.column(3)[0].as_py(), part.column(4)[0].as_py()
                if now != unit:
                    unit, held, block = now, [], None
                if not part.column(5)[0].as_py():
                    held.append(part)
                    continue
                if block is None:
                    block = _Block(held, dim)
                    held = []
                for i in range(0, part.num_rows, _QUERIES if block.rows else part.num_rows):
                    if block.rows:
                        yield block.answers(part.slice(i, _QUERIES), book, dim, k, rerank)

    dealt = F.broadcast(spark.createDataFrame([(i, int(x)) for i, x in enumerate(blocks)], "cell int, blocks int"))  # a row for each cell
    in_block = F.pmod(F.xxhash64("id", "v"), "blocks").cast("int")
    stored_rows = index.join(dealt, "cell").select("id", "v", "codes", "cell", in_block.alias("block"), F.lit(0).alias("kind"))
    queries = index.filter(is_query).groupBy("id").agg(F.min("v").alias("v"), F.count("*").alias("own"))
    asked = queries.mapInArrow(probe, f"id long, v {kind}, codes binary, cell int, block int, kind int")
    both = stored_rows.unionByName(asked).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind", "id")
    found = both.mapInArrow(meet, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_CHUNK = 1 << 16
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_UNIT = ["id", "v", "codes", "cell", "block", "kind"]


def _runs(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of one cell, block and kind."""
    if b.num_rows:
        change = np.zeros(b.num_rows - 1, bool)
        for c in (3, 4, 5):
            change |= np.diff(b.column(c).to_numpy()) != 0
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for a, e in zip(cuts, cuts[1:], strict=False):
            yield b.slice(a, e - a)


class _Block:
    """A block of the index: ids in order, vectors, and the distinct codes with the rows that have them."""

    def __init__(self, parts: list[pa.RecordBatch], dim: int):
        self.rows = sum(p.num_rows for p in parts)
        if self.rows:
            self.ids = np.concatenate([p.column(0).to_numpy() for p in parts])
            self.x = np.concatenate([_matrix(p.column(1), dim) for p in parts])
            codes = np.frombuffer(b"".join(c for p in parts for c in p.column(2).to_pylist()), np.uint8).reshape(self.rows, -1)
            first, self.members, self.start, self.size = classes(codes)
            self.codes = codes[first]

    def answers(self, queries: pa.RecordBatch, book: Codebook, dim: int, k: int, rerank: int) -> pa.RecordBatch:
        """The k best rows of the block for each query."""
        own, q = queries.column(0).to_numpy(), _matrix(queries.column(1), dim)
        query, found = scan(q, self.codes, book, rerank)
        n = self.size[found]
        row = self.members[np.repeat(self.start[found] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        query = np.repeat(query, n)
        other = self.ids[row] != own[query]
        query, row = query[other], row[other]
        exact = np.concatenate([np.zeros(0), *((q[query[i : i + _CHUNK]] * self.x[row[i : i + _CHUNK]]).sum(axis=1) for i in range(0, len(query), _CHUNK))])
        query, row, exact = _best(query, row, exact, k)
        return pa.RecordBatch.from_arrays([pa.array(own[query]), pa.array(self.ids[row]), pa.array(exact)], schema=_FOUND)
