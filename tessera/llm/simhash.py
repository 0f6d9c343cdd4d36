"""SimHash near-duplicates: a pivot table of Hamming distances finds the links, star contraction the groups.

Fingerprint: 64 bits by majority over the XXH64 (seed 42) of word shingles. Two fingerprints link when
they differ in at most 3 bits.

Candidates. Three differing bits leave at least n - 3 of n bit blocks alike, so each distinct fingerprint enters a group for
each choice of n - 3 blocks. More blocks make more groups that agree in more bits: 10 groups of some 26 bits for n = 5, 20 of 32
for n = 6, 35 of 37 for n = 7. n follows from the number of fingerprints, so that groups don't grow with the table; the
links are the same. (Blocks are pivot coordinates too: the distances to a zero
reference and to one reference per bit give the block's bits.) In a group every fingerprint has a row of a
pivot table: its distances to PIVOTS random reference fingerprints. By the triangle inequality a pair
whose rows differ by more than 3 in any coordinate can't link; such pairs are discarded, the rest are
verified. In small groups every surviving pair is a link; a large group gives a spanning forest, which
joins the same fingerprints without naming all pairs. A group over HOT_GROUP is split once more by three
of six blocks of its free bits, at most 38; what remains has at most 2**20 members by construction.

Copies never meet: they share one distinct fingerprint. Nothing but counts reaches the driver.

Edge cases. Null or empty text, or white space only: fingerprint zero, linked like any other. A null
doc_id keeps its row and links; component_id is the smallest doc_id that isn't null, or null if there is
none. Repeated rows stay, with equal values. An empty table gives no rows. Other columns are ignored by
components(); deduplicate() states its own cases in overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import overlap
from tessera.llm.common import small, stored
from tessera.llm.components import star_components

SHINGLE = 3
MAX_BITS = 3
PIVOTS = 32
#: Groups up to this size are compared pairwise, vectorised over all groups at once.
SMALL_GROUP = 48
#: Groups above this size are split by further bits before they are gathered.
HOT_GROUP = 20_000
#: Fingerprints up to which five, and six, blocks leave few in a group by chance.
FIVE, SIX = 1 << 27, 1 << 34
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned; A-Z count as lower case, words end at ASCII white space."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[width - 1 :] or ends[-1:]
    digest, n = xxhash.xxh64_intdigest, len(last)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[i : i + _CHUNK], last[i : i + _CHUNK], strict=False)], np.uint64)
        counts += _bit_counts(h)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist()))


_LANES = np.uint64(0x0101010101010101)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How often each bit is set: eight byte-wide counters in a word, emptied every 255 values."""
    h = np.concatenate([h, np.zeros(-len(h) % 255, np.uint64)]).reshape(-1, 255)
    lanes = np.stack([((h >> np.uint64(k)) & _LANES).sum(axis=1, dtype=np.uint64) for k in range(8)])
    return lanes.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64).T.reshape(64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, further columns to keep, and `fingerprint` (long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_py()) for x in b.column(b.num_columns - 1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], schema=pa.schema([*list(b.schema)[:-1], pa.field("fingerprint", pa.int64())]))

    rows = docs.select(id_col, *keep, F.col(text_col).cast("binary").alias("__text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("fingerprint", T.LongType())]))


def blocks_for(n: int) -> int:
    """How many blocks n distinct fingerprints are cut into."""
    return 5 if n <= FIVE else 6 if n <= SIX else 7


def _blocks(n_blocks: int) -> list[tuple[int, int]]:
    """Bit blocks as (shift, width)."""
    cuts = [64 * b // n_blocks for b in range(n_blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def block_keys(n_blocks: int, fp: str = "fingerprint") -> list:
    """A long for each choice of all but MAX_BITS of a fingerprint's blocks: their bits, after the choice's number."""
    part = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in _blocks(n_blocks)]
    out = []
    for k, kept in enumerate(combinations(range(n_blocks), n_blocks - MAX_BITS)):
        key = F.lit(k).cast("long")
        for b in kept:
            key = F.shiftleft(key, _blocks(n_blocks)[b][1]) + part[b]
        out.append(F.lit(k << _NUMBER) + key.bitwiseAND(F.lit((1 << _NUMBER) - 1)))
    return out


#: Bits of a key below the number of its choice of blocks.
_NUMBER = 48


def _fine_keys(key: np.ndarray, fp: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For members of hot groups: (key, fine key, fingerprint), 20 rows each: three of six blocks of the free bits."""
    keys, fine, fps = [], [], []
    kept = list(combinations(range(n_blocks), n_blocks - MAX_BITS))
    number = key >> _NUMBER
    for k in np.unique(number):
        at = number == k
        free, width = np.zeros(at.sum(), np.uint64), 0
        for s, w in (_blocks(n_blocks)[b] for b in range(n_blocks) if b not in kept[k]):
            free |= ((fp[at] >> np.uint64(s)) & np.uint64((1 << w) - 1)) << np.uint64(width)
            width += w
        cuts = [width * c // 6 for c in range(7)]
        parts = [(free >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
        for c, (x, y, z) in enumerate(combinations(parts, 3)):
            keys.append(key[at])
            fine.append((np.uint64(c << 24) | x << np.uint64(16) | y << np.uint64(8) | z).astype(np.int64))
            fps.append(fp[at])
    return np.concatenate(keys), np.concatenate(fine), np.concatenate(fps)


def pivot_table(fps: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of the fingerprints (uint64) to the reference fingerprints: one row for each."""
    refs = np.random.default_rng(20_240_229).integers(0, 1 << 64, pivots, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def pair_counts(fps: np.ndarray, n_blocks: int = 5) -> tuple[int, int, int]:
    """For distinct fingerprints (uint64): pairs that groups make, that no pivot discards, and that verify; a pair counts in each of its groups."""
    made = left = near = 0
    for kept in combinations(_blocks(n_blocks), n_blocks - MAX_BITS):
        mask = np.uint64(sum(((1 << w) - 1) << s for s, w in kept))
        order = np.argsort(fps & mask, kind="stable")
        f = fps[order]
        same = np.flatnonzero(np.concatenate([[True], (f[1:] ^ f[:-1]) & mask != 0]))
        for a, n in zip(same, np.diff(np.append(same, len(f))), strict=True):
            if n > 1:
                i, j = np.triu_indices(n, 1)
                table = pivot_table(f[a : a + n])
                ok = np.abs(table[i] - table[j]).max(axis=1) <= MAX_BITS
                made, left = made + len(i), left + int(ok.sum())
                near += int((np.bitwise_count(f[a + i[ok]] ^ f[a + j[ok]]) <= MAX_BITS).sum())
    return made, left, near


def _survivors(table: np.ndarray, fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that no pivot discards and that verify."""
    for k in range(table.shape[1]):
        near = np.abs(table[a, k] - table[b, k]) <= MAX_BITS
        a, b = a[near], b[near]
        if not len(a):
            return a, b
    near = np.bitwise_count(fps[a] ^ fps[b]) <= MAX_BITS
    return a[near], b[near]


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one group: each member is expanded once against those not yet reached."""
    table = pivot_table(fps)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    left, starts = np.ones(len(fps), bool), np.searchsorted(table[:, 0], np.arange(-3, 70))
    out_a, out_b = [], []
    for seed in range(len(fps)):
        if not left[seed]:
            continue
        left[seed] = False
        todo = [seed]
        while todo:
            i = todo.pop()
            c = int(table[i, 0])
            lo, hi = starts[max(0, c - MAX_BITS + 3)], starts[c + MAX_BITS + 1 + 3]
            b = lo + np.flatnonzero(left[lo:hi])
            _, b = _survivors(table, fps, np.full(len(b), i), b)
            if len(b):
                left[b] = False
                todo.extend(b.tolist())
                out_a.append(np.full(len(b), fps[i]))
                out_b.append(fps[b])
    if not out_a:
        return fps[:0], fps[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def group_links(keys: list[np.ndarray], fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys; the rows are sorted by key and distinct."""
    change = np.zeros(len(fps), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(change)
    sizes = np.diff(np.append(first, len(fps)))
    out = []
    run = np.repeat(np.arange(len(first)), sizes)
    member = np.flatnonzero((sizes > 1)[run] & (sizes <= SMALL_GROUP)[run])
    if len(member):
        table, f, r = pivot_table(fps[member]), fps[member], run[member]
        for d in range(1, min(SMALL_GROUP, len(member))):
            a = np.flatnonzero(r[:-d] == r[d:])
            if not len(a):
                break
            a, b = _survivors(table, f, a, a + d)
            out.append((f[a], f[b]))
    out += [_forest(fps[first[g] : first[g] + sizes[g]]) for g in np.flatnonzero(sizes > SMALL_GROUP)]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *(a for a, _ in out)]), np.concatenate([none, *(b for _, b in out)])


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links_of(n_keys: int):
    """For mapInArrow over rows sorted by their keys: links, with the run that a batch ends in carried over."""

    def emit(cols: list[np.ndarray]) -> pa.RecordBatch:
        a, b = group_links(cols[:-1], cols[-1].view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a.view(np.int64), b.view(np.int64))), pa.array(np.minimum(a.view(np.int64), b.view(np.int64)))], schema=_LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            same = np.logical_and.reduce([c == c[-1] for c in cols[:n_keys]])
            cut = 0 if same.all() else len(same) - int(np.argmin(same[::-1]))
            if cut:
                kept.append([c[:cut] for c in cols])
                yield emit([np.concatenate(x) for x in zip(*kept, strict=True)])
                kept = []
            kept.append([c[cut:].copy() for c in cols])
        if kept:
            yield emit([np.concatenate(x) for x in zip(*kept, strict=True)])

    return run


def links(distinct: DataFrame, hot: int = HOT_GROUP, n_blocks: int | None = None) -> DataFrame:
    """Links (a, b), a > b, among the distinct fingerprints of column `fingerprint`; enough of them to join all that link."""
    n_blocks = n_blocks or blocks_for(distinct.count())
    keyed = distinct.select(F.explode(F.array(*block_keys(n_blocks))).alias("key"), "fingerprint")
    hot_keys = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("key"), "simhash-hot-keys")
    hot_keys = F.broadcast(hot_keys) if small(hot_keys) else hot_keys

    def fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                k, f, fp = _fine_keys(b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), n_blocks)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f), pa.array(fp.view(np.int64))], names=["key", "fine", "fingerprint"])

    cold = keyed.join(hot_keys, "key", "left_anti").repartition("key").sortWithinPartitions("key", "fingerprint")
    split = keyed.join(hot_keys, "key", "left_semi").mapInArrow(fine, "key long, fine long, fingerprint long")
    split = split.repartition("key", "fine").sortWithinPartitions("key", "fine", "fingerprint")
    return cold.mapInArrow(_links_of(1), "a long, b long").unionByName(split.mapInArrow(_links_of(2), "a long, b long")).distinct()


def _grouped(fps: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(distinct fingerprints with their smallest id, linked fingerprints with their root), both stored."""
    distinct = stored(fps.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "fingerprints")
    return distinct, stored(star_components(links(distinct)).withColumnRenamed("node", "fingerprint"), "roots")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: its id, `fingerprint` (16 hex digits) and `component_id`."""
    fps = stored(fingerprints(docs, id_col, text_col), "doc-fingerprints")
    distinct, roots = _grouped(fps, id_col)
    linked = distinct.join(roots, "fingerprint")
    linked = linked.join(linked.groupBy("root").agg(F.min("least").alias("component")), "root").select("fingerprint", "component")
    # Stored, so that the last join is one of two plain shuffles, and Spark can split the fingerprint of a hot text.
    least = stored(distinct.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("component", "least").alias("component_id")), "fingerprint-components")
    return fps.join(least, "fingerprint").select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near-duplicates, texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

    No Hamming bound on 64 bits is lossless for a similarity, so the pivot table here is over the shingles' own bits: see overlap.
    """
    return overlap.deduplicate(docs, id_col, text_col)
