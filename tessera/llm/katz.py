"""Katz backoff language model of words: Good-Turing discounts, exactly normalised backoff weights, of any order from two.

    p(w | h) = d(c(h, w)) c(h, w) / c(h)   if the gram was seen in training,
             = alpha(h) p(w | h')          if not, h' being h without its first word,
             = p(w | h')                   for a context that wasn't seen,
    p(w)     = d(c(w)) c(w) / N, and what the discounts leave for the one unknown word.

alpha(h) is what the discounts at h leave, over the probability below of all words not seen after h, so p(. | h) sums to
one over the V known words (the end included) and the unknown one. A context at which nothing is discounted counts one
more than it was seen. Words before the start of a text are ends.

How it runs. Texts are cut to tokens once, in batches of up to BATCH_TOKENS, and kept as a stored table. A batch
sends each word it holds, once, to that word's bucket; the bucket sums the counts of all batches and answers each
with the words' numbers and counts. Then, level by level, a batch sends its distinct grams to the buckets of their
contexts with the counts that give their probabilities below; there counts are summed and answered with the grams'
counts, the contexts' sizes, and, where a batch has to back off, with what alpha needs: the numbers of followers seen
once, twice, ..., and their mass below. Answers are stored tables, partitioned by bucket; scoring a batch is a lookup in
its answers, level by level from the words up.

What moves are packed arrays of distinct words and grams, summed within their batch, not a row for each token. Batches
are stored in buckets by batch and never shuffled; the answers come to them. The number of buckets of words and grams
grows with the tokens, so that each fits a worker. The grams of a hot context (over 1/4 of a bucket's tokens) are spread
over all buckets by their last word, and only its few sums meet on the driver: there are at most four of them for each bucket.

Words are told apart by the XXH64 of their bytes, grams in a bucket by 64 bits mixed from their words' numbers.

Edge cases. Null or empty text, or only white space: the end alone. A null id counts as training. Without
training rows every token is the unknown word with probability one. Repeated rows count and score each time.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import released, stored, stored_by

BATCH_TOKENS = 1_000_000
#: Bytes of text that are cut to tokens at once.
SLICE_BYTES = 5 << 20
#: Counts up to this are discounted.
CUTOFF = 5
#: Tokens of all batches for each bucket: buckets = tokens / BUCKET_TOKENS.
BUCKET_TOKENS = 1_500_000
#: Words in a gram.
ORDER = 2
#: The end of a text; no word holds white space.
END = xxhash.xxh64_intdigest(b"\n")


class Unigrams(NamedTuple):
    """Sums over all training tokens: N, V, and how many words were seen once, twice, ... CUTOFF + 1 times."""

    tokens: int
    words: int
    seen: tuple[int, ...]


# --- packed arrays -----------------------------------------------------------------------------------------------


def pack(a: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed byte planes."""
    a = np.ascontiguousarray(a, "<u8")
    width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    return struct.pack("<QB", len(a), width) + zstandard.compress(a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 3)


def unpack(b: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", b)
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(zstandard.decompress(b[9:], max_output_size=n * width), np.uint8).reshape(width, n).T
    return out.view("<i8").reshape(n)


def _raw(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 3)


def _unraw(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), dtype)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


# --- texts to batches --------------------------------------------------------------------------------------------


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z in lower case, and the number of words in each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, parent = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")
    return words.filter(real), np.bincount(parent.filter(real).to_numpy(), minlength=len(texts))


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about SLICE_BYTES of text."""
    upto = np.cumsum(pc.binary_length(b.column(b.num_columns - 1)).fill_null(0).to_numpy().astype(np.int64))
    cuts = np.flatnonzero(np.diff(upto // SLICE_BYTES)) + 1
    for a, e in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
        if e > a:
            yield b.slice(a, e - a)


def _streams(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts with up to `limit` tokens: first, end, local word of each token, hashes of the local words, tokens of each text."""
    words, n = words_of(texts)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()] + [END], np.uint64)
    codes, end = coded.indices.to_numpy(), len(hashes) - 1
    upto = np.concatenate([[0], np.cumsum(n + 1)])
    stream = np.full(upto[-1], end, np.int64)
    inside = np.ones(len(stream), bool)
    inside[upto[1:] - 1] = False
    stream[inside] = codes
    a = 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + limit, "right")) - 1)
        part = stream[upto[a] : upto[b]]
        freq = np.bincount(part, minlength=len(hashes))
        freq[end] = max(freq[end], 1)
        used = np.flatnonzero(freq)
        used = used[np.argsort(-freq[used], kind="stable")]
        local = np.zeros(len(hashes), np.int64)
        local[used] = np.arange(len(used))
        yield a, b, local[part], hashes[used], (n + 1)[a:b]
        a = b


def batches_of(docs: DataFrame, held_out: Column, id_col: str, text_col: str, limit: int = BATCH_TOKENS) -> DataFrame:
    """The stored table of batches: ids, and packed lengths, held-out marks, tokens, word hashes and training counts."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                for first, end, stream, hashes, n in _streams(part.column(2), limit):
                    marks = held[first:end]
                    counts = np.bincount(stream[~np.repeat(marks, n)], minlength=len(hashes))
                    ids = pa.ListArray.from_arrays(pa.array([0, end - first], pa.int32()), part.column(0).slice(first, end - first))
                    packed = [pa.array([x]) for x in (uuid.uuid4().hex, len(stream), len(hashes))] + [pa.array([x], pa.binary()) for x in (pack(n), pack(marks), pack(stream), _raw(hashes), pack(counts))]
                    names = ["batch", "n_tokens", "n_words", "lengths", "held", "tokens", "words", "counts"]
                    yield pa.RecordBatch.from_arrays([ids, *packed], names=["ids", *names])

    schema = T.StructType().add("ids", T.ArrayType(rows.schema["id"].dataType)).add("batch", "string").add("n_tokens", "long").add("n_words", "long")
    for name in ("lengths", "held", "tokens", "words", "counts"):
        schema = schema.add(name, "binary")
    return stored_by(rows.mapInArrow(run, schema), "katz-batches", "batch")


# --- words -------------------------------------------------------------------------------------------------------

_WORDS = pa.schema([("bucket", pa.int64()), ("batch", pa.string()), ("hashes", pa.binary()), ("counts", pa.binary())])
_WORD_ANSWERS = pa.schema([("bucket", pa.int64()), ("batch", pa.string()), ("ids", pa.binary()), ("counts", pa.binary()), ("sums", pa.list_(pa.int64())), ("top", pa.list_(pa.int64()))])
_WORD_DDL = "bucket long, batch string, ids binary, counts binary, sums array<long>, top array<long>"


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with its positions in order."""
    if len(bucket) and int(bucket.max()) < 1 << 16:
        bucket = bucket.astype(np.uint16)  # sorted by digits
    order = np.argsort(bucket, kind="stable")
    of = bucket[order]
    cuts = np.flatnonzero(np.diff(of)) + 1
    for at in np.split(order, cuts) if len(order) else []:
        yield int(bucket[at[0]]), at


def word_answers(batches: DataFrame, n_buckets: int, least: int) -> DataFrame:
    """For each batch and bucket, the numbers and training counts of its words; for each bucket its sums, and the words seen over `least` times, as contexts."""

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for row in range(b.num_rows):
                batch, words, counts = (c[row].as_py() for c in b.columns)
                h, c = _unraw(words, np.uint64), unpack(counts)
                yield _rows([(k, batch, _raw(h[at]), pack(c[at])) for k, at in _by_bucket((h % np.uint64(n_buckets)).astype(np.int64))], _WORDS)

    def answer(t: pa.Table) -> pa.Table:
        bucket, hashes = t["bucket"][0].as_py(), [_unraw(x, np.uint64) for x in t["hashes"].to_pylist()]
        known, which = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(which, np.concatenate([unpack(x) for x in t["counts"].to_pylist()])).astype(np.int64)
        # Numbers by falling count, so that frequent words have short ones.
        order = np.argsort(-total, kind="stable")
        number = np.empty(len(total), np.int64)
        number[order] = np.arange(len(total)) * n_buckets + bucket
        ends = np.cumsum([len(h) for h in hashes])
        rows = [(bucket, batch, pack(number[w]), pack(total[w]), None, None) for batch, w in zip(t["batch"].to_pylist(), np.split(which, ends[:-1]), strict=True)]
        seen = np.bincount(total[(total > 0) & (total <= CUTOFF + 1)], minlength=CUTOFF + 2)[1:]
        often = np.flatnonzero(total > least)
        context = np.where(known[often] == np.uint64(END), 0, number[often] + 1)
        rows.append((bucket, None, None, None, [int(total.sum()), int((total > 0).sum()), *seen.tolist()], context_hash(context[:, None]).tolist()))
        return pa.Table.from_batches([_rows(rows, _WORD_ANSWERS)])

    asked = batches.select("batch", "words", "counts").mapInArrow(ask, "bucket long, batch string, hashes binary, counts binary")
    return stored(asked.groupBy("bucket").applyInArrow(answer, _WORD_DDL), "katz-words")


def _sums(answers: DataFrame, n: int) -> list[int]:
    got = answers.filter("sums is not null").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(n)]).first()
    return [int(x or 0) for x in got]


# --- discounts ---------------------------------------------------------------------------------------------------


def discounts(seen: tuple[int, ...], cutoff: int = CUTOFF) -> np.ndarray:
    """d(0), d(1), ..., d(cutoff), 1: Katz's discount factors by how many events were seen once, twice, ....

    Where Good-Turing gives none within (0, 1), as on small data, the absolute discount n1 / (n1 + 2 n2) stands in.
    """
    n = np.array([0, *seen], float)
    fall = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    out = np.ones(cutoff + 2)
    out[0] = 0
    last = (cutoff + 1) * n[cutoff + 1] / n[1] if n[1] else 1.0
    for r in range(1, cutoff + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last) if n[r] and n[r + 1] and last < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - fall) / r
    return out


def unigram_p(counts: np.ndarray, u: Unigrams) -> np.ndarray:
    """p(w) of words with these training counts; count 0 is the one unknown word."""
    if not u.tokens:
        return np.ones(len(counts))
    d, total, left = _unigram_mass(u)
    return np.where(counts > 0, d[np.minimum(counts, CUTOFF + 1)] * counts / total, left)


def _unigram_mass(u: Unigrams) -> tuple[np.ndarray, float, float]:
    d = discounts(u.seen)
    r = np.arange(1, CUTOFF + 1)
    freed = float(((1 - d[1:-1]) * r * np.array(u.seen[:CUTOFF])).sum())
    total = u.tokens + (0 if freed > 0 else 1)
    return d, total, (freed if freed > 0 else 1.0) / total


# --- grams -------------------------------------------------------------------------------------------------------

_ASKED = pa.schema([("bucket", pa.int64()), ("batch", pa.string()), ("contexts", pa.list_(pa.binary())), ("runs", pa.binary()), ("w", pa.binary()), ("n", pa.binary()), ("low", pa.list_(pa.binary()))])
_ASKED_DDL = "bucket long, batch string, contexts array<binary>, runs binary, w binary, n binary, low array<binary>"
_GRAM_ANSWERS = pa.schema([("bucket", pa.int64()), ("batch", pa.string()), ("counts", pa.binary()), ("sizes", pa.binary()), ("followers", pa.binary()), ("mass", pa.binary()), ("sums", pa.list_(pa.int64())), ("top", pa.list_(pa.int64())), ("hot", pa.list_(pa.int64())), ("hot_mass", pa.list_(pa.float64()))])
_GRAM_DDL = "bucket long, batch string, counts binary, sizes binary, followers binary, mass binary, sums array<long>, top array<long>, hot array<long>, hot_mass array<double>"


def _mix(a: np.ndarray) -> np.ndarray:
    """Well mixed bits of whole numbers: the finisher of SplitMix64, which tells all numbers apart (its public constants)."""
    a = a.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def context_hash(contexts: np.ndarray) -> np.ndarray:
    """64 bits for each row of word numbers."""
    out = np.zeros(len(contexts), np.uint64)
    for c in contexts.T:
        out = _mix(out + c.astype(np.uint64) + np.uint64(1))
    return out.view(np.int64)


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, keys in rising order, and which each one is."""
    order = np.argsort(key)
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _among(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which hashes are among the hot ones (sorted)."""
    return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h if len(hot) else np.zeros(len(h), bool)


def _with_word(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64 bits for contexts, by their hashes, with a word's number each."""
    return _mix(h.view(np.uint64) + w.astype(np.uint64) + np.uint64(1)).view(np.int64)


class Grams(NamedTuple):
    """The distinct grams of one length in a batch."""

    contexts: np.ndarray  # contexts, of which some have no gram, x words before the last, local words
    of: np.ndarray  # context of each gram
    w: np.ndarray  # its last word
    lower: np.ndarray  # the gram without its first word, in the level below; the word itself for pairs
    n: np.ndarray  # how often in training
    at: np.ndarray  # which gram each token ends


class Batch(NamedTuple):
    """One batch with the answers on its words."""

    lengths: np.ndarray
    held: np.ndarray
    tokens: np.ndarray
    numbers: np.ndarray  # of local words; 0 is the end
    counts: np.ndarray
    end: int

    def levels(self, order: int) -> list[Grams]:
        """Grams of 2 to `order` words. Words before the start of a text are ends."""
        place = np.arange(len(self.tokens)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        train = ~np.repeat(self.held, self.lengths)
        out, lower, columns, start = [], self.tokens, np.arange(len(self.numbers))[:, None], self.end
        for k in range(2, order + 1):
            # The context of a token is the gram below that the token before it ends; at a text's start, ends alone.
            context = np.concatenate([[start], lower[:-1]])
            context[place == 0] = start
            first, at = _distinct(context << 32 | self.tokens)
            out.append(Grams(columns, context[first], self.tokens[first], lower[first], np.bincount(at[train], minlength=len(first)), at))
            columns = np.vstack([np.column_stack([columns[context[first]], self.tokens[first]]), np.full((1, k), self.end)])
            start, lower = len(first), at
        return out


def _assembled(row: dict, answers: list[dict], n_buckets: int) -> Batch:
    hashes, tokens = _unraw(row["words"], np.uint64), unpack(row["tokens"])
    numbers, counts = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
    got = {a["bucket"]: a for a in answers if a["level"] == 1}
    for k, at in _by_bucket((hashes % np.uint64(n_buckets)).astype(np.int64)):
        numbers[at], counts[at] = unpack(got[k]["ids"]), unpack(got[k]["counts"])
    end = int(np.flatnonzero(hashes == np.uint64(END))[0])
    numbers += 1
    numbers[end] = 0
    return Batch(unpack(row["lengths"]), unpack(row["held"]).astype(bool), tokens, numbers, counts, end)


def _dealt(b: Batch, g: Grams, n_buckets: int, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket its contexts, how many grams each has there, and these grams, by context.

    The grams of a hot context are spread over all buckets.
    """
    h = context_hash(b.numbers[g.contexts])
    spread, own = h[g.of], _among(h, hot)[g.of]
    spread[own] = _with_word(spread[own], b.numbers[g.w[own]])
    for k, grams in _by_bucket((spread.view(np.uint64) % np.uint64(n_buckets)).astype(np.int64)):
        of = g.of[grams]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        yield k, of[first], np.diff(np.append(first, len(of))), grams


class Level(NamedTuple):
    """What all of training says of grams of one length: discounts, and the sums of the hot contexts (CUTOFF followers, size, mass)."""

    d: np.ndarray
    hot: np.ndarray
    hot_sums: np.ndarray
    hot_mass: np.ndarray


class Known(NamedTuple):
    """What a batch knows of its grams of one length: p of the last word after its context, the training count, and what the context's counts are divided by."""

    p: np.ndarray
    total: np.ndarray
    whole: np.ndarray


def _known(b: Batch, g: Grams, level: Level, answers: dict[int, dict], n_buckets: int, low: np.ndarray) -> Known:
    """low: p of the grams of the level below."""
    n = len(g.contexts)
    total, size, flag = np.zeros(len(g.w), np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    followers, mass = np.zeros((CUTOFF, n), np.int64), np.zeros(n)
    for k, contexts, runs, grams in _dealt(b, g, n_buckets, level.hot):
        a = answers[k]
        total[grams] = unpack(a["counts"])
        sizes = unpack(a["sizes"])
        size[contexts], flag[contexts] = sizes >> 1, sizes & 1
        told = contexts[_wanted(total[grams], runs, sizes >> 1)]
        followers[:, told], mass[told] = unpack(a["followers"]).reshape(CUTOFF, -1), _unraw(a["mass"], np.float64)
    if len(level.hot):
        h = context_hash(b.numbers[g.contexts])
        own = np.flatnonzero(_among(h, level.hot))
        at = np.searchsorted(level.hot, h[own])
        sums = level.hot_sums[at]
        followers[:, own], size[own], mass[own] = sums[:, :CUTOFF].T, sums[:, CUTOFF], level.hot_mass[at]
        flag[own] = sums[:, :CUTOFF].any(axis=1)
    freed = ((1 - level.d[1:-1])[:, None] * np.arange(1, CUTOFF + 1)[:, None] * followers).sum(axis=0)
    # A context at which nothing is discounted counts one more than it was seen.
    whole = np.maximum(size + ~flag, 1)
    # No probability is left for others where a context's followers are all there is but the unknown word; that one then has it all.
    alpha = np.where(flag, freed, 1.0) / whole / np.maximum(1 - mass, 1e-300)
    below = low[g.lower]
    p = np.where(total > 0, level.d[np.minimum(total, CUTOFF + 1)] * total / whole[g.of], np.where(size[g.of] > 0, alpha[g.of] * below, below))
    return Known(p, total, whole)


def _wanted(total: np.ndarray, runs: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Contexts, of those of a bucket, whose backoff weight is asked for: seen in training, with a gram that wasn't."""
    first = np.cumsum(runs) - runs
    return (np.minimum.reduceat(total, first) == 0) & (size > 0) if len(runs) else np.zeros(0, bool)


def _ask(batches: DataFrame, answers: DataFrame, u: Unigrams, levels: list[Level], n_words: int, n_buckets: int, hot: np.ndarray) -> DataFrame:
    """For each batch and bucket the grams of the next level: their contexts, last words, training counts and what gives the probabilities below of those in training.

    That are the counts of the last words for pairs; for longer grams the counts of the grams below, and once for each of
    their contexts what they are divided by.
    """
    order = len(levels) + 2

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, found = [], right.to_pylist()
        for row in left.to_pylist():
            b = _assembled(row, found, n_words)
            grams = b.levels(order)
            below, g = _below(b, grams[:-1], u, levels, found, n_buckets), grams[-1]
            for k, contexts, runs, at in _dealt(b, g, n_buckets, hot):
                numbers, w = b.numbers[g.contexts[contexts]], b.numbers[g.w[at]]
                if order == 2:
                    _, first = np.unique(w, return_index=True)
                    low = [pack(b.counts[g.w[at][first]])]
                else:
                    _, first = np.unique(context_hash(numbers[:, 1:]), return_index=True)
                    one = at[(np.cumsum(runs) - runs)[first]]  # a gram of each context below
                    low = [pack(below.total[g.lower[at[g.n[at] > 0]]]), pack(below.whole[grams[-2].of[g.lower[one]]])]
                rows.append((k, row["batch"], [pack(c) for c in numbers.T], pack(runs), pack(w), pack(g.n[at]), low))
        return pa.Table.from_batches([_rows(rows, _ASKED)])

    return _meet(batches, answers).applyInArrow(ask, _ASKED_DDL)


def _below(b: Batch, grams: list[Grams], u: Unigrams, levels: list[Level], answers: list[dict], n_buckets: int) -> Known:
    """What is known of the grams of the last level given, from the words up: each level backs off to the one below."""
    out = Known(unigram_p(b.counts, u), b.counts, np.zeros(0))
    for k, (g, level) in enumerate(zip(grams, levels, strict=True), 2):
        out = _known(b, g, level, {a["bucket"]: a for a in answers if a["level"] == k}, n_buckets, out.p)
    return out


def gram_answers(asked: DataFrame, u: Unigrams, levels: list[Level], hot: np.ndarray, least: int) -> DataFrame:
    """For each batch and bucket the training counts of its grams and the sizes of their contexts, and for contexts to back off from their followers seen once, twice, ... and the mass below of all that followed.

    For each bucket its counts of counts, its part of the hot contexts' sums, and the hashes of grams seen over `least`
    times, which are the hot contexts of the next level.
    """
    order, d = len(levels) + 2, levels[-1].d if levels else None

    def answer(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        parts = []
        for contexts, runs, w, n, low in zip(*(t[c].to_pylist() for c in ("contexts", "runs", "w", "n", "low")), strict=True):
            columns = np.column_stack([unpack(c) for c in contexts])
            runs, w, n = unpack(runs), unpack(w), unpack(n)
            p = np.full(len(w), np.nan)
            if order == 2:
                _, own = np.unique(w, return_inverse=True)
                p = unigram_p(unpack(low[0]), u)[own]
            else:
                c, (_, own) = unpack(low[0]), np.unique(context_hash(columns[:, 1:]), return_inverse=True)
                p[n > 0] = d[np.minimum(c, CUTOFF + 1)] * c / np.repeat(unpack(low[1])[own], runs)[n > 0]
            parts.append((columns, runs, w, n, p))
        columns, runs, w, n, p = (np.concatenate(x) for x in zip(*parts, strict=True))
        h = context_hash(columns)
        first, which = _distinct(h)
        one, gram = _distinct(_with_word(np.repeat(h, runs), w))
        columns, h, of = columns[first], h[first], np.repeat(which, runs)[one]
        total = np.bincount(gram, n, len(one)).astype(np.int64)
        below = np.zeros(len(one))
        below[gram[n > 0]] = p[n > 0]
        size = np.bincount(of, total, len(columns)).astype(np.int64)
        mass = np.bincount(of, np.where(total > 0, below, 0), len(columns))
        followers = np.stack([np.bincount(of[total == r], minlength=len(columns)) for r in range(1, CUTOFF + 1)])
        flag = followers.any(axis=0)
        rows, at_c, at_g = [], 0, 0
        for batch, (c, r, x, *_) in zip(t["batch"].to_pylist(), parts, strict=True):
            mine, counts = which[at_c : at_c + len(c)], total[gram[at_g : at_g + len(x)]]
            told = mine[_wanted(counts, r, size[mine])]
            rows.append((bucket, batch, pack(counts), pack(2 * size[mine] + flag[mine]), pack(followers[:, told].ravel()), _raw(mass[told]), None, None, None, None))
            at_c, at_g = at_c + len(c), at_g + len(x)
        seen = np.bincount(total[(total > 0) & (total <= CUTOFF + 1)], minlength=CUTOFF + 2)[1:]
        special = np.flatnonzero(_among(h, hot) & (size > 0))
        sums = np.column_stack([h[special], followers[:, special].T, size[special]]).ravel().tolist()
        often = np.flatnonzero(total > least)
        top = context_hash(np.column_stack([columns[of[often]], w[one[often]]])).tolist()
        rows.append((bucket, None, None, None, None, None, seen.tolist(), top, sums, mass[special].tolist()))
        return pa.Table.from_batches([_rows(rows, _GRAM_ANSWERS)])

    return stored(asked.groupBy("bucket").applyInArrow(answer, _GRAM_DDL), f"katz-grams-{order}")


def _meet(batches: DataFrame, answers: DataFrame):
    """Batches with the answers to them; each batch has a bounded number of tokens."""
    return batches.groupBy("batch").cogroup(answers.filter("batch is not null").groupBy("batch"))


def _top(answers: DataFrame) -> np.ndarray:
    """Hashes of the hot contexts of the next level: at most four for each bucket, as each has over a quarter of a bucket's tokens."""
    return np.array(sorted(r["h"] for r in answers.filter("top is not null").select(F.explode("top").alias("h")).distinct().collect()), np.int64)


def _level(answers: DataFrame, hot: np.ndarray) -> Level:
    sums, mass = np.zeros((len(hot), CUTOFF + 1), np.int64), np.zeros(len(hot))
    if len(hot):
        for r in answers.filter("size(hot) > 0").select("hot", "hot_mass").toLocalIterator():
            rows = np.array(r["hot"], np.int64).reshape(-1, CUTOFF + 2)
            at = np.searchsorted(hot, rows[:, 0])
            sums[at] += rows[:, 1:]
            mass[at] += r["hot_mass"]
    return Level(discounts(tuple(_sums(answers, CUTOFF + 1))), hot, sums, mass)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, order: int = ORDER, batch_tokens: int = BATCH_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """One row for each row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model is counted on the rows that aren't held out: by default those whose crc32 of the id as text isn't 1 modulo 5.
    """
    if order < 2:
        raise ValueError("backoff needs an order of two at least")
    if held_out is None:
        held_out = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 1
    batches = batches_of(docs, held_out, id_col, text_col, batch_tokens)
    sent = batches.agg(F.sum("n_tokens").alias("t"), F.sum("n_words").alias("w")).first()
    n_words, n_buckets = 1 + (sent["w"] or 0) // bucket_tokens, 1 + (sent["t"] or 0) // bucket_tokens
    least = (sent["t"] or 0) // (4 * n_buckets) if n_buckets > 1 else 1 << 62
    words = word_answers(batches, n_words, least)
    released(docs.sparkSession)
    tokens, distinct, *seen = _sums(words, CUTOFF + 3)
    u = Unigrams(tokens, distinct, tuple(seen))
    kept = batches.select("ids", "batch", "lengths", "held", "tokens", "words")
    fields = ["bucket", "batch", "ids", "counts", "sizes", "followers", "mass", "level"]
    missing = {c: F.lit(None).cast("binary") for c in ("sizes", "followers", "mass")}
    answers = words.withColumns({"level": F.lit(1), **missing}).select(fields)
    levels, top = [], _top(words)
    for k in range(2, order + 1):
        # All texts start after ends alone, which no gram of the level below is.
        hot = np.unique(np.append(top, context_hash(np.zeros((1, k - 1), np.int64)))) if n_buckets > 1 else top[:0]
        found = gram_answers(_ask(kept.drop("ids"), answers, u, levels, n_words, n_buckets, hot), u, levels, hot, least)
        released(docs.sparkSession)
        levels.append(_level(found, hot))
        answers = answers.unionByName(found.withColumns({"level": F.lit(k), "ids": F.lit(None).cast("binary")}).select(fields))
        top = _top(found)
    id_type = docs.schema[id_col].dataType
    out = T.StructType().add(id_col, id_type).add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables, found = [], right.to_pylist()
        for i, row in enumerate(left.drop_columns(["ids"]).to_pylist()):
            b = _assembled(row, found, n_words)
            grams = b.levels(order)
            logs = np.log10(_below(b, grams, u, levels, found, n_buckets).p)[grams[-1].at]
            start = np.concatenate([[0], np.cumsum(b.lengths)[:-1]])
            c = b.counts[b.tokens]
            base = np.log10((c + 0.5) / (u.tokens + 0.5 * (u.words + 1)))
            cols = [b.held, b.lengths, np.add.reduceat((c > 0).astype(np.int64), start), np.full(len(start), u.tokens), np.add.reduceat(base, start), np.add.reduceat(logs, start)]
            ids = left["ids"].combine_chunks()[i].values
            tables.append(pa.Table.from_arrays([ids, *(pa.array(x) for x in cols)], names=out.names))
        return pa.concat_tables(tables) if tables else pa.table({f.name: pa.array([], t) for f, t in zip(out, [left.schema.field("ids").type.value_type, pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2], strict=True)})

    return _meet(kept, answers).applyInArrow(run, out)
