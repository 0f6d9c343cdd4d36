"""Byte-level BPE: a priority queue of merge ranks over a doubly linked symbol list; decoding joins vocabulary strings.

The tokenizer file (vocabulary, ranked merges, special tokens) is a parameter. The driver reads it and sends it
to the executors; its size is checked against MAX_FILE first. Every text is encoded whole.

Edge cases. Null text counts as empty: no tokens, the digests of the empty string. Special tokens' strings
in a text become their tokens, the longest first among those that start at one place, as the tokenizers
library does by default. A very long word costs n log n. Repeated rows and null ids stay; other columns are
ignored by digests() and kept by encode(). An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import unused

MAX_FILE = 64 << 20
#: Words in each of the two generations that a worker remembers, and the longest that it remembers.
CACHE, CACHE_WORD = 250_000, 64
#: The public pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Bpe:
    """Encoder and decoder for one tokenizer file of the byte-level kind."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        odd = [k for k in ("ignore_merges", "dropout", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        odd += [] if pre.get("use_regex", True) else ["use_regex"]
        odd += [f"{k} of {t['content']}" for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word") if t.get(k)]
        if odd or (spec.get("decoder") or {}).get("type") != "ByteLevel":
            raise ValueError(f"not supported: {', '.join(odd) or 'another decoder than ByteLevel'}")
        self.vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_id = [self.vocab[x] for x in letters]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        of_letter = {x: b for b, x in enumerate(letters)}
        self.strings = {i: bytes(of_letter[x] for x in s) for s, i in self.vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: (left id, right id) -> (rank, merged id)
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.words = regex.compile(PATTERN).findall
        by_length = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")").split if by_length else lambda text: [text]
        self.known: dict[str, tuple[list[int], str]] = {}
        self.older: dict[str, tuple[list[int], str]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word. The queue holds (rank, place of the left symbol, right id seen); stale entries are skipped."""
        ids = [self.byte_id[b] for b in word]
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapify(queue)
        while queue:
            _, i, left, right, to = heappop(queue)
            j = after[i] if ids[i] == left else -1
            if j < 0 or ids[j] != right:
                continue  # stale: one of the two has merged with another meanwhile
            ids[i], ids[j] = to, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((to, ids[k])):
                    heappush(queue, (m[0], i, to, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], to))):
                heappush(queue, (m[0], h, ids[h], to, m[1]))
        return [x for x in ids if x >= 0]

    def word(self, text: str) -> tuple[list[int], str]:
        """Ids of one word, and the same as decimals joined by commas."""
        found = self.known.get(text)
        if found is None:
            found = self.older.get(text)
            if found is None:
                ids = self.merge(text.encode())
                found = ids, ",".join(map(str, ids))
            if len(text) <= CACHE_WORD:
                if len(self.known) >= CACHE:
                    self.older, self.known = self.known, {}
                self.known[text] = found
        return found

    def _pieces(self, text: str) -> list[tuple[list[int], str]]:
        """What word() gives for each word and special token of a text."""
        out, known = [], self.known
        parts = self.specials(text) if any(s in text for s in self.special) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(([self.special[part]], str(self.special[part])))
                continue
            for w in self.words(part):
                found = known.get(w)
                if found is None:
                    found, known = self.word(w), self.known
                out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids, _ in self._pieces(text) for i in ids]

    def encode_with_decimals(self, text: str) -> tuple[list[int], str]:
        """Ids, and the ids as decimals joined by commas."""
        pieces = self._pieces(text)
        return [i for ids, _ in pieces for i in ids], ",".join([s for _, s in pieces])

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings joined, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        spec = f.read(MAX_FILE + 1)
    if len(spec) > MAX_FILE:
        raise ValueError(f"{path} has over {MAX_FILE} characters")
    return spec


_LOADED: dict[int, Bpe] = {}


def _loaded(spec) -> Bpe:
    """One Bpe for each broadcast in a worker."""
    if spec.id not in _LOADED:
        _LOADED.clear()
        _LOADED[spec.id] = Bpe(spec.value)
    return _LOADED[spec.id]


def _broadcast(df: DataFrame, path: str):
    return _Spec(df.sparkSession.sparkContext.broadcast(_spec(path)))


class _Spec:
    """A broadcast file with a key that survives pickling."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self) -> str:
        return self.broadcast.value


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with the token ids of the text (array<int>) in a further column."""
    (ids_col,) = unused(docs, ids_col)
    spec, at = _broadcast(docs, path), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = pa.array([_loaded(spec).encode(x.as_py() or "") for x in b.column(at)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], schema=b.schema.append(pa.field(ids_col, ids.type)))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """tokens with the decoded text in a further column; null ids give null."""
    (text_col,) = unused(tokens, text_col)
    spec, at = _broadcast(tokens, path), tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([None if (v := x.as_py()) is None else _loaded(spec).decode(v) for x in b.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, text], schema=b.schema.append(pa.field(text_col, text.type)))

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(text_col, T.StringType())]))


_DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, n_tokens, and SHA-256 of its ids and of the text decoded from them; ids needn't leave the worker."""
    spec, rows = _broadcast(docs, path), docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, of_ids, of_text, bpe = [], [], [], _loaded(spec)
            for x in b.column(1):
                ids, decimals = bpe.encode_with_decimals(x.as_py() or "")
                n.append(len(ids))
                of_ids.append(sha256(decimals.encode()).hexdigest())
                of_text.append(sha256(bpe.decode(ids).encode()).hexdigest())
            out = [pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *out], schema=pa.schema([b.schema.field(0), *(pa.field(f.name, a.type) for f, a in zip(_DIGESTS, out, strict=True))]))

    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], *_DIGESTS.fields]))
