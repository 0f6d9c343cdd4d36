from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
OURS = bpe.Bpe(bpe._spec(PATH))
THEIRS = Tokenizer.from_file(PATH)


def want(text):
    ids = THEIRS.encode(text, add_special_tokens=False).ids
    return ids, THEIRS.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "a", "a" * 20_000, "ab" * 9000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext|", "  \n\n x  ", "don't WE'LL 's", "日本語 🙂👩‍👩‍👧", "\x00\x1c\x85\xa0 ", "١٢٣ ²½ 12345", "é" * 300 + "é" * 300])
def test_equals_the_library(text):
    ids = OURS.encode(text)
    assert (ids, OURS.decode(ids)) == want(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_equals_the_library(text):
    ids, decimals = OURS.encode_with_decimals(text)
    assert (ids, OURS.decode(ids)) == want(text) and decimals == ",".join(map(str, ids))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=50))
def test_any_ids_decode_as_in_the_library(ids):
    assert OURS.decode(ids) == THEIRS.decode(ids, skip_special_tokens=False)


def test_stale_entries_are_skipped():
    """Merges by a plain scan for the lowest rank give the same."""

    def plain(word):
        ids = [OURS.byte_id[b] for b in word]
        while True:
            best = min(((OURS.merges[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in OURS.merges), default=None)
            if best is None:
                return ids
            (_, to), i = best
            ids[i : i + 2] = [to]

    for word in ("abababab", "aaaaaaa", "mississippi", "the" * 9, "!!!!!!!!!!", "ththeethe"):
        assert OURS.merge(word.encode()) == plain(word.encode())


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Bpe(bpe._spec(public_tokenizers.path("word_bpe_49k.json")))


def test_settings_that_would_change_ids_are_refused():
    import json

    spec = json.loads(bpe._spec(PATH))
    small = spec | {"model": spec["model"] | {"merges": []}}
    bpe.Bpe(json.dumps(small))
    for change in (
        {"model": small["model"] | {"ignore_merges": True}},
        {"model": small["model"] | {"dropout": 0.1}},
        {"pre_tokenizer": spec["pre_tokenizer"] | {"use_regex": False}},
        {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]},
        {"decoder": {"type": "WordPiece"}},
    ):
        with pytest.raises(ValueError, match="not supported"):
            bpe.Bpe(json.dumps(small | change))


def test_odd_rows(spark, odd, none):
    rows = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(odd, PATH).collect()), key=repr)
    expected = []
    for r in odd.collect():
        ids, text = want(r["text"] or "")
        expected.append((r["doc_id"], len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest()))
    assert rows == sorted(expected, key=repr)
    tokens = bpe.encode(odd, PATH)
    assert tokens.columns == [*odd.columns, "_ids"]
    back = bpe.decode(tokens, PATH, "_ids")
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
    assert bpe.digests(none, PATH).count() == 0 and bpe.encode(none, PATH).count() == 0
