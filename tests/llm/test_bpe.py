"""Encoding against the library that defines it, and exact round trips."""

from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidebook.llm import bpe


@pytest.fixture(scope="module")
def library():
    with open(bpe.default_vocabulary(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def own(texts):
    return [x.tolist() for x in bpe.vocabulary(bpe.default_vocabulary()).encode(texts, bpe.compiled(public_tokenizers.PATTERN))]


@settings(max_examples=60, deadline=None)
@given(text=st.text(max_size=200))
def test_equals_the_library(library, text):
    assert own([text, text + " tail"]) == [library.encode_ordinary(text), library.encode_ordinary(text + " tail")]


def test_trees_of_all_sizes(library):
    r = random.Random(5)
    words = ["".join(r.choice("abtheing") for _ in range(n)) for n in (1, 2, 3, 7, 8, 9, 63, 64, 65, 255, 256, 257, 5000)]
    words += ["ab" * 3000, "a" * 3000, " " * 700, "<|endoftext|>", "漢字" * 40]
    assert own(words) == [library.encode_ordinary(w) for w in words]


def test_long_text_in_blocks(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    monkeypatch.setattr(bpe, "BLOCK_PIECES", 7)
    text = "the quick brown fox, 123 times; it's gone  \n\n now " * 20
    assert own([text]) == [library.encode_ordinary(text)]


def test_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    texts = ["one two three four five six seven", "eight nine ten eleven"]
    assert own(texts) == [library.encode_ordinary(t) for t in texts]


def test_round_trip_in_spark(spark, odd, library):
    coded = bpe.decode(bpe.encode(odd, "text"))
    assert coded.columns.count("ids") == 1 and "kept" in coded.columns
    for row in coded.collect():
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert row["kept"] == "mine"


def test_empty_table(spark, docs_of):
    assert bpe.decode(bpe.encode(docs_of([]), "text")).count() == 0
