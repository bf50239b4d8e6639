"""Every id in one piece, windows gapless and never too long, little padding."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidebook.llm import packing
from tidebook.llm.common import table


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def check(pieces, texts, plain, window=packing.WINDOW):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_window[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = np.array([*plain(texts[doc]), 0], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            part = ids[at : at + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            assert p["ids"] is None or p["ids"] == part.tolist()
            at += p["length"]
        assert at == len(ids)
    for parts in by_window.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return len(by_window)


def test_whole_table(spark, sf, plain):
    docs = table(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces = packing.pack(docs.repartition(5), "doc_id", "text").collect()
    windows = check(pieces, texts, plain)
    tokens = sum(p["length"] for p in pieces)
    assert windows * packing.WINDOW < 1.05 * tokens + packing.WINDOW


def test_many_tasks_merge_in_rounds(spark, docs_of, plain, monkeypatch):
    monkeypatch.setattr(packing, "MERGED_TASKS", 2)
    texts = {i: f"short text number {i} " * (i % 5 + 1) for i in range(60)}
    pieces = packing.pack(docs_of(texts.items()).repartition(9), "doc_id", "text", window=64, open_windows=3).collect()
    check(pieces, texts, plain, 64)


def test_odd_texts(spark, odd, plain):
    rows = odd.where("doc_id != 7")
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    check(packing.pack(rows, "doc_id", "text", with_ids=False).collect(), texts, plain)


def test_a_special_token_in_a_text(spark, docs_of, plain):
    texts = {1: "x <|endoftext|> y", 2: "<|endoftext|>" * 1500, 3: "<|endoftext|"}
    check([r.asDict() for r in packing.pack(docs_of(texts.items()), "doc_id", "text").collect()], texts, plain)


def test_repeated_rows_are_packed_one_by_one(spark, docs_of):
    pieces = packing.pack(docs_of([(1, "same"), (1, "same")]), "doc_id", "text").collect()
    assert len(pieces) == 2 and len({(p["sequence_id"], p["offset"]) for p in pieces}) == 2


def test_empty_table(spark, docs_of):
    assert packing.pack(docs_of([]), "doc_id", "text").count() == 0


def test_what_tiktoken_refuses_goes_to_tokenizers(plain):
    encode = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert 50256 in encode("x <|endoftext|> y")
    for text in ("<|endoftext|> is a token", "x <|endoftext|> y", "^" * 20_000, " " * 20_000, "it's"):
        assert list(encode(text)) == plain(text)


def test_best_fit_and_fullest_out():
    windows = packing.OpenWindows(0, 10, 2)
    first, second = windows.place(6)[0], windows.place(5)[0]
    assert windows.place(5) == (second, 5)  # fits only the emptier one, which is full now
    assert windows.closed == [second]
    third = windows.place(9)[0]
    assert windows.place(8)[0] not in (first, third)
    assert windows.closed == [second, third]  # the fullest went
