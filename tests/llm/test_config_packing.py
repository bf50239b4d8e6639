"""Ids as the library gives them, every id in one piece, windows gapless, as few as the bound allows."""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidebook.llm import config_packing as cp
from tidebook.llm import word_ids
from tidebook.llm.common import table
from tidebook.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def own(text):
    return np.frombuffer(word_ids.encoder(PATH)(text), "<u4").tolist()


def check(pieces, texts, library, window=cp.WINDOW):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_window[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, parts in by_doc.items():
        ids = np.array([*library(texts[doc]), 0], "<u4")
        parts.sort(key=lambda p: p["piece"])
        assert [p["start"] for p in parts] == list(range(0, len(ids), window))
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        for p in parts:
            part = ids[p["start"] : p["start"] + window]
            assert p["length"] == len(part) and p["ids_crc32"] == zlib.crc32(part.tobytes())
            assert "ids" not in p or p["ids"] is None or p["ids"] == part.tolist()
        total += len(ids)
    for parts in by_window.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return len(by_window), -(-total // window)


def test_whole_table_is_near_the_bound(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    pieces = [r.asDict() for r in QUERIES["op12_config_packing"](spark, sf).collect()]
    windows, bound = check(pieces, texts, library)
    assert windows <= 1.01 * bound + 1


def test_tasks_share_the_plan(spark, docs_of, library):
    texts = {i: f"short text number {i} " * (i % 7 + 1) for i in range(200)}
    pieces = [r.asDict() for r in cp.pack(docs_of(texts.items()).repartition(9), "doc_id", "text", window=64).collect()]
    windows, _ = check(pieces, texts, library, 64)
    counts = np.bincount([p["length"] for p in pieces], minlength=65)
    counts[64] = 0
    solution = cp.solve(counts)
    assert solution.bound <= windows <= 1.05 * solution.windows + 2


def test_odd_texts(spark, odd, library):
    rows = odd.where("doc_id != 7")
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    check([r.asDict() for r in cp.pack(rows, "doc_id", "text").collect()], texts, library)


def test_repeated_rows_null_keys_and_empty_tables(spark, docs_of):
    out = cp.pack(docs_of([(1, "same"), (1, "same"), (None, "same")]), "doc_id", "text").collect()
    assert len({(p["sequence_id"], p["offset"]) for p in out}) == 3 and sum(p["doc_id"] is None for p in out) == 1
    assert cp.pack(docs_of([]), "doc_id", "text").count() == 0


def test_a_key_named_like_an_output_is_refused(docs_of):
    with pytest.raises(ValueError, match="length"):
        cp.pack(docs_of([]).withColumnRenamed("doc_id", "length"), "length", "text")


def test_one_length_for_all_rows(spark, library):
    same = spark.range(3000).selectExpr("id AS doc_id", "'one and the same text' AS text")
    pieces = [r.asDict() for r in cp.pack(same.repartition(7), "doc_id", "text").collect()]
    windows, bound = check(pieces, dict.fromkeys(range(3000), "one and the same text"), library)
    assert windows == -(-3000 // (cp.WINDOW // pieces[0]["length"]))


# --- ids ---------------------------------------------------------------------------


def test_every_character_gets_the_library_s_ids(library):
    assert not [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and own(t := f"a{chr(c)}1{chr(c)}! {chr(c)}") != library(t)]


@pytest.mark.parametrize("text", ["<|endoftext|> it's", "a\x1cb", "ΑΣ ΑΣ.", "İstanbul", "x" * 100_000, "é é", "don't 're''s", "1234 ½ ²"])
def test_chosen_texts(library, text):
    assert own(text) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    tokenizer = Tokenizer.from_file(PATH)
    assert own(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_the_cache_forgets_without_changing_ids(library, monkeypatch):
    monkeypatch.setattr(word_ids, "CACHED", 3)
    word_ids.encoder.cache_clear()
    text = "one two three four one two five six one, two. seven one"
    assert own(text) == own(text) == library(text)
    word_ids.encoder.cache_clear()


# --- the program ---------------------------------------------------------------------


def brute_knapsack(price):
    size, best = len(price) - 1, 0.0
    for n in range(1, size + 1):
        for some in combinations_with_replacement(range(1, size + 1), n):
            if sum(some) <= size:
                best = max(best, sum(price[x] for x in some))
    return best


def test_knapsack_equals_brute_force():
    for seed in range(20):
        price = np.random.RandomState(seed).rand(8)
        price[0] = 0
        assert cp.knapsack(price)[-1] == pytest.approx(brute_knapsack(price))


def test_the_bound_holds_and_the_program_closes_on_it():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 50, 25]] = [400, 400, 300, 200]  # perfect fillings exist: 400 + 150 + 50
    solution = cp.solve(counts)
    assert solution.bound <= 600 + 1e-6 and solution.windows >= 600 - 1e-6
    assert solution.windows <= 1.1 * 600 and solution.bound >= 0.98 * 600


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=30))
def test_every_piece_has_one_place(numbers):
    counts = np.array([0, *numbers], np.int64)
    plan, solution = cp.filling(counts, 64)
    seen = np.zeros_like(counts)
    for config, copies in plan:
        assert copies > 0 and sum(length * times for length, times in config) < len(counts)
        for length, times in config:
            seen[length] += times * copies
    assert (seen == counts).all()
    assert sum(copies for _, copies in plan) >= solution.bound - 1e-6


def test_best_fit_equals_the_plain_algorithm():
    for seed in range(50):
        r = np.random.RandomState(seed)
        counts = r.randint(0, 9, 31)
        counts[0] = 0
        rooms, windows = [], 0
        for length in range(30, 0, -1):
            for _ in range(counts[length]):
                fits = [x for x in rooms if x >= length]
                if fits:
                    rooms.remove(min(fits))
                    rooms.append(min(fits) - length)
                else:
                    windows += 1
                    rooms.append(30 - length)
        assert sum(copies for _, copies in cp.best_fit(counts)) == windows
