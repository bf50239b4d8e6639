"""Importance resampling against hashing every run of words as a string."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidebook.llm import importance as imp

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_features(text, most, buckets):
    words = brute_words(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, aims, most, buckets, least=20, percent=10, seed="2024"):
    every = [brute_features(t, most, buckets) for _, t in docs]
    s, t = Counter(b for f in every for b in f), Counter(b for text in aims for b in brute_features(text, most, buckets))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    rows = []
    for (key, text), f in zip(docs, every, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        rows.append([key, len(brute_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, rows), key=str)


def corpus(n=200, seed=5):
    r = random.Random(seed)
    words = ["alpha", "béta", "日本", "x1", "Gamma", "d", "long" * 20, "Y" * 400]
    return [(i, " ".join(r.choice(words) + r.choice(["", ",", "\n", " ..."]) for _ in range(r.randrange(0, 60)))) for i in range(n)]


def drawn(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("most", "buckets"), [(1, 10_000), (3, 500), (2, 100_000)])
def test_every_row(spark, docs_of, most, buckets):
    docs, aims = corpus(), ["alpha béta alpha x1", "日本 d", None]
    target = spark.createDataFrame([(a,) for a in aims], "text string")
    got = imp.resample(docs_of(docs).repartition(4), "doc_id", "text", target, "text", most=most, buckets=buckets)
    assert drawn(got) == brute(docs, aims, most, buckets)


def test_small_blocks_and_ranges_change_nothing(spark, docs_of, monkeypatch):
    monkeypatch.setattr(imp, "BLOCK", 500)
    monkeypatch.setattr(imp, "RANKED", 10)
    docs, aims = corpus(), ["alpha alpha"]
    got = imp.resample(docs_of(docs), "doc_id", "text", docs_of([(1, aims[0])]), "text", percent=70)
    assert drawn(got) == brute(docs, aims, 1, 10_000, percent=70)


def test_odd_texts(spark, odd, docs_of):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = imp.resample(odd, "doc_id", "text", docs_of([(1, "word word x")]), "text", percent=100, least_words=0)
    assert drawn(got) == brute(docs, ["word word x"], 1, 10_000, least=0, percent=100)


def test_null_keys_empty_tables_and_clashing_keys(spark, docs_of):
    docs = [(None, "a b " * 20), (None, "a b " * 20), (3, "a c " * 20)]
    assert drawn(imp.resample(docs_of(docs), "doc_id", "text", docs_of([]), "text", percent=100)) == brute(docs, [], 1, 10_000, percent=100)
    assert imp.resample(docs_of([]), "doc_id", "text", docs_of([(1, "a")]), "text").count() == 0
    with pytest.raises(ValueError, match="rank"):
        imp.resample(docs_of([]).withColumnRenamed("doc_id", "rank"), "rank", "text", docs_of([]), "text")


@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), min_size=1, max_size=9), min_size=1, max_size=8), st.integers(1, 4))
def test_composed_runs_are_the_strings_own(words, most):
    data = [w.encode() for w in words]
    got = imp.runs(np.array([imp.payload(w) for w in data], np.int64), most)
    assert got.tolist() == [zlib.crc32(b" ".join(data[i : i + n])) for n in range(1, min(most, len(data)) + 1) for i in range(len(data) - n + 1)]


def test_the_dictionary_emits_words_in_order():
    texts = [t.encode().translate(imp.LETTERS) for t in ("The cat, the CAT's  hat", "", "...", "x" * 300 + " y", "a b a b")]
    for text, found in zip(texts, imp.scanned(texts), strict=True):
        assert found.tolist() == [imp.payload(w) for w in text.split()]
