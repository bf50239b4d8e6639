"""Ranked search against scoring every document, one by one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidebook.llm import bag_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    bags = [(key, Counter(brute_terms(text))) for key, text in docs]
    sizes = [sum(bag.values()) for _, bag in bags]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for (key, bag), size in zip(bags, sizes, strict=True):
            m = 10 + (90 * size * n) // max(length, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in set(brute_terms(text)) if t in bag
            )
            if score > 0:
                scored.append((-score, key is None, key, score))
        scored.sort(key=lambda s: s[:2] + (s[2] or 0,))
        out += [(item, rank, key, score) for rank, (_, _, key, score) in enumerate(scored[:top], 1)]
    return out


def corpus(n=300, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdé" for b in "xyz0"] + ["日本", "ÀB"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 30)))) for i in range(n)]
    docs += [(1000 + i, docs[i % 7][1].upper() + " !") for i in range(100)]  # large classes, equal scores
    return docs, [(i, " ".join(r.choice([*words, "unknown"]) for _ in range(r.randrange(0, 9)))) for i in range(40)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (str(t[0]), t[1]))


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def check(spark, docs_of, docs, items, **more):
    got = found(bag_search.search(docs_of(docs).repartition(5), "doc_id", "text", asked(spark, items), "item_id", "text", **more))
    assert got == sorted(brute(docs, items, **more), key=lambda t: (str(t[0]), t[1]))
    return got


@pytest.mark.parametrize("top", [1, 10])
def test_every_score_and_tie(spark, docs_of, top):
    assert len(check(spark, docs_of, *corpus(), top=top)) > 30 * top


def test_blocks_of_items_change_nothing(spark, docs_of, monkeypatch):
    monkeypatch.setattr(bag_search, "ITEMS", 9)
    monkeypatch.setattr(bag_search, "PAIRS", 50)
    check(spark, docs_of, *corpus())


def test_odd_texts_repeated_rows_and_null_keys(spark, odd, docs_of):
    items = [(1, "same word text"), (1, "nul line"), (None, "a é"), (2, None), (3, ""), (4, "nowhere")]
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()] + [(None, "same word"), (None, "a")]
    check(spark, docs_of, docs, items)
    assert bag_search.search(odd, "doc_id", "text", asked(spark, items), "item_id", "text").columns == ["item_id", "rank", "doc_id", "score"]


def test_empty_tables(spark, docs_of):
    none, some = asked(spark, []), asked(spark, [(1, "a")])
    for docs, items in ((docs_of([]), some), (docs_of([(1, "a")]), none), (docs_of([(1, None)]), some)):
        assert bag_search.search(docs, "doc_id", "text", items, "item_id", "text").count() == 0
    with pytest.raises(ValueError, match="differ"):
        bag_search.search(docs_of([]).withColumnRenamed("doc_id", "item_id"), "item_id", "text", none, "item_id", "text")


def test_packed_bags_come_back():
    import pyarrow as pa

    bags = [{3: 1, 70_000: 2}, {0: 300}, {5: 70_000, 6: 1}]
    column = pa.array([bag_search.packed(b, "<u4") for b in bags], pa.binary())
    numbers, counts, sizes = bag_search.unpacked(column, "<u4")
    assert numbers.tolist() == [3, 70_000, 0, 5, 6] and counts.tolist() == [1, 2, 300, 70_000, 1] and sizes.tolist() == [2, 1, 2]


def test_sums_too_large_for_doubles_are_exact():
    weight = np.array([(1 << 53) // 10**6 + 12345, 7], np.int64)
    scorer = bag_search.Scorer(weight, np.array([0, 1, 2]), np.array([0, 0]), 1, 2)
    assert not scorer.in_doubles
    scorer.add(np.array([5]), np.array([10]), np.array([0, 1]), np.array([1000, 1]), np.array([2]))
    gain = lambda w, tf: w * ((10**9 * tf) // (1000 * tf + 80))
    assert scorer.found()[1].tolist() == [gain(int(weight[0]), 1000) + gain(7, 1)]
