"""Held-out accuracy of the chain, and its parts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.llm import toxicity as t
from tidebook.llm.common import table


def corpus(n, seed):
    r = random.Random(seed)
    bad = ["vile", "wretch", "grubling", "grubbed", "grubish"]
    out = []
    for i in range(n):
        toxic = int(r.random() < 0.2)
        words = ["".join(r.choice("aeioulmnrst") for _ in range(r.randrange(2, 8))) for _ in range(r.randrange(30, 90))]
        if toxic:
            for _ in range(r.randrange(2, 8)):
                words[r.randrange(len(words))] = r.choice(bad)
        out.append((i, " ".join(words), toxic))
    return out


def test_held_out_accuracy(spark):
    rows = corpus(600, 1)
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = t.train(known.select("doc_id", "text"), known.select("doc_id", "toxic"))
    new = corpus(300, 2)
    got = {r["doc_id"]: r["toxic"] for r in t.score(spark.createDataFrame([(i, x) for i, x, _ in new], "doc_id long, text string"), chain).collect()}
    assert sum(got[i] == bool(y) for i, _, y in new) >= 297


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_labels_of_the_table(spark, sf):
    """Half the labels train; the others judge."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    chain = t.train(docs, labels.where(half))
    judged = t.score(docs.join(labels.where(~half), "doc_id").withColumnRenamed("toxic", "label"), chain)
    counts = {(r["label"], r["toxic"]): r["count"] for r in judged.groupBy("label", "toxic").count().collect()}
    caught, missed = counts.get((1, True), 0), counts.get((1, False), 0)
    wrong, clean = counts.get((0, True), 0), counts.get((0, False), 0)
    assert caught / (caught + missed) > 0.9 and wrong / (wrong + clean) < 0.01


def test_chain_feeds_earlier_categories(spark):
    rows = corpus(400, 3)
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = t.train(known.select("doc_id", "text"), known.select("doc_id", "toxic"))
    m = len(chain.vocabulary)
    assert [len(w) for w in chain.weights] == [1 + m, 2 + m, 3 + m]
    assert chain.weights[1][-1] > 0  # what is likely toxic is likelier strong
    p = chain.probabilities([[], list(range(m))])
    assert p.shape == (2, 3) and (p[0] < p[1]).all()


def test_training_is_the_same_in_any_order(spark):
    rows = corpus(200, 4)
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string, toxic int")
    one, two = frame(rows), frame(rows[::-1]).repartition(5)
    a = t.train(one.select("doc_id", "text"), one.select("doc_id", "toxic"))
    b = t.train(two.select("doc_id", "text"), two.select("doc_id", "toxic"))
    assert a.vocabulary == b.vocabulary and a.thresholds == b.thresholds
    assert all(np.array_equal(x, y) for x, y in zip(a.weights, b.weights, strict=True))


def test_sample_is_bounded(spark):
    rows = corpus(100, 5)
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert t.sample(known.select("doc_id", "text"), known.select("doc_id", "toxic"), "doc_id", 30).count() == 30


def test_odd_texts_and_labels(spark, odd, docs_of):
    labels = spark.createDataFrame([(0, None), (1, 1), (1, 0), (7, 0), (8, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    rows = t.score(odd, t.train(odd, labels)).collect()
    assert len(rows) == odd.count() and rows[0]["kept"] == "mine" and not any(r["toxic"] for r in rows)
    none = labels.limit(0)
    assert not any(r["toxic"] for r in t.score(odd, t.train(odd, none)).collect())
    empty = docs_of([])
    assert t.score(empty, t.train(empty, labels)).count() == 0
