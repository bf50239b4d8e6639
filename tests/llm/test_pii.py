"""Base spans against plain regular expressions; added spans, redaction, long texts."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidebook.llm import pii
from tidebook.llm.common import table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sum_of_digits(number):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(number))))


def valid(kind, what):
    number = re.sub("[^0-9]", "", what)
    if kind == "ip":
        return all(int(p) <= 255 for p in what.split("."))
    if kind == "card":
        return 12 <= len(number) <= 19 and sum_of_digits(number) % 10 == 0
    return kind == "email" or 9 <= len(number) <= 15


def brute(text):
    text = text or ""
    return sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if valid(k, m[0]))


def base_of(row):
    return [(s["start"], s["kind"], s["end"]) for s in row["base"]]


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(3)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(1500):
        body = "4" + digits(14)
        card = next(body + c for c in "0123456789" if sum_of_digits(body + c) % 10 == 0)
        kinds = [
            f"call tel +1 ({digits(3)}) {digits(3)}-{digits(4)} now",
            f"card {card} ok",
            f"token={digits(20)}abc x",
            f"mail a{digits(2)}@ex{digits(1)}.com end",
            f"ip 10.2.{r.randrange(500)}.7 x",
            f"id {digits(16)}",
            f"or +{digits(4)} short",
        ]
        rows.append((i, kinds[i % len(kinds)]))
    return pii.train(spark.createDataFrame(rows, "doc_id long, text string"))


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    rows = pii.detect(docs, pii.train(docs)).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert base_of(row) == brute(row["text"])
        assert set(base_of(row)) <= {(s["start"], s["kind"], s["end"]) for s in row["spans"]}


def test_awkward_texts(spark, model):
    r = random.Random(8)
    texts = ["".join(r.choice("12 3.-+()@ab_é🙂,:") for _ in range(120)) for _ in range(400)]
    texts += ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "0255.0001.2.3", "+1 (2) +49 89 1234567", "a@b..c", "x@-.-", "4111 1111 1111 1111", "4111--1111", "+1" + "2" * 30, "🙂a@b.co"]
    rows = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for row in rows:
        assert base_of(row) == brute(row["text"]), row["text"]


def test_very_long_runs_take_linear_time(spark, model):
    texts = ["1 " * 60_000, "a" * 200_000, "+1 " + "(2) " * 50_000, "9" * 100_000, "a@b.co " * 5_000, "1.2.3.4 " * 5_000, "x" * 100_000 + "@"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["n"] for r in pii.detect(df, model).select("doc_id", F.size("base").alias("n")).collect()}
    assert rows == {0: 0, 1: 0, 2: 0, 3: 0, 4: 5_000, 5: 5_000, 6: 0}


def test_added_spans(spark, model):
    texts = ["tel (419) 718-3614 ask", "me (at) home (dot) org", "token=12345678901234567890abc", "version 2.0 of 1999"]
    rows = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    cut = [[(pii.KINDS[s["kind"]], r["text"][s["start"] : s["end"]]) for s in r["spans"]] for r in rows]
    assert cut[0] == [("phone", "(419) 718-3614")] and cut[2] == cut[3] == []
    for row in rows:
        ends = [0]
        for s in row["spans"]:
            assert s["start"] >= ends[-1]
            ends.append(s["end"])


def test_added_spans_extend_base_spans(spark):
    sure = pii.Model([], [0.5] * len(pii.KINDS))
    df = pii.detect(spark.createDataFrame([(1, "an müller@example.de hier")], "doc_id long, text string"), sure)
    row = df.select("*", pii.redacted(F.col("text"), F.col("spans")).alias("out")).first()
    assert base_of(row) == brute(row["text"]) == [(5, 0, 20)]
    assert [(s["start"], s["kind"], s["end"]) for s in row["spans"]] == [(3, 0, 20), (5, 0, 20)]
    assert row["out"] == "an [EMAIL] hier"


def test_chains_of_added_spans(spark, model, monkeypatch):
    """Of A-B-C, where B overlaps both, A and C stay; also over the end of a block."""
    monkeypatch.setattr(pii, "PREFIX_BLOCK", 4)
    monkeypatch.setattr(pii, "BASE", {"email": r"never@", "ip": r"never@", "card": r"never@", "phone": r"never@"})
    monkeypatch.setattr(pii, "WIDE", [("email", "a@b"), ("email", "b-c"), ("email", "c-d")])
    texts = ["a@b-c-d " * 7, "b-c-d @", "none @"]
    sure = pii.Model([], [0.5] * len(pii.KINDS))
    rows = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sure).orderBy("doc_id").collect()
    cut = [[r["text"][s["start"] : s["end"]] for s in r["spans"]] for r in rows]
    assert cut == [["a@b", "c-d"] * 7, ["b-c"], []]


def test_held_out_precision(spark):
    """On texts the trees have not seen, base matches that score above the threshold pass their check."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    seen, unseen = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    found = pii.train(seen)
    base = unseen.select(F.explode(F.filter(pii.candidates(F.coalesce("text", F.lit(""))), lambda c: c["base"])).alias("c"))
    rows = base.select(F.col("c.passed").cast("int").alias("passed"), *(v.alias(k) for k, v in pii.features(F.col("c")).items()))
    cut = F.element_at(F.array(*map(F.lit, found.thresholds)), F.col("kind") + 1)
    taken = rows.where(found.probability(F.col) >= cut).agg(F.avg("passed"), F.count("*")).first()
    assert taken[1] > 0 and taken[0] >= 0.9


def test_training_takes_every_text(spark, monkeypatch):
    """Rare matches of a table beyond 50,000 texts all reach trees and thresholds."""
    summed = []
    plain = pii.settle
    monkeypatch.setattr(pii, "settle", lambda df, label: summed.append(plain(df, label)) or summed[-1])
    n = 60_000
    text = F.when(F.col("id") % 50 == 0, F.lit("mail a@b.co")).otherwise("none")
    pii.train(spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text")))
    assert summed[0].agg(F.sum("times")).first()[0] == n // 50


def test_redaction(spark, model):
    rows = [(1, "é a@b.co and 1.2.3.4, ok"), (2, None), (3, ""), (4, "none"), (5, "+1 (632) 555-4827")]
    df = pii.detect(spark.createDataFrame(rows, "doc_id long, text string"), model)
    got = {r["doc_id"]: r["out"] for r in df.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("out")).collect()}
    assert got == {1: "é [EMAIL] and [IP], ok", 2: None, 3: "", 4: "none", 5: "[PHONE]"}


def test_odd_and_empty_tables(spark, odd, docs_of, model):
    rows = pii.detect(odd, model).collect()
    assert len(rows) == odd.count() and all(not r["base"] for r in rows) and rows[0]["toxic"] == "mine"
    empty = docs_of([])
    assert pii.detect(empty, pii.train(empty)).count() == 0
    assert all(not r["spans"] for r in pii.detect(odd, pii.train(odd)).collect())


def test_written(spark, model):
    df = pii.detect(spark.createDataFrame([(1, "x a@b.co 1.2.3.4")], "doc_id long, text string"), model)
    assert df.select(pii.written(F.col("base"))).first()[0] == "email:2:8,ip:9:16"


def test_plan_has_no_python(spark, sf, model):
    plan = pii.detect(table(spark, sf, "documents"), model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
