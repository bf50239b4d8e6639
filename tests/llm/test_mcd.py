"""Statistics and robust fit against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidebook.llm import quality as q
from tidebook.llm.common import table


def brute_statistics(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    again = {k for i, w in enumerate(windows) if seen[w] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in q.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(again)


NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def brute_verdicts(rows):
    """Kept, by the same steps in floating point: start, concentration by bins, one reweighting."""
    stats = [brute_statistics(r["text"]) for r in rows]
    failed = [s[0] < 10 or 100 * s[5] > 20 * s[0] for s in stats]
    cells = defaultdict(list)
    for i, r in enumerate(rows):
        if not failed[i]:
            cells[r["lang"], r["source"]].append(i)
    small = Counter()
    for (lang, _), members in cells.items():
        small[lang] += len(members) if len(members) < q.LEAST_GROUP else 0
    groups = defaultdict(list)
    for (lang, source), members in cells.items():
        name = (lang, source) if len(members) >= q.LEAST_GROUP else (lang,) if small[lang] >= q.LEAST_GROUP else ()
        groups[name] += members
    kept = [False] * len(rows)
    floor = np.diag((np.array(q.LEAST_DEVIATION) * q.UNITS) ** 2)
    for members in groups.values():
        s = np.array([stats[i] for i in members], float)
        words, chars, symbols, lines, dup, again = s.T
        mean = chars.sum() / words.sum()
        x = np.column_stack([np.log((chars + 50 * mean) / (words + 50)), np.log1p(symbols / (words + 20)), dup / (lines + 5), again / (words + 20)])
        x = np.floor(x * q.UNITS + 0.5)

        def fit(inside, factor, x=x):
            cov = factor * (x[inside].T @ x[inside] / inside.sum() - np.outer(x[inside].mean(0), x[inside].mean(0)))
            cov[np.diag_indices(4)] = np.maximum(cov.diagonal(), 0)
            return x[inside].mean(0), cov + floor

        def distance(centre, cov, x=x):
            y = np.linalg.solve(np.linalg.cholesky(cov), (x - centre).T)
            return (y * y).sum(0)

        low, mid, high = np.percentile(x, [25, 50, 75], axis=0)
        centre, cov = mid, np.diag(np.maximum((high - low) / 1.349, np.sqrt(floor.diagonal())) ** 2)
        for _ in range(q.STEPS):
            bins = np.floor(np.log2(1 + distance(centre, cov)) * q.BINS_PER_DOUBLING)
            last = np.sort(bins)[int(np.ceil(len(x) * q.SUBSET)) - 1]
            centre, cov = fit(bins <= last, q.SUBSET_FACTOR)
        centre, cov = fit(distance(centre, cov) <= q.INNER, q.INNER_FACTOR)
        for i, d in zip(members, distance(centre, cov), strict=True):
            kept[i] = bool(d <= q.CUTOFF)
    return stats, failed, kept


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.orderBy("doc_id").collect()
    stats, failed, kept = brute_verdicts(rows)
    got = {r["doc_id"]: r for r in q.judge(docs).collect()}
    assert len(got) == len(rows)
    for r, s, f, k in zip(rows, stats, failed, kept, strict=True):
        mine = got[r["doc_id"]]
        assert tuple(mine[n] for n in NAMES) == s and mine["base_failed"] == f and mine["kept"] == k, r["doc_id"]
    assert 0 < sum(kept) < sum(not f for f in failed)


def test_labels_of_quality(spark):
    """Junk is found, clean texts stay."""
    sf = "/root/testdata/sf0.01"
    judged = q.judge(table(spark, sf, "documents")).join(table(spark, sf, "labels"), "doc_id")
    rates = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.95 and rates[0] < 0.1


def test_repeated_words_of_odd_texts(spark, odd):
    got = q.judge(odd).collect()
    assert len(got) == odd.count()
    want = {r["doc_id"]: brute_statistics(r["text"]) for r in odd.collect()}
    for r in got:
        assert tuple(r[n] for n in NAMES) == want[r["doc_id"]]
        assert r["base_failed"] and not r["kept"] and r["distance"] is None


def test_null_groups_and_one_large_group(spark):
    text = lambda i: " ".join(f"w{(i * 31 + k * k) % 997}" for k in range(60))
    rows = [(i, text(i), None if i % 3 else "en", None if i % 2 else "s") for i in range(300)] + [(999, "#%$| " + "# % $ | * & " * 20 + text(5), None, None)]
    got = {r["doc_id"]: r for r in q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i]["kept"] for i in range(300))
    assert not got[999]["kept"]


def test_group_with_much_junk(spark):
    """Two fifths of a source are full of symbols: they go, the others stay."""
    r = random.Random(1)

    def text(junk):
        words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9))) for _ in range(80)]
        return " ".join(w + ("#" if junk and r.random() < 0.9 else "") for w in words)

    rows = [(i, text(i % 5 < 2), "en", "s") for i in range(500)]
    got = {r["doc_id"]: r["kept"] for r in q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(got[i] for i in range(500) if i % 5 < 2) == 0
    assert sum(got[i] for i in range(500) if i % 5 >= 2) >= 0.98 * 300


def test_groups_too_many_to_send(spark, sf, monkeypatch):
    docs = table(spark, sf, "documents")
    usual = sorted(map(tuple, q.judge(docs).select("doc_id", "kept").collect()))
    monkeypatch.setattr(q, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, q.judge(docs).select("doc_id", "kept").collect())) == usual


def test_empty_table_and_plan(spark, sf, docs_of):
    assert q.judge(docs_of([])).count() == 0
    plan = q.statistics(table(spark, sf, "documents"), ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
