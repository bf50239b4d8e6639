"""Removal against brute force over every string of every text."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tidebook.llm import suffixes
from tidebook.llm.common import table


def brute(texts, length):
    """(bytes, removed, spans, kept) per text, all strings counted."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), kept))
    return out


def found(df, length=suffixes.LENGTH):
    rows = suffixes.remove_repeats(df, length=length).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.orderBy("doc_id").collect()
    assert found(docs) == dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], 200), strict=True))


def planted(seed, n=40):
    """Texts that share passages of lengths around the limit, edited copies, and repeats inside one."""
    r = random.Random(seed)
    letters = "abcdefgh é\0"
    make = lambda k: "".join(r.choice(letters) for _ in range(k))
    passages = [make(k) for k in (30, 59, 60, 61, 62, 100, 150, 300)]
    texts = []
    for i in range(n):
        parts = [make(r.randrange(0, 90))]
        for _ in range(r.randrange(4)):
            parts += [r.choice(passages), make(r.randrange(0, 40))]
        text = "".join(parts)
        if i % 5 == 0 and texts:
            at = r.randrange(len(texts[-1]) + 1)
            text = texts[-1][:at] + "#" + texts[-1][at:]
        texts.append(text)
    return [*texts, "z" * 200, "ab" * 90, texts[0], None, ""]


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, docs_of, seed):
    texts = planted(seed)
    assert found(docs_of(enumerate(texts)), 60) == dict(enumerate(brute(texts, 60)))


def test_grams_with_many_contexts_are_compared_across_tasks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARE_LEAST", 3)
    monkeypatch.setattr(suffixes, "SHARE_MOST", 3)
    texts = planted(3)
    assert found(docs_of(enumerate(texts)), 60) == dict(enumerate(brute(texts, 60)))


def test_small_sorts_and_small_blocks(spark, docs_of, monkeypatch):
    texts = planted(4, 25)
    monkeypatch.setattr(suffixes, "SORTED", 10)
    assert found(docs_of(enumerate(texts)), 60) == dict(enumerate(brute(texts, 60)))
    # Blocks smaller than a text: anchors of every string are found all the same.
    monkeypatch.setattr(suffixes, "BLOCK", 256)
    text = texts[0] * 3 + texts[1]
    seen = set()
    for _, offsets, parts in suffixes.pieces([text.encode()], 60):
        for offset, part in zip(offsets, parts, strict=True):
            got = suffixes.anchors(np.frombuffer(part, np.uint8), np.array([len(part)]), 60)
            for lo, hi in zip(got[2], got[3], strict=True):
                seen.update(range(offset + lo, offset + hi + 1))
    assert seen == set(range(len(text.encode()) - 59))


def test_multikey_quicksort_orders_and_measures():
    r = random.Random(6)
    rows = [bytes(r.choice(b"ab") for _ in range(24)) for _ in range(300)] + [b"a" * 24] * 3
    order, common = suffixes.suffix_sort(suffixes.padded(rows, 24))
    in_order = [rows[i] for i in order]
    assert in_order == sorted(rows)
    for a, b, n in zip(in_order, in_order[1:], common[1:].tolist(), strict=False):
        assert a[:n] == b[:n] and (n == 24 or a[n] != b[n])


def test_odd_texts_and_repeated_rows(spark, odd):
    rows = odd.collect()
    got = suffixes.remove_repeats(odd).collect()
    key = lambda r: (r["doc_id"], r["n_bytes"])
    want = brute([r["text"] for r in rows], 200)
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == sorted((r["doc_id"], w[1]) for r, w in zip(rows, want, strict=True))
    assert {r["ids"] for r in got} == {"mine"} and len(got) == len(rows)
    assert max(map(key, got))[1] < 200_000


def test_one_text_twice_under_one_id_and_null_ids(spark, docs_of):
    text = "".join(random.Random(9).choice("abc ") for _ in range(300))
    rows = suffixes.remove_repeats(docs_of([(1, text), (1, text), (None, text), (2, "unlike" * 3)])).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 300, 300, 300]


@pytest.mark.parametrize("share", [None, 1])
def test_part_of_a_text_without_id_is_repeated(spark, docs_of, monkeypatch, share):
    if share:
        monkeypatch.setattr(suffixes, "SHARE_LEAST", share)
        monkeypatch.setattr(suffixes, "SHARE_MOST", share)
    r = random.Random(12)
    make = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    shared = make(250)
    rows = [(i, make(300) + shared + make(300)) for i in (None, 1, 2)]
    got = suffixes.remove_repeats(docs_of(rows)).collect()
    want = brute([t for _, t in rows], 200)
    assert {r["doc_id"]: (r["n_removed"], bytes(r["kept"])) for r in got} == {i: (w[1], w[3]) for (i, _), w in zip(rows, want, strict=True)}
    assert all(r["n_removed"] >= 250 for r in got)


def test_a_worker_holds_a_bounded_part_of_a_batch(docs_of):
    """A batch of 16 MB of text takes a few MB in a worker, in the search for anchors and in the removal."""
    import tracemalloc

    import pyarrow as pa
    from pyspark.sql import types as T

    class Rows:
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("body", T.StringType())])

        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    n = 4000
    words = [f"w{i * 7919 % 100_003}" for i in range(700)]
    texts = [" ".join(words)[:4000] + str(i) for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array(texts)], names=["id", "text_hash", "body"])
    for run in (suffixes.find_anchors(Rows(), suffixes.LENGTH), suffixes.packed(Rows())):
        next(run(iter([batch.slice(0, 10)])))
        tracemalloc.start()
        rows = sum(out.num_rows for out in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= n and peak < 24 << 20


def test_empty_table(spark, docs_of):
    assert suffixes.remove_repeats(docs_of([])).count() == 0
