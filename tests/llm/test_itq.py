"""Links and components against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tidebook.llm import itq
from tidebook.llm.common import table


def brute(vectors, cosine=0.9):
    n = len(vectors)
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    width = max((len(v) for v, g in zip(vectors, good, strict=True) if g), default=1)
    x = np.array([list(v) + [0.0] * (width - len(v)) if g else [0.0] * width for v, g in zip(vectors, good, strict=True)])
    norms = np.linalg.norm(x, axis=1)
    near = (x @ x.T) >= cosine * np.maximum(np.outer(norms, norms), 1e-300)
    near &= np.outer(good, good) & ~np.eye(n, dtype=bool)
    comp = list(range(n))
    for _ in range(n):
        new = [min([comp[i], *(comp[j] for j in np.flatnonzero(near[i]))]) for i in range(n)]
        if new == comp:
            break
        comp = new
    return near.sum(axis=1).tolist(), comp


def clouds(seed, dims=64, n=400):
    """Strangers, pairs at all angles around the limit, and one dense cloud."""
    r = np.random.default_rng(seed)
    out = [r.normal(size=dims) for _ in range(n)]
    for i in range(0, n, 4):
        noise = r.normal(size=dims)
        noise -= noise @ out[i] / (out[i] @ out[i]) * out[i]
        noise *= np.linalg.norm(out[i]) / np.linalg.norm(noise)
        angle = np.arccos(r.uniform(0.88, 1.0))
        out.append(np.cos(angle) * out[i] + np.sin(angle) * noise)
    centre = r.normal(size=dims)
    out += [centre + 0.1 * r.normal(size=dims) for _ in range(40)]
    return [v.tolist() for v in out]


def run(spark, vectors, **options):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    return [tuple(r) for r in itq.near_duplicates(df, **options).orderBy("vec_id").collect()]


def test_recall_on_clouds(spark):
    vectors = clouds(1)
    links, comps = brute(vectors)
    got = run(spark, vectors)
    assert all(g[1] <= n for g, n in zip(got, links, strict=True))  # none below the limit
    assert sum(g[1] for g in got) >= 0.9 * sum(links)
    assert sum(g[2] == c for g, c in zip(got, comps, strict=True)) >= 0.95 * len(comps)


def test_recall_on_the_table(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").orderBy("vec_id").collect()
    links, comps = brute([r["embedding"] for r in rows])
    got = itq.near_duplicates(table(spark, "/root/testdata/sf0.1", "embeddings")).orderBy("vec_id").collect()
    assert sum(r["n_links"] for r in got) >= 0.9 * sum(links)
    assert all(r["n_links"] <= n for r, n in zip(got, links, strict=True))


@pytest.mark.parametrize("dims", [64, 384])
def test_recall_near_the_limit_of_vectors_not_learned_on(spark, dims):
    """Pairs at cosines of 0.90 to 0.92; the rotation comes from an eighth of the vectors at most."""
    r = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    one = unit(r.normal(size=(2000, dims)))
    noise = r.normal(size=one.shape)
    noise = unit(noise - (noise * one).sum(axis=1, keepdims=True) * one)
    cosine = r.uniform(0.9001, 0.92, size=(2000, 1))
    two = cosine * one + np.sqrt(1 - cosine**2) * noise
    got = run(spark, np.concatenate([one, two]).tolist(), sample=500)
    assert sum(g[1] for g in got) >= 0.95 * 2 * 2000


@pytest.mark.parametrize("dims", [3, 100])
def test_other_sizes(spark, dims):
    vectors = clouds(2, dims, 60)
    links, _ = brute(vectors)
    assert sum(g[1] for g in run(spark, vectors)) >= 0.9 * sum(links)


def test_what_links_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [2.0, 0.0], [2.0, 0.0], [0.0, 0.0], None, [], [nan, 1.0], [inf, 1.0], [1.0, None], [1.0], [-1.0, 0.0], [-0.0, 5.0]]
    got = run(spark, vectors)
    links, comps = brute(vectors)
    assert [(g[1], g[2]) for g in got] == list(zip(links, comps, strict=True))
    assert [g[3] for g in got] == [i == c for i, c in enumerate(comps)]
    assert got[0][1] == 3 and got[9][2] == 0  # a shorter vector is completed with zeros


def test_copies_count_and_ids_may_repeat_or_be_null(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -2.0, 1.0]
    df = spark.createDataFrame([(5, v), (5, v), (6, v), (7, w), (None, v)], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, itq.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 0, 7, True), (None, 0, None, False)], key=str)


def test_each_pair_meets_once(spark):
    """Codes within two bits in some piece meet at exactly one entry, others at none."""
    base = 0x1234_5678_9ABC_DEF0
    others = [base ^ x for x in (0, 1, 3, 7 | 7 << 16, 7 | 7 << 16 | 7 << 32 | 3 << 48, 0x0007_0007_0007_0007)]
    codes = spark.createDataFrame([(i, c) for i, c in enumerate([base, *others])], "rep long, code long")
    a, b = itq.entries(codes).alias("a"), itq.entries(codes).alias("b")
    from pyspark.sql import functions as F

    c = F.col
    met = a.join(b, (c("a.slot") == c("b.slot")) & (c("a.rep") == 0) & (c("b.rep") > 0))
    met = met.where(itq.found_here(c("a.code"), c("b.code"), c("a.slot"), c("a.flip"), c("b.flip")))
    assert {r["rep"]: r["count"] for r in met.groupBy("b.rep").count().collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}


def test_empty_table(spark):
    assert itq.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
