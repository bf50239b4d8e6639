"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another. The model of a category sees which marked terms a text
has and the (logit of the) probabilities of the categories before it; in training those come from
models that have not seen the text (out-of-fold), in use from the final ones. Terms are words and
word beginnings of 4 to 6 characters, so that inflected and joined forms are caught; the most telling
ones on the training texts make the vocabulary.

Training takes a bounded sample of labelled rows, ``MAX_LABELLED``: those whose ids hash lowest. Its
size is a parameter and does not grow with the data. Counts of terms are aggregated before they
leave the tasks; what reaches the driver is the vocabulary and, per sampled text, the numbers of the
terms it has. Every text is scored whole, in one pass over the data without a shuffle.

Labels name one category, "toxic"; "strong" and "severe" are toxic texts with at least the median,
and at least the 90th percentile, of marked terms per word among toxic training texts. Without
toxic labels nothing is found toxic. Null, empty and wordless texts have no terms and are not toxic
unless most training texts are. Repeated rows are scored alike. Labels that are null or that differ
between rows of one id count as toxic if any says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.bpe import blocks
from tidebook.llm.common import append_columns, settle, ship

CATEGORIES = ("toxic", "strong", "severe")
#: Bounds of training: labelled rows, terms, folds.
MAX_LABELLED, MAX_TERMS, FOLDS = 20_000, 400, 5
#: Least log odds times toxic texts of a term: three texts and no other one reach it.
LEAST_WEIGHT = 10.0
PREFIXES = (4, 5, 6)
RIDGE = 1.0
WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def terms(text: str) -> set[str]:
    """Words of ``text`` in lower case, and their beginnings marked by a caret."""
    words = set(WORD.findall(text.lower()))
    out = set(words)
    for size in PREFIXES:
        out.update("^" + w[:size] for w in words if len(w) >= size)
    return out


class Matcher:
    """Finds a vocabulary's terms in texts: words by set intersection, beginnings by a table per length."""

    def __init__(self, vocabulary: list[str]):
        self.whole = {t: i for i, t in enumerate(vocabulary) if not t.startswith("^")}
        self.begins = {size: {t[1:]: i for i, t in enumerate(vocabulary) if t.startswith("^") and len(t) == size + 1} for size in PREFIXES}

    def __call__(self, text: str) -> list[int]:
        words = set(WORD.findall(text.lower()))
        found = {self.whole[w] for w in words & self.whole.keys()}
        for size, table in self.begins.items():
            if table:
                found.update(table[b] for b in {w[:size] for w in words} & table.keys())
        return sorted(found)


def sample(docs: DataFrame, labels: DataFrame, key: str, most: int) -> DataFrame:
    """The labelled texts to train on: (key, text, toxic)."""
    marked = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"))
    chosen = marked.orderBy(F.xxhash64(key), key).limit(most)
    return docs.select(key, "text").join(F.broadcast(chosen), key)  # ``most`` ids


def vocabulary_of(train: DataFrame, most: int) -> list[str]:
    """The ``most`` terms whose share of toxic texts stands out most (log odds times texts)."""
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("toxic", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found = list(terms(text or ""))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(np.full(len(found), toxic, np.int32))], names=["term", "toxic"])

    total, n_toxic = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < total:
        return []
    counts = train.select("text", "toxic").mapInArrow(run, schema).groupBy("term").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("t") / n_toxic) / ((F.col("n") - F.col("t") + 0.5) / (total - n_toxic)))
    ranked = counts.where("t > 0").select("term", (F.col("t") * odds).alias("weight"))
    ranked = ranked.where(F.col("weight") >= LEAST_WEIGHT).orderBy(F.desc("weight"), "term").limit(most)
    return [r["term"] for r in ranked.collect()]


@dataclass
class Chain:
    """Vocabulary, and for each category weights (bias, terms, earlier logits) and a threshold."""

    vocabulary: list[str]
    categories: list[str]
    weights: list[np.ndarray]
    thresholds: list[float]

    def probabilities(self, found: list[list[int]]) -> np.ndarray:
        n = len(self.vocabulary)
        out = np.zeros((len(found), len(self.categories)))
        logits: list[np.ndarray] = []
        for j, w in enumerate(self.weights):
            sums = np.fromiter((w[1 : n + 1][x].sum() if x else 0.0 for x in found), float, len(found))
            logit = w[0] + sums + sum((w[n + 1 + k] * z for k, z in enumerate(logits)), np.zeros(len(found)))
            logits.append(np.clip(logit, -30, 30))
            out[:, j] = 1 / (1 + np.exp(-logits[-1]))
        return out


def logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression on rows that count ``times``, by Newton's method."""
    x = np.column_stack([np.ones(len(y)), x])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    penalty[0] = 1e-3
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (times * (y - p)) - penalty * w
        hessian = (x.T * (times * p * (1 - p))) @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def best_threshold(p: np.ndarray, y: np.ndarray, times: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the best F0.5 (a clean text rejected weighs
    more than a toxic one kept) on out-of-fold probabilities."""
    if not y.any():
        return 1.1
    cuts, place = np.unique(p, return_inverse=True)
    all_at, true_at = np.bincount(place, times), np.bincount(place, times * y)
    flagged, true = all_at[::-1].cumsum()[::-1], true_at[::-1].cumsum()[::-1]  # at or above each cut
    score = 1.25 * true / (flagged + 0.25 * true_at.sum())
    below = np.r_[0.0, cuts[:-1]]
    best = np.flatnonzero(score >= score.max() - 1e-12)
    widest = best[int(np.argmax((cuts - below)[best]))]
    return float((cuts[widest] + below[widest]) / 2)


def fit(found: list[list[int]], n_words: np.ndarray, fold: np.ndarray, toxic: np.ndarray, vocabulary: list[str]) -> Chain:
    n, m = len(toxic), len(vocabulary)
    if not m or not toxic.any():
        prior = (toxic.sum() + 0.5) / (n + 1.5)
        weights = [np.r_[np.log(prior / (1 - prior)), np.zeros(m + j)] for j in range(len(CATEGORIES))]
        return Chain(vocabulary, list(CATEGORIES), weights, [0.5] * len(CATEGORIES))
    density = np.fromiter(map(len, found), float, n) / np.maximum(n_words, 1)
    cuts = np.quantile(density[toxic == 1], [0.5, 0.9])
    labels = np.column_stack([toxic, toxic * (density >= cuts[0]), toxic * (density >= cuts[1])])
    # Texts with the same terms, fold and labels are one row that counts more.
    alike: dict[tuple, int] = {}
    for row in zip(map(tuple, found), fold.tolist(), map(tuple, labels.tolist()), strict=True):
        alike[row] = alike.get(row, 0) + 1
    times = np.array(list(alike.values()), float)
    fold, labels = np.array([k[1] for k in alike]), np.array([k[2] for k in alike])
    x = np.zeros((len(alike), m))
    for i, (terms_of, _, _) in enumerate(alike):
        x[i, list(terms_of)] = 1
    weights, thresholds = [], []
    for y in labels.T:
        held_out = np.zeros(len(y))
        for k in range(FOLDS):
            inside = fold != k
            if inside.any() and not inside.all():
                w = logistic(x[inside], y[inside], times[inside])
                held_out[~inside] = np.clip(w[0] + x[~inside] @ w[1:], -30, 30)
        weights.append(logistic(x, y, times))
        thresholds.append(best_threshold(1 / (1 + np.exp(-held_out)), y, times))
        x = np.column_stack([x, held_out])
    return Chain(vocabulary, list(CATEGORIES), weights, thresholds)


def index_terms(df: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``df`` with ``found``, the numbers of the vocabulary's terms in ``text``, and ``n_words``."""
    match = Matcher(vocabulary)

    def run(batch: pa.RecordBatch):
        texts = batch.column(0)
        for start, rows in blocks(pa.compute.binary_length(texts).fill_null(0).to_pylist(), 4_000_000):
            part = [t or "" for t in texts.slice(start, rows).to_pylist()]
            found = [match(t) for t in part]
            yield start, rows, [pa.array(found, pa.list_(pa.int32())), pa.array([len(t.split()) for t in part], pa.int64())]

    return append_columns(df, ["text"], [("found", T.ArrayType(T.IntegerType())), ("n_words", T.LongType())], run)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", most: int = MAX_LABELLED, most_terms: int = MAX_TERMS) -> Chain:
    """Fit the chain on ``docs`` (key, text) with ``labels`` (key, toxic)."""
    ship(docs.sparkSession)
    chosen = settle(sample(docs, labels, key, most), "labelled")
    vocabulary = vocabulary_of(chosen, most_terms)
    known = index_terms(chosen, vocabulary).select(key, "toxic", "found", "n_words", F.pmod(F.xxhash64(key), F.lit(FOLDS)).alias("fold"))
    rows = sorted(known.collect(), key=lambda r: (r[key], r["n_words"], r["found"]))
    as_array = lambda name: np.array([r[name] for r in rows], float)
    return fit([list(r["found"]) for r in rows], as_array("n_words"), as_array("fold"), as_array("toxic"), vocabulary)


def score(df: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``df`` with p_toxic, p_strong, p_severe, and ``toxic``: whether the first category is reached.
    Input columns of these names are replaced."""
    ship(df.sparkSession)
    fields = [*((f"p_{c}", T.DoubleType()) for c in chain.categories), ("toxic", T.BooleanType())]
    match = Matcher(chain.vocabulary)

    def run(batch: pa.RecordBatch):
        texts = batch.column(0)
        for start, rows in blocks(pa.compute.binary_length(texts).fill_null(0).to_pylist(), 4_000_000):
            p = chain.probabilities([match(t or "") for t in texts.slice(start, rows).to_pylist()])
            yield start, rows, [*(pa.array(p[:, j]) for j in range(p.shape[1])), pa.array(p[:, 0] >= chain.thresholds[0])]

    return append_columns(df, [text], fields, run)
