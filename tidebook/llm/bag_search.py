"""Ranked lexical search of a query set over all documents, by classes of equal bags of words.

Documents are restricted to the words the items ask for. Two documents with the same restricted
counts and the same length norm get the same score from every item, so they form a class: equal
hashes bring them together, equal vectors and norms confirm it (grouping compares the bytes). Each
class is scored once against all items; every task keeps the best ``top`` classes of an item, and
the classes that win are expanded to their members in order of the key. A document outside the best
``top`` classes of an item has ``top`` documents before it, so the result is exact.

Items are taken in blocks of about ``ITEMS`` items and ``TERMS`` words, each block in a pass over the
documents; what a block sends to the driver and to tasks (its words, their weights) is bounded by these.

A term is a run of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Null or empty
texts hold no term and are never found; an item without a term finds nothing. Rows that repeat a key are
documents of their own; null keys rank after others of equal score. Other columns are dropped. Keys may
have any orderable type and any name, the outputs' names (rank, score) excepted, and differ by name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.common import settle, ship

#: About so many items, and words of them, in a block; (word, item) pairs a task adds up at once.
ITEMS, TERMS, PAIRS = 4096, 500_000, 1 << 19
#: Bytes as they count: A-Z lower-cased, everything that is not of a term a space.
LETTERS = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(_item, key, terms): every item with its distinct terms, numbered."""
    ship(items.sparkSession)
    rows = items.select(F.monotonically_increasing_id().alias("_item"), F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.binary()))], names=schema.names)

    return settle(rows.mapInArrow(run, schema).where("size(terms) > 0"), "items")


def wide(known: int) -> str:
    """The type of a term's number."""
    return "<u2" if known <= 1 << 16 else "<u4"


def packed(bag: dict[int, int], kind: str) -> bytes:
    """The numbers of a bag's terms, ascending, and their counts, after the bytes a count takes."""
    held = sorted(bag)
    counts = [bag[i] for i in held]
    most = max(counts)
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([size]) + np.array(held, kind).tobytes() + np.array(counts, f"<u{size}").tobytes()


def unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers and counts of a batch of vectors, one after the other, and how many each has."""
    each = np.dtype(kind).itemsize
    numbers, counts = [], []
    for value in column:
        data = value.as_buffer()
        size = data[0]
        n = (data.size - 1) // (each + size)
        numbers.append(np.frombuffer(data, kind, n, 1))
        counts.append(np.frombuffer(data, f"<u{size}", n, 1 + each * n).astype(np.int64))
    return np.concatenate(numbers).astype(np.int64), np.concatenate(counts), np.array([len(c) for c in counts])


def vectors(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(_key, n, vec): number of terms, and the :func:`packed` bag of the known ones, null if there is none."""
    schema = T.StructType([docs.schema[0], T.StructField("n", T.LongType()), T.StructField("vec", T.BinaryType())])
    sent, kind = docs.sparkSession.sparkContext.broadcast(vocabulary), wide(len(vocabulary))  # of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(sent.value)}.get
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                bag = Counter(map(number, words))
                bag.pop(None, None)
                sizes.append(len(words))
                found.append(packed(bag, kind) if bag else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def document_counts(classes: DataFrame, known: int) -> np.ndarray:
    """How many documents hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(known, np.int64)
        for batch in batches:
            if batch.num_rows:
                numbers, _, sizes = unpacked(batch.column(0), wide(known))
                np.add.at(total, numbers, np.repeat(batch.column(1).to_numpy(), sizes))
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "df"])

    out = np.zeros(known, np.int64)
    counts = classes.select("vec", "members").mapInArrow(run, "term long, df long")
    for term, df in counts.groupBy("term").agg(F.sum("df")).collect():  # a row per term of the block
        out[term] = df
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Scorer:
    """Scores batches of classes against the items of a block and keeps the best of each item."""

    def __init__(self, weight: np.ndarray, first: np.ndarray, items: np.ndarray, count: int, top: int):
        self.weight, self.first, self.items, self.count, self.top = weight, first, items, count, top
        self.degree = np.diff(first)
        # Sums are exact in doubles as long as an item's best possible score is.
        longest = int(np.bincount(items, minlength=1).max()) if len(items) else 0
        self.in_doubles = longest * int(weight.max(initial=0)) * 10**6 < 1 << 53
        self.least = np.zeros(count, np.int64)
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * count

    def add(self, classes: np.ndarray, norms: np.ndarray, numbers: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> None:
        """Classes in order of their first member, so that of equal scores the earlier one stays."""
        ends = np.cumsum(sizes)
        pairs = np.concatenate([[0], np.cumsum(self.degree[numbers])])[ends]
        start = 0
        while start < len(sizes):
            done = pairs[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(pairs, done + PAIRS, "right")))
            part = slice(ends[start - 1] if start else 0, ends[stop - 1])
            self.add_some(classes[start:stop], norms[start:stop], numbers[part], tf[part], sizes[start:stop])
            start = stop

    def add_some(self, classes: np.ndarray, norms: np.ndarray, numbers: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> None:
        gain = self.weight[numbers] * ((10**9 * tf) // (1000 * tf + 8 * np.repeat(norms, sizes)))
        degree = self.degree[numbers]
        ends = np.cumsum(degree)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[numbers] - (ends - degree), degree)
        cell = np.repeat(np.repeat(np.arange(len(sizes)), sizes), degree) * self.count + self.items[at]
        if self.in_doubles:
            scores = np.bincount(cell, np.repeat(gain, degree), len(sizes) * self.count).astype(np.int64)
        else:
            scores = np.zeros(len(sizes) * self.count, np.int64)
            np.add.at(scores, cell, np.repeat(gain, degree))
        scores = scores.reshape(len(sizes), self.count)
        better = scores > self.least
        for item in np.nonzero(better.any(axis=0))[0]:
            rows = np.nonzero(better[:, item])[0]
            score = np.concatenate([self.best[item][0], scores[rows, item]])
            owner = np.concatenate([self.best[item][1], classes[rows]])
            order = np.argsort(-score, kind="stable")[: self.top]
            self.best[item] = score[order], owner[order]
            if len(order) == self.top:
                self.least[item] = score[order[-1]]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(score) for score, _ in self.best]
        return np.repeat(np.arange(self.count), sizes), *(np.concatenate([b[i] for b in self.best]) for i in (0, 1))


def best_classes(classes: DataFrame, weight: np.ndarray, block: list[list[int]], top: int) -> DataFrame:
    """(item, score, class): the best ``top`` classes of every task for every item of the block."""
    order = np.array([(t, i) for i, held in enumerate(block) for t in held], np.int64).reshape(-1, 2)
    order = order[np.argsort(order[:, 0], kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(order[:, 0], minlength=len(weight)))])
    sent, kind = classes.sparkSession.sparkContext.broadcast((weight, first, order[:, 1].copy(), len(block), top)), wide(len(weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            if batch.num_rows:
                scorer.add(batch.column(0).to_numpy(), batch.column(1).to_numpy(), *unpacked(batch.column(2), kind))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in scorer.found()], names=["item", "score", "class"])

    in_order = classes.sortWithinPartitions(F.col("first").asc_nulls_last(), "class").select("class", "m", "vec")
    return in_order.mapInArrow(run, "item long, score long, class long")


def search_block(spark: SparkSession, docs: DataFrame, block: list, known: tuple[int, int] | None, top: int) -> tuple[DataFrame, tuple[int, int]]:
    """(_item, _key, rank, score) for the items of one block; documents with a term, and their terms."""
    vocabulary = sorted({t for row in block for t in row["terms"]})
    vocabulary = [bytes(t) for t in vocabulary]
    number = {t: i for i, t in enumerate(vocabulary)}
    found = vectors(docs, vocabulary)
    if known is None:
        seen = Observation()
        found = found.observe(seen, F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L"))
    found = settle(found.where("vec IS NOT NULL"), "vectors")
    total, length = known or (seen.get["N"], seen.get["L"])
    found = found.withColumn("m", F.expr(f"10L + (90L * n * {total}L) div {max(length, 1)}L")).withColumn("hash", F.xxhash64("m", "vec"))
    same = ["hash", "m", "vec"]
    classes = found.groupBy(*same).agg(F.count(F.lit(1)).alias("members"), F.min("_key").alias("first"))
    classes = settle(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    weight = weights(document_counts(classes, len(vocabulary)), total)
    scored = best_classes(classes, weight, [[number[bytes(t)] for t in row["terms"]] for row in block], top)
    # At most `top` classes an item are left from here on.
    leading = Window.partitionBy("item").orderBy(F.desc("score"), F.col("first").asc_nulls_last(), "class")
    firsts = settle(scored, "scored").join(classes.select("class", "first"), "class")
    chosen = settle(firsts.withColumn("_place", F.row_number().over(leading)).where(F.col("_place") <= top).drop("_place", "first"), "chosen")
    wanted = F.broadcast(chosen.select("class").distinct())  # at most `top` a block's item
    kinds = settle(classes.join(wanted, "class").select("class", *same), "kinds")
    among = Window.partitionBy(*same).orderBy(F.col("_key").asc_nulls_last())
    members = found.join(F.broadcast(kinds.select("hash").distinct()), "hash", "left_semi").select("_key", *same)
    members = members.withColumn("_turn", F.row_number().over(among)).where(F.col("_turn") <= top)
    members = members.join(kinds, same).select("class", "_key")
    ranking = Window.partitionBy("item").orderBy(F.desc("score"), F.col("_key").asc_nulls_last())
    out = chosen.join(members, "class").withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, row["_item"]) for i, row in enumerate(block)], "item long, _item long")
    return out.join(F.broadcast(names), "item").select("_item", "_key", "rank", "score"), (total, length)


def search(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, top: int = 10) -> DataFrame:
    """``item_key``, rank (from 1), ``key``, score: each item's ``top`` best documents of score above 0."""
    if key == item_key or {key, item_key} & {"rank", "score"}:
        raise ValueError(f"keys must differ from each other and from rank and score: {key}, {item_key}")
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    asked = item_terms(items, item_key, item_text)
    sizes = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(1, math.ceil(sizes[0] / ITEMS), math.ceil(sizes[1] / TERMS))
    out, known = [], None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == b).select("_item", "terms").collect()  # about ITEMS, TERMS
        if block:
            found, known = search_block(spark, docs, block, known, top)
            out.append(settle(found, "found"))
    none = T.StructType([T.StructField("_item", T.LongType()), docs.schema[0], T.StructField("rank", T.IntegerType()), T.StructField("score", T.LongType())])
    found = reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], none)
    named = asked.select("_item", F.col("_key").alias("_asked"))
    return found.join(named, "_item").select(F.col("_asked").alias(item_key), "rank", F.col("_key").alias(key), "score")
