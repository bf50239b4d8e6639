"""Importance resampling towards a target: hashed word runs counted by an Aho-Corasick dictionary.

A block of texts gets a dictionary of its distinct words, each bounded by a delimiter on either side
and carrying its CRC-32 and length as payload. The automaton scans every text and emits payloads in
order; those of adjacent words are composed into the CRC of their run (shift the left CRC over the
right length, add the right CRC), so that no run of words is ever put together or hashed as a string.
A run's CRC modulo ``buckets`` is its feature.

Texts are read once and kept as bucket numbers, two bytes a feature. A bucket's gain is the logarithm
of its smoothed share in the target over that in the corpus; a row's weight is the sum of its features'
gains, and a draw without replacement takes the highest weights after adding Gumbel noise that is a
function of the key. Only the ``buckets`` counts reach the driver and every task.

Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A null text has no
words. A word over ``LONGEST`` bytes is not entered in a dictionary; a text that holds one is taken
word by word, with the same payloads. Repeated rows are drawn one by one, by equal scores; a null key's
noise is that of an empty one and it ranks before others of its score. Other columns are dropped; a key named
like an output column is refused. Without target or rows every gain or result is empty, never an error.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.common import settle_with, ship
from tidebook.operators.ranking import Ordering, prefix_sum

#: Bytes of text that share a dictionary, bytes of the longest word in one, rows a task ranks.
BLOCK, LONGEST, RANKED = 8 << 20, 256, 1 << 15
#: Bytes as they count: A-Z lower-cased, everything that is not of a word a space.
LETTERS = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))
OUTPUTS = ("n_words", "n_features", "weight", "score", "rank")


@lru_cache(maxsize=1)
def crc_steps() -> np.ndarray:
    """What a zero byte does to the lowest byte of a CRC-32."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


def composed(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of strings from those of their left and right parts, the right ones ``lengths`` bytes long."""
    order = np.argsort(-lengths, kind="stable")
    crc, sizes = left[order], lengths[order]
    longer = len(sizes)
    for done in range(int(sizes[0]) if longer else 0):
        while sizes[longer - 1] <= done:
            longer -= 1
        part = crc[:longer]
        crc[:longer] = (part >> np.uint32(8)) ^ crc_steps()[part & np.uint32(255)]
    out = np.empty_like(crc)
    out[order] = crc
    return out ^ right


def payload(word: bytes) -> int:
    return len(word) << 32 | zlib.crc32(word)


def scanned(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The payloads of every text's words, in order."""
    import ahocorasick

    words: set[bytes] = set()
    plain = []
    for text in texts:
        found = text.split()
        long = any(len(w) > LONGEST for w in found)
        plain.append(found if long else None)
        if not long:
            words.update(found)
    # The automaton's integers have 32 bits: they number the payloads.
    payloads = np.fromiter(map(payload, words), np.int64, len(words))
    dictionary = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, word in enumerate(words):
        dictionary.add_word(f" {word.decode('latin-1')} ", i)
    if words:
        dictionary.make_automaton()
    emitted = itemgetter(1)
    for text, found in zip(texts, plain, strict=True):
        if found is not None:
            yield np.fromiter(map(payload, found), np.int64)
        elif words:
            yield payloads[np.fromiter(map(emitted, dictionary.iter(f" {text.decode('latin-1')} ")), np.int64)]
        else:
            yield np.empty(0, np.int64)


def runs(payloads: np.ndarray, most: int) -> np.ndarray:
    """CRCs of all runs of 1 to ``most`` adjacent words, joined by a space."""
    crc, lengths = (payloads & 0xFFFFFFFF).astype(np.uint32), payloads >> 32
    out, run = [crc], crc
    space = np.uint32(zlib.crc32(b" "))
    for n in range(1, most):
        run, right = run[: len(crc) - n], crc[n:]
        if not len(right):
            break
        spaced = composed(run, np.full(len(run), space), np.ones(len(run), np.int64))
        run = composed(spaced, right, lengths[n:])
        out.append(run)
    return np.concatenate(out)


def blocks(texts: pa.Array) -> Iterator[list[bytes]]:
    block, size = [], 0
    for value in texts:
        block.append((value.as_py() or "").encode().translate(LETTERS))
        size += len(block[-1])
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def features(df: DataFrame, text: str, most: int, buckets: int) -> DataFrame:
    """``text`` replaced by n_words, n_features and the features' buckets as packed integers."""
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != text]
    fields = [("n_words", T.LongType()), ("n_features", T.LongType()), ("_buckets", T.BinaryType())]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(n, t) for n, t in fields)])
    wide = packed_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for block in blocks(batch.column(text)):
                rows = []
                for payloads in scanned(block):
                    found = runs(payloads, most) % np.uint32(buckets)
                    rows.append((len(payloads), len(found), found.astype(wide).tobytes()))
                old = batch.select(keep).slice(start, len(rows))
                start += len(rows)
                new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays([*old.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)


def packed_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def counted(df: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in :func:`features`; a row per bucket reaches the driver."""
    wide = packed_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), wide), minlength=buckets)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in df.select("_buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed source share) of each bucket."""
    buckets = len(source)
    of_target = [float(t + 1) * float(source.sum() + buckets) for t in target]
    of_source = [float(s + 1) * float(target.sum() + buckets) for s in source]
    return np.array([math.floor(1000 * math.log(t / s)) for t, s in zip(of_target, of_source, strict=True)], np.int64)


def weighed(df: DataFrame, gain: np.ndarray) -> DataFrame:
    """:func:`features` with the summed gains of each row as weight."""
    keep = [c for c in df.columns if c != "_buckets"]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("weight", T.LongType())])
    wide, sent = packed_type(len(gain)), df.sparkSession.sparkContext.broadcast(gain)  # ``buckets`` integers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [int(sent.value[np.frombuffer(v.as_buffer(), wide)].sum()) for v in batch.column("_buckets")]
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, pa.array(new, pa.int64())], names=schema.names)

    return df.mapInArrow(run, schema)


def noise(key: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of sha256(seed:key)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    df: DataFrame,
    key: str,
    text: str,
    target: DataFrame,
    target_text: str,
    percent: int = 10,
    most: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: str = "2024",
) -> DataFrame:
    """``key``, n_words, n_features, weight, score and rank of every row of ``df``.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred are drawn (rounded down);
    rank counts them from the highest score, equal scores by key, and is null for others.
    """
    if key in OUTPUTS:
        raise ValueError(f"the key has the name of an output column: {key}")
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    able = F.col("n_words") >= least_words
    kept, seen = settle_with(features(rows, "_text", most, buckets), "features", n=F.count_if(able))
    aims = features(target.select(F.col(f"`{target_text}`").alias("_text")), "_text", most, buckets)
    gain = gains(counted(kept, buckets), counted(aims, buckets))
    scored = weighed(kept, gain).withColumn("score", F.col("weight") + noise(F.col("_key"), seed))
    n = seen["n"]
    order = Ordering("score", "_key", descending=True)
    ranked = prefix_sum(scored.where(able), None, order, n, rank_name="rank", rows_per_range=RANKED)
    drawn = F.col("rank").cast("long") <= F.lit(percent * n // 100)
    ranked = ranked.withColumn("rank", F.when(drawn, F.col("rank").cast("long")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("_key").alias(key), *OUTPUTS)
