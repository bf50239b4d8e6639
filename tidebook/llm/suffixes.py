"""Suffix-array removal of repeated byte strings.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else. Sorting every
suffix of the corpus is not needed: each such string contains an *anchor*, the leftmost smallest of
its ``GRAM``-byte hashes, and equal strings have it at the same place. So

1. the anchors of all texts are found, each with the run of strings it is the anchor of (its
   *context*), about one per 85 bytes;
2. anchors whose leading gram occurs once are done. A context that occurs twice repeats as a whole;
3. where contexts of one gram differ, one of each takes part in the sort: the suffixes at the
   anchors are range-partitioned by their leading bytes with sampled splitters, sorted in each
   bucket by multikey quicksort (eight bytes at a time, only ties go on), and so are the reversed
   texts before the anchors. Neighbours' common prefixes then tell, for every offset, which strings
   are equal: those in the same run of suffixes with the rest of the string in common and the same
   run of reversed texts with its beginning in common. Here bytes decide; in 2 and 4, hashes;
4. equal leading bytes stay in one bucket, so no comparison crosses a boundary unless a gram has
   more contexts than a task's fair share. Such a bucket's strings are compared across all tasks
   by grouping their 128-bit fingerprints.

A context's first and last bytes can only be covered by its own strings or by a neighbour's, so
the union of what is found is exact. A null text is empty; texts below ``length`` lose nothing;
every copy of a repeated string loses it; matches never cross texts, but count within one. Rows
that repeat id and text are distinct occurrences and share a result. Very long texts are cut
into overlapping blocks. Other columns are carried along; one named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.bpe import blocks
from tidebook.llm.common import settle, settle_with, ship

LENGTH, GRAM = 200, 32
#: Bytes hashed at once (positions take 18 bits of a key), and bytes of text a worker holds of a batch.
BLOCK, HELD_BYTES = 1 << 18, 1 << 20
#: Contexts sorted at once, and bounds of a task's fair share of one gram's.
SORTED, SHARE_LEAST, SHARE_MOST = 30_000, 2_000, 100_000

ANCHOR = [("pos", T.LongType()), ("lo", T.LongType()), ("hi", T.LongType()), ("gram", T.LongType()), ("context", T.LongType())]
KEYS = ["id", "text_hash"]


def byte_values() -> np.ndarray:
    """A fixed 64-bit value per byte, by the SplitMix64 rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = byte_values()


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each position, by doubling."""
    h, n, factor = BYTE_VALUES[data], 1, 0x9E3779B97F4A7C15
    while n < size:
        h = h[:-n] * np.uint64(factor) + h[n:]
        h ^= h >> np.uint64(29)
        n, factor = 2 * n, factor * factor % (1 << 64)
    return h


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    n, low = 1, x
    while 2 * n <= width:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    return low if n == width else np.minimum(low[: len(low) - (width - n)], low[width - n :])


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, position, first and last string start, gram hash) of every anchor in texts laid end to end.

    ``data`` has at most ``BLOCK`` bytes; ``ends`` are the texts' ends in it."""
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    grams = gram_hashes(data, GRAM)
    low = np.uint64(BLOCK - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    at = (window_minima(keys, length - GRAM + 1) & low).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(at)]
    start = np.flatnonzero(np.arange(len(at)) + length <= ends[text])
    at, text = at[start], text[start]
    if not len(at):
        return at, at, at, at, np.empty(0, np.uint64)
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:], len(at)] - 1
    return text[first], at[first], start[first], start[last], grams[at[first]]


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of at most ``BLOCK`` bytes: (row, offset in its text, bytes). A longer text is
    cut into blocks that overlap by all but one byte of a string."""
    rows, offsets, parts, total = [], [], [], 0
    step = BLOCK - length + 1
    for row, text in enumerate(texts):
        if len(text) < length:
            continue
        for at in range(0, max(len(text) - length + 1, 1), step):
            part = text[at : at + BLOCK]
            if total + len(part) > BLOCK:
                yield rows, offsets, parts
                rows, offsets, parts, total = [], [], [], 0
            rows.append(row)
            offsets.append(at)
            parts.append(part)
            total += len(part)
    if parts:
        yield rows, offsets, parts


def portions(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``HELD_BYTES`` bytes of ``column``; a longer text is alone.

    A worker keeps what it once took, and an executor keeps a worker for every function of a task."""
    for start, rows in blocks(pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), HELD_BYTES):
        yield batch.slice(start, rows)


def find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """``KEYS`` and ``ANCHOR`` for every anchor of ``docs`` (id, text_hash, body)."""
    schema = T.StructType([docs.schema["id"], docs.schema["text_hash"], *(T.StructField(n, t) for n, t in ANCHOR)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest

        for batch in (part for whole in batches for part in portions(whole, "body")):
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("body").cast(pa.binary())]
            for rows, offsets, parts in pieces(texts, length):
                data = b"".join(parts)
                ends = np.cumsum([len(p) for p in parts])
                text, at, lo, hi, gram = anchors(np.frombuffer(data, np.uint8), ends, length)
                spans = zip(lo.tolist(), (hi + length).tolist(), (at - lo).tolist(), strict=True)
                context = np.array([digest(data[a:b], seed) for a, b, seed in spans], np.uint64)
                shift = np.asarray(offsets)[text] - (ends - [len(p) for p in parts])[text]
                take = pa.array(np.asarray(rows)[text])
                new = [pa.array(at + shift), pa.array(lo + shift), pa.array(hi + shift), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("text_hash").take(take), *new], names=schema.names)

    return docs.mapInArrow(run, schema)


def suffix_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words`` (big-endian 8-byte words as integers) and, for each place in
    it, the bytes it has in common with the row before. Multikey quicksort: rows tied in all words
    so far are split by the next one; the others are done."""
    n, depth = words.shape
    order, common = np.arange(n), np.zeros(n, np.int64)
    place, part = np.arange(n), np.zeros(n, np.int64)  # places still tied, and with whom
    for k in range(depth):
        word = words[order[place], k]
        by = np.lexsort((word, part))
        word = word[by]
        order[place] = order[place][by]
        joined = part[1:] == part[:-1]
        differ = word[1:] ^ word[:-1]
        lead = np.zeros(len(differ), np.int64)
        for bits in range(8, 64, 8):
            lead += differ < np.uint64(1 << (64 - bits))
        lead += differ == 0
        common[place[1:][joined]] = (8 * k + lead)[joined]
        tied = joined & (differ == 0)
        member = np.r_[tied, False] | np.r_[False, tied]
        if not member.any():
            break
        part = np.cumsum(np.r_[True, ~tied])[member]
        place = place[member]
    return order, common


def padded(rows: list[bytes], width: int) -> np.ndarray:
    """Rows as big-endian words, filled up with zero bytes to ``width`` (a multiple of eight)."""
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), ">u8").reshape(len(rows), width // 8).astype(np.uint64)


def repeated_strings(before: list[bytes], after: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first and last offset before the anchor) of runs of strings that another row has too.

    ``before`` is the reversed text before each anchor, ``after`` the text from it, both as far as
    the row's own strings reach. The string at offset a takes a bytes of one and the rest of the other."""
    n = len(after)
    width = -(-length // 8) * 8
    order_after, common_after = suffix_sort(padded(after, width))
    order_before, common_before = suffix_sort(padded(before, width))
    most = np.fromiter(map(len, before), np.int64, n)
    least = length - np.fromiter(map(len, after), np.int64, n)
    top = int(most.max()) if n else -1
    found = np.zeros((top + 3, n), bool)  # a row of False on either side
    run_after, run_before = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(int(least.min()) if n else 0, top + 1):
        run_after[order_after] = np.cumsum(common_after < length - a)
        run_before[order_before] = np.cumsum(common_before < a)
        rows = np.flatnonzero((least <= a) & (a <= most))
        pair = run_after[rows] * (n + 1) + run_before[rows]
        by = np.argsort(pair, kind="stable")
        equal = np.diff(pair[by]) == 0
        found[a + 1, rows[by]] = np.r_[equal, False] | np.r_[False, equal]
    change = np.diff(found.T.astype(np.int8), axis=1)
    row, first = np.nonzero(change == 1)
    _, after_last = np.nonzero(change == -1)
    return row, first, after_last - 1


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text compressed: two joins carry it."""
    schema = T.StructType([*(f for f in docs.schema if f.name != "body"), T.StructField("packed", T.BinaryType())])
    keep = [f.name for f in docs.schema if f.name != "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in portions(whole, "body")):
            data = [press.compress(t.as_buffer() if t.is_valid else b"") for t in batch.column("body").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(data, pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


CONTEXT = [("pos", T.LongType()), ("single", T.BooleanType()), ("gram", T.LongType()), ("before", T.BinaryType()), ("after", T.BinaryType())]


def cut_contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes around the ``wanted`` anchors (KEYS, pos, lo, hi, gram, single)."""
    lists = wanted.groupBy(*KEYS).agg(F.collect_list(F.struct("pos", "lo", "hi", "gram", "single")).alias("wanted"))
    d, w = packed(docs.select(*KEYS, "body")).alias("d"), lists.alias("w")
    same = F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    both = d.join(w, same).select("d.id", "d.text_hash", "d.packed", "w.wanted")
    schema = T.StructType([both.schema["id"], both.schema["text_hash"], *(T.StructField(n, t) for n, t in CONTEXT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                text = unpack.decompress(batch.column("packed")[i].as_py())
                spans = batch.column("wanted")[i].values
                pos, lo, hi, gram, single = (spans.field(n) for n in ("pos", "lo", "hi", "gram", "single"))
                cuts = list(zip(pos.to_pylist(), lo.to_pylist(), hi.to_pylist(), strict=True))
                take = pa.array(np.full(len(cuts), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("text_hash").take(take),
                        pos,
                        single,
                        gram,
                        pa.array([text[b:a][::-1] for a, b, _ in cuts], pa.binary()),
                        pa.array([text[a : c + length] for a, _, c in cuts], pa.binary()),
                    ],
                    names=schema.names,
                )

    return both.mapInArrow(run, schema)


def compare_in_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """(KEYS, start, end) of repeated runs, by sorting each bucket of ``contexts``."""
    leading = F.substring("after", 1, GRAM)
    ordered = contexts.withColumn("leading", leading).repartitionByRange("leading").sortWithinPartitions("leading")
    schema = T.StructType([contexts.schema["id"], contexts.schema["text_hash"], T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def compared(table: pa.Table) -> pa.RecordBatch:
        row, first, last = repeated_strings(table["before"].to_pylist(), table["after"].to_pylist(), length)
        single = table["single"].to_numpy()[row]
        row, first, last = row[single], first[single], last[single]
        pos, take = table["pos"].to_numpy()[row], pa.array(row)
        ids = [table[n].take(take).combine_chunks() for n in KEYS]
        return pa.RecordBatch.from_arrays([*ids, pa.array(pos - last), pa.array(pos - first + length)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < SORTED:
                continue
            # Equal leading bytes stay together: keep back the rows of the last ones.
            table = pa.Table.from_batches(held)
            leading = table["leading"].to_pylist()
            cut = len(leading)
            while cut and leading[cut - 1] == leading[-1]:
                cut -= 1
            if cut:
                yield compared(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, schema)


def compare_across(contexts: DataFrame, length: int) -> DataFrame:
    """(KEYS, start, end) of repeated strings, by grouping the fingerprint of every string."""
    fields = [("gram", T.LongType()), ("start", T.LongType()), ("string", T.BinaryType()), ("single", T.BooleanType())]
    schema = T.StructType([contexts.schema["id"], contexts.schema["text_hash"], *(T.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest as digest

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, starts, strings = [], [], []
                for i, (pos, before, after) in enumerate(zip(*(part.column(n).to_pylist() for n in ("pos", "before", "after")), strict=True)):
                    text = before[::-1] + after
                    for k in range(len(text) - length + 1):
                        rows.append(i)
                        starts.append(pos - len(before) + k)
                        strings.append(digest(text[k : k + length]))
                take = pa.array(rows, pa.int64())
                new = [part.column("gram").take(take), pa.array(starts, pa.int64()), pa.array(strings, pa.binary()), part.column("single").take(take)]
                yield pa.RecordBatch.from_arrays([part.column("id").take(take), part.column("text_hash").take(take), *new], names=schema.names)

    strings = contexts.mapInArrow(run, schema)
    often = strings.groupBy("gram", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    found = strings.where("single").join(often, ["gram", "string"], "left_semi")
    return found.select(*KEYS, "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(KEYS, start, end): spans that cover exactly the bytes to remove; they may overlap."""
    spark = docs.sparkSession
    found = find_anchors(docs, length)
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("several"))
    grams = settle(grams.where("n > 1").drop("n"), "grams")
    repeated = settle(found.join(grams, "gram"), "repeated-anchors")

    one = F.struct(*KEYS, "pos", "lo", "hi")
    contexts = repeated.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one"), F.first("several").alias("several"))
    contexts = settle(contexts, "contexts")
    whole = repeated.join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    whole = whole.select(*KEYS, F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))

    wanted = contexts.where("several").select("one.*", "gram", (F.col("n") == 1).alias("single"))
    sizes, seen = settle_with(wanted.groupBy("gram").agg(F.count(F.lit(1)).alias("size")), "sizes", total=F.sum("size"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(max((seen["total"] or 0) // tasks, SHARE_LEAST), SHARE_MOST)
    large = sizes.where(F.col("size") > share).select("gram", F.lit(True).alias("large"))
    wanted = wanted.join(large, "gram", "left")
    cut = cut_contexts(docs, wanted.where("large is null"), length)
    parts = [whole, compare_in_buckets(cut, length)]
    parts.append(compare_across(cut_contexts(docs, wanted.where("large"), length), length))
    return reduce(DataFrame.unionByName, parts)


REMOVED = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.BinaryType())]


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with n_bytes, n_removed, n_spans and ``kept``, the bytes that stay (binary: a cut may
    fall inside a character)."""
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    ship(df.sparkSession)
    names = [n for n, _ in REMOVED]
    body = F.coalesce(F.col(text), F.lit("")).alias("body")
    docs = df.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), body)
    spans = settle(repeated_spans(docs, length), "spans")
    # Spans of a context and its neighbours overlap; a text's list is as long as its anchors at most, and is cut down here.
    lists = spans.groupBy(*KEYS).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    others = [c for c in df.columns if c not in names and c != text]  # what is left of the text is ``kept``
    mark = {c: f"_{i}" for i, c in enumerate(others)}
    rows = df.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), body, *(F.col(f"`{c}`").alias(mark[c]) for c in others))
    both = packed(rows).alias("r").join(lists.alias("l"), F.col("r.id").eqNullSafe(F.col("l.id")) & (F.col("r.text_hash") == F.col("l.text_hash")), "left")
    both = both.select(*(F.col(f"r.{m}").alias(m) for m in mark.values()), "r.packed", "l.spans")
    schema = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in others), *(T.StructField(n, t) for n, t in REMOVED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out, held = [], 0
            for i, (packed_text, spans) in enumerate(zip(batch.column("packed"), batch.column("spans"), strict=True), 1):
                data = unpack.decompress(packed_text.as_py())
                held += len(data)
                if not spans.is_valid:
                    out.append((len(data), 0, 0, data))
                else:
                    start, end = (spans.values.field(n).to_numpy() for n in ("start", "end"))
                    reach = np.maximum.accumulate(end)
                    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
                    starts, ends = start[first].tolist(), reach[np.r_[first[1:] - 1, len(reach) - 1]].tolist()
                    kept = b"".join(data[a:b] for a, b in zip([0, *ends], [*starts, len(data)], strict=True))
                    out.append((len(data), len(data) - len(kept), len(starts), kept))
                if held >= HELD_BYTES or i == batch.num_rows:
                    columns = zip(*out, strict=True)
                    new = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.binary()], strict=True)]
                    done = batch.slice(i - len(out), len(out))
                    yield pa.RecordBatch.from_arrays([*(done.column(m) for m in mark.values()), *new], names=schema.names)
                    out, held = [], 0

    return both.mapInArrow(run, schema)
