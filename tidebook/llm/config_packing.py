"""Packing into as few fixed windows as possible by a configuration linear program.

Only the histogram of piece lengths matters for how windows are filled, and it has at most one row
per length whatever the corpus weighs. A configuration is a set of lengths that fits a window. The
linear program asks for the fewest windows whose configurations cover the histogram:

* every length carries a price, at first its share of a window, multiplied down exponentially as the
  length gets covered (multiplicative weights);
* a knapsack dynamic program over window positions finds what a window is worth at these prices, and
  the dearest configuration that the histogram can supply is taken as often as its scarcest length
  allows in a step; prices over the worth of a window are a dual solution, which bounds the optimum;
* the fractional solution is rounded down, most used configurations first, as far as pieces last; what
  is left is packed best-fit, longest first, group by group.

Spark tokenises, cuts and counts. A piece's number among those of its length (its number in its task
plus those in earlier tasks) then names its window and place by lookup in the plan: pieces of one
length are interchangeable, so a length that a third of all pieces share needs no single task.

Null or empty texts are the end id alone. Equal rows are packed one by one, null keys kept, other
columns dropped; a key named like an output column is refused. Texts longer than a window are cut
into full windows of their own and a remainder. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.common import settle, ship

WINDOW = 2048
#: Knapsacks solved at most, configurations taken between two (fewer where there are few lengths), how
#: strongly a covered length loses price, share of the scarcest length taken, gap at which to stop.
PRICINGS, REFRESH, DECAY, TAKE, GAP = 256, 32, 8.0, 0.5, 0.01

#: A filling of a window: (length, times), longest first.
Config = tuple[tuple[int, int], ...]


@dataclass
class Solution:
    """Fractional uses of configurations, the windows they come to, and a lower bound of any packing."""

    uses: dict[Config, float]
    windows: float
    bound: float


def knapsack(price: np.ndarray) -> np.ndarray:
    """What room r is worth at best, for r = 0 .. window; ``price[l]`` is that of a piece of length l."""
    size = len(price) - 1
    turned = np.zeros(size + 1)  # turned[size - r] is the worth of room r
    for r in range(1, size + 1):
        turned[size - r] = max(turned[size - r + 1], (turned[size - r + 1 :] + price[1 : r + 1]).max())
    return turned[::-1].copy()


def dearest(price: np.ndarray, worth: np.ndarray, supply: np.ndarray) -> Config:
    """The configuration of highest price by ``worth``, no length more often than there are pieces."""
    room, used = len(price) - 1, Counter()
    while room:
        value = price[1 : room + 1] + worth[room - 1 :: -1] if room > 1 else price[1:2] + worth[:1]
        value = np.where(price[1 : room + 1] > 0, value, -1.0)
        for length, times in used.items():
            if length <= room and times >= supply[length]:
                value[length - 1] = -1.0
        length = int(value.argmax()) + 1
        if value[length - 1] < 0:
            break
        used[length] += 1
        room -= length
    return tuple(sorted(used.items(), reverse=True))


def solve(counts: np.ndarray, pricings: int = PRICINGS) -> Solution:
    """Multiplicative weights on the covering program of ``counts`` (pieces by length)."""
    lengths = np.arange(len(counts))
    wanted = np.nonzero(counts)[0]
    covered = np.zeros(len(counts))
    uses: dict[Config, float] = {}
    total, bound, best = 0.0, 0.0, np.inf
    refresh = min(max(len(wanted) // 16, 1), REFRESH)
    for step in range(pricings * refresh + 1):
        if step % refresh == 0:
            least = covered[wanted].min()
            price = np.where(counts > 0, lengths * np.maximum(np.exp(-DECAY * (covered - least)), 1e-9), 0.0)
            worth = knapsack(price)
            bound = max(bound, float((counts * price).sum() / worth[-1]))
            best = total / least if least > 0 else np.inf
            if best <= (1 + GAP) * bound or step == pricings * refresh:
                break
        config = dearest(price, worth, counts)
        amount = TAKE * min(counts[length] / times for length, times in config)
        uses[config] = uses.get(config, 0.0) + amount
        total += amount
        for length, times in config:
            covered[length] += amount * times / counts[length]
            price[length] = length * max(np.exp(-DECAY * (covered[length] - least)), 1e-9)
    scale = max(1.0, float(covered[wanted].min()))
    return Solution({c: u / scale for c, u in uses.items()}, best, bound)


def best_fit(counts: np.ndarray) -> list[tuple[Config, int]]:
    """Best-fit decreasing on a histogram: windows of equal content are one group."""
    size = len(counts) - 1
    rooms: list[int] = []
    groups: dict[int, list[tuple[Config, int]]] = {}
    done: list[tuple[Config, int]] = []

    def put(config: Config, copies: int, room: int) -> None:
        if room == 0:
            done.append((config, copies))
            return
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append((config, copies))

    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                config, copies = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, config, copies = size, (), left
            times = min(room // length, left)
            filled = min(copies, left // times)
            put((*config, (length, times)), filled, room - times * length)
            if copies > filled and config:
                put(config, copies - filled, room)
            left -= filled * times
    return done + [group for same in groups.values() for group in same]


def filling(counts: np.ndarray, pricings: int = PRICINGS) -> tuple[list[tuple[Config, int]], Solution]:
    """Whole windows that hold every piece of ``counts`` once: configurations and their copies."""
    left, plan = counts.astype(np.int64).copy(), []
    if not left.any():
        return plan, Solution({}, 0.0, 0.0)
    solution = solve(counts, pricings)
    for config, uses in sorted(solution.uses.items(), key=lambda u: (-u[1], u[0])):
        copies = min(int(uses), *(int(left[length]) // times for length, times in config))
        if copies:
            plan.append((config, copies))
            for length, times in config:
                left[length] -= copies * times
    return plan + best_fit(left), solution


def places(plan: list[tuple[Config, int]]) -> dict[str, np.ndarray]:
    """For each length, runs of numbered pieces: the first number, pieces a window, first window, offset."""
    rows, taken, window = [], Counter(), 0
    for config, copies in plan:
        offset = 0
        for length, times in config:
            rows.append((length, taken[length], times, window, offset))
            taken[length] += copies * times
            offset += length * times
        window += copies
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 48) + table[:, 1], "first": table[:, 1], "times": table[:, 2], "window": table[:, 3], "offset": table[:, 4]}


def pack(df: DataFrame, key: str, text: str, path: str | None = None, window: int = WINDOW, end_id: int = 0, with_ids: bool = True, pricings: int = PRICINGS) -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids (null unless ``with_ids``), ids_crc32,
    sequence_id, offset. Ids are those of the word-end tokenizers file ``path``, then ``end_id``."""
    import public_tokenizers

    spark = df.sparkSession
    ship(spark)
    path = path or public_tokenizers.path("word_bpe_49k.json")
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.ArrayType(T.IntegerType())), ("ids_crc32", T.LongType())]
    if key in {n for n, _ in fields} | {"sequence_id", "offset"}:
        raise ValueError(f"the key has the name of an output column: {key}")
    df = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([df.schema[0], *(T.StructField(n, t) for n, t in [*fields, ("_task", T.IntegerType()), ("_number", T.LongType())])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidebook.llm.word_ids import encoder

        encode, end, task = encoder(path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        numbers: Counter = Counter()  # one per length
        for batch in batches:
            ready, weight = [], 0

            def flush() -> pa.RecordBatch:
                owners, *columns = zip(*ready, strict=True)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int64()]
                arrays = [batch.column(0).take(pa.array(owners, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
                ready.clear()
                return pa.RecordBatch.from_arrays(arrays, names=schema.names)

            for row, value in enumerate(batch.column(1)):
                data = encode(value.as_py() or "") + end
                for piece, at in enumerate(range(0, len(data), 4 * window)):
                    part = data[at : at + 4 * window]
                    length = len(part) // 4
                    ids = np.frombuffer(part, "<i4") if with_ids else None
                    ready.append((row, piece, at // 4, length, ids, zlib.crc32(part), task, numbers[length]))
                    numbers[length] += 1
                    weight += length if with_ids else 32
                if weight > 1_000_000:
                    weight = 0
                    yield flush()
            if ready:
                yield flush()

    pieces = settle(df.mapInArrow(cut, schema), "pieces")
    held = pieces.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("n"))
    held = settle(held.where(F.col("length") < window), "lengths")
    counts = np.zeros(window + 1, np.int64)
    for length, n in held.groupBy("length").agg(F.sum("n")).collect():  # a row per length
        counts[length] = n
    plan = spark.sparkContext.broadcast(places(filling(counts, pricings)[0]))
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("_task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    out = ["_key", *(n for n, _ in fields)]
    # A full window needs no plan; it is told by its task and number, below zero.
    alone = -1 - F.shiftleft(F.col("_task").cast("long"), 33) - F.col("_number")
    full = pieces.where(F.col("length") == window).select(*out, alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    numbered = pieces.where(F.col("length") < window).join(before, ["_task", "length"])
    numbered = numbered.select(*out, (F.col("_number") + F.col("_before")).alias("_number"))
    placed = T.StructType([*numbered.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = plan.value
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("_number").to_numpy()
            run = np.searchsorted(by["key"], (length << 48) + number, "right") - 1
            turn, among = np.divmod(number - by["first"][run], by["times"][run])
            new = [pa.array(by["window"][run] + turn), pa.array(by["offset"][run] + among * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=placed.names)

    both = full.unionByName(numbered.mapInArrow(place, placed))
    return both.withColumnRenamed("_key", key)
