"""Bounded-space online packing of tokenised documents into fixed windows.

Each task keeps a fixed number of open windows. A document's ids are cut into full windows, which
are closed at once, and one remainder, which goes to the open window it fits best (least room
left). If it fits none, the fullest open window is closed and a new one opened. What is still open
at a task's end is merged with other tasks' leftovers, many tasks' at a time, in rounds, by the
same rule until one group of tasks is left; only whole open windows move then, so a leftover costs one row.

The first pass is written to the shared folder before windows are merged: a rerun task cannot deal
its documents to other windows than a later step has read. A null or empty text is a document of
the end id alone. Equal documents are packed one by one. Every id lies in exactly one piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.common import settle, ship

#: Ids a window holds, windows open per task, tasks whose leftovers are merged together.
WINDOW, OPEN_WINDOWS, MERGED_TASKS = 1024, 64, 64
#: A window's id: the task that opened it, then its number there.
TASK_SHIFT = 33

PIECES = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("open", T.BooleanType()),
]


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """A function text -> ids by the tokenizers file ``path``, as the library gives them without added special tokens.

    A file whose ranks are given beside it (same name, .tiktoken) is encoded by tiktoken: equal ids
    at a third of the time. What tiktoken cannot take (very long runs without a break) goes to tokenizers,
    and so does a text that holds the string of an added token, which the library gives its own id.
    """
    import base64
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    by_plain = lambda text: plain.encode(text, add_special_tokens=False).ids
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        return by_plain
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray | list[int]:
        if any(token in text for token in added):
            return by_plain(text)
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except Exception:
            return by_plain(text)
        except BaseException as fault:  # a panic of the native code is no Exception
            if type(fault).__name__ != "PanicException":
                raise
            return by_plain(text)

    return encode


class OpenWindows:
    """A fixed number of open windows, kept in order of the room they have left."""

    def __init__(self, task: int, size: int, most: int):
        self.size, self.most, self.next = size, most, task << TASK_SHIFT
        self.room: list[tuple[int, int]] = []  # (room, window), ascending
        self.closed: list[int] = []

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int, window: int | None = None) -> tuple[int, int]:
        """(window, offset) for ``length`` ids; ``window`` names the window to open if one must be."""
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            room, found = self.room.pop(at)
        else:
            if len(self.room) == self.most:
                self.closed.append(self.room.pop(0)[1])
            room, found = self.size, self.new() if window is None else window
        if room > length:
            insort(self.room, (room - length, found))
        else:
            self.closed.append(found)
        return found, self.size - room


def pack(df: DataFrame, key: str, text: str, path: str | None = None, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``key``, start, length, ids (null unless ``with_ids``), ids_crc32,
    doc_tokens, sequence_id, offset."""
    import public_tokenizers

    spark = df.sparkSession
    ship(spark)
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    df = df.select(F.col(key).alias(key), F.col(text).alias("_text"))
    schema = T.StructType([df.schema[0], *PIECES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        windows = OpenWindows(TaskContext.get().partitionId(), window, open_windows)
        waiting: dict[int, list[tuple]] = {}  # pieces of windows still open
        ready: list[tuple] = []
        weight = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            lists = [None if x is None else np.frombuffer(x, np.int32) for x in columns[3]]
            arrays = [pa.array(c, t) for c, t in zip(columns, [kind, pa.int64(), pa.int64(), None, *[pa.int64()] * 4, pa.bool_()], strict=True) if t]
            arrays.insert(3, pa.array(lists, pa.list_(pa.int32())))
            ready.clear()
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                total, data = len(ids), ids.tobytes()
                for start in range(0, total, window):
                    length = min(window, total - start)
                    part = data[4 * start : 4 * (start + length)]
                    found, offset = (windows.new(), 0) if length == window else windows.place(length)
                    row = (doc, start, length, part if with_ids else None, zlib.crc32(part), total, found, offset, False)
                    if length == window:
                        ready.append(row)
                    else:
                        waiting.setdefault(found, []).append(row)
                    weight += length if with_ids else 32
                for closed in windows.closed:
                    ready.extend(waiting.pop(closed))
                windows.closed.clear()
                if weight > 1_000_000 and ready:
                    weight = 0
                    yield flush()
        for rows in waiting.values():
            ready.extend((*row[:-1], True) for row in rows)
        if ready:
            yield flush()

    pieces = settle(df.mapInArrow(run, schema), "pieces")
    return merged(pieces, window, open_windows)


def merged(pieces: DataFrame, window: int, open_windows: int) -> DataFrame:
    """``pieces`` with open windows put together across tasks."""
    left = pieces.where("open").groupBy("sequence_id").agg(F.sum("length").alias("length"))
    left = left.select("sequence_id", "length", F.col("sequence_id").alias("target"), F.lit(0).cast("long").alias("shift"), F.lit(True).alias("open"))
    left = left.withColumn("part", F.shiftright("sequence_id", TASK_SHIFT))
    schema = left.schema

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        """Places whole groups (windows merged so far, by target) best-fit, largest first."""
        windows = OpenWindows(0, window, open_windows)
        sizes = rows.groupby("target")["length"].sum().reset_index().sort_values(["length", "target"], ascending=[False, True])
        place = {t: windows.place(int(n), int(t)) for t, n in sizes.itertuples(index=False)}
        still = {w for _, w in windows.room}
        rows["shift"] += rows["target"].map({t: o for t, (_, o) in place.items()})
        rows["target"] = rows["target"].map({t: w for t, (w, _) in place.items()})
        rows["open"] = rows["target"].isin(still)
        return rows

    # Only what is still open goes on; each round leaves at most `open_windows` per group of tasks.
    done = []
    left = settle(left, "leftovers")
    tasks = left.agg(F.max("part")).first()[0]
    while tasks is not None:
        left = left.withColumn("part", F.floor(F.col("part") / MERGED_TASKS))
        left = settle(left.groupBy("part").applyInPandas(together, schema), "leftovers")
        done.append(left.where("not open"))
        if tasks == 0 or (tasks := tasks // MERGED_TASKS) == 0:
            done.append(left.where("open"))
            break
        left = left.where("open")
    out = [c for c in pieces.columns if c != "open"]
    closed = pieces.where("not open").select(out)
    if not done:
        return closed
    moves = done[0]
    for more in done[1:]:
        moves = moves.unionByName(more)
    moves = moves.select("sequence_id", "target", "shift")
    moved = pieces.where("open").join(moves, "sequence_id").withColumns({"sequence_id": F.col("target"), "offset": F.col("offset") + F.col("shift")})
    return closed.unionByName(moved.select(out))
