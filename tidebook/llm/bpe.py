"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded on its own. A segment tree over its byte positions
keeps the smallest (rank, position) of all mergeable neighbours at its root, so the leftmost
pair of lowest rank is read off in one step; a merge changes three leaves (the pair itself, the
right part that ends, the left neighbour) and repairs their paths to the root. Pieces whose
trees have the same size are merged side by side as rows of one array.

Texts that are null count as empty: no ids. Empty texts give no ids. Bytes without a vocabulary
entry cannot occur (all 256 are in the vocabulary). Long texts are split into matches block by
block. Repeated texts and pieces are looked up in a bounded cache. An input column named like an
output column is replaced.
"""

from __future__ import annotations

import base64
import sys
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidebook.llm.common import append_columns, ship

#: Pieces kept encoded per Python worker; the cache starts anew when it is full.
CACHED_PIECES = 500_000
#: Matches handled at once, and characters of text per output batch.
BLOCK_PIECES, BLOCK_CHARS = 200_000, 1_500_000
#: Tree cells merged side by side, and the size from which a piece is merged alone.
ROW_CELLS, LONG_PIECE = 32_768, 256


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Vocabulary:
    """Ranks of a byte-level BPE, as lookup tables. A token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        width, ranks = len(self.tokens), self.ranks
        merges = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    merges[left * width + right] = rank
        keys = np.array(sorted(merges), np.int64)
        self.width = width
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.values = np.append(np.array([merges[k] for k in keys.tolist()], np.int64), -1)
        self.joined = merges
        self.cache: dict[str, bytes] = {}  # ids as 32-bit integers

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that ``left`` and ``right`` join to; -1 where there is none."""
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def merge(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids of pieces of at most ``size`` bytes, a power of two, by segment trees of that size.

        Row i of every array belongs to piece i; arrays are flat, so that one index reaches a cell.
        """
        n, wide = len(pieces), size + 1
        none = np.int64(self.width * size)
        length = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        live = np.arange(size) < length[:, None]
        grid = np.zeros((n, wide), np.int64)
        grid[:, :size][live] = self.byte_ids[flat]
        rank = self.pair_ranks(grid[:, : size - 1], grid[:, 1:size])
        tree = np.full((n, 2 * size), none)
        tree[:, size : 2 * size - 1] = np.where((rank >= 0) & live[:, 1:], rank * size + np.arange(size - 1), none)
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        # Neighbours by position; `size` stands for "none" on either side.
        after = np.tile(np.arange(1, wide + 1), (n, 1))
        after[np.arange(n), length - 1] = size
        before = np.tile(np.arange(-1, size), (n, 1))
        before[:, 0] = size
        kept = np.zeros((n, wide), bool)
        kept[:, :size] = live
        rows = np.flatnonzero(tree[:, 1] < none)
        token, tree, after, before, alive = (x.reshape(-1) for x in (grid, tree, after, before, kept))

        def pair_key(base: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            rank = self.pair_ranks(token[base + left], token[base + right])
            return np.where((rank >= 0) & (left < size) & (right < size), rank * size + left, none)

        while rows.size:
            root, base = rows * (2 * size), rows * wide
            best = tree[root + 1]
            left = best % size
            right = after[base + left]
            token[base + left] = best // size
            beyond, back = after[base + right], before[base + left]
            after[base + left] = beyond
            before[base + beyond] = left
            alive[base + right] = False
            tree[root + size + right] = none
            tree[root + size + left] = pair_key(base, left, beyond)
            has = back < size
            tree[(root + size + back)[has]] = pair_key(base, back, left)[has]
            tops = np.concatenate([root, root, root[has]])
            node = (np.concatenate([right, left, back[has]]) + size) >> 1
            for _ in range(size.bit_length() - 1):
                child = tops + 2 * node
                tree[tops + node] = np.minimum(tree[child], tree[child + 1])
                node >>= 1
            rows = rows[tree[root + 1] < none]
        kept = kept[:, :size]
        ids, ends = grid[:, :size][kept].astype(np.int32).tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_long(self, piece: bytes) -> bytes:
        """Ids of one long piece: the same tree in plain lists, where arrays of one row would not pay."""
        n, width, joined = len(piece), self.width, self.joined
        size = 1 << (n - 1).bit_length()
        none = width * size
        token = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        key = lambda i, j: none if j >= n or (r := joined.get(token[i] * width + token[j])) is None else r * size + i
        tree = [none] * (2 * size)
        tree[size : size + n] = [key(i, i + 1) for i in range(n)]
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before, live = list(range(1, n + 1)), list(range(-1, n)), bytearray(b"\1") * n

        def put(leaf: int, value: int) -> None:
            node = leaf + size
            tree[node] = value
            while node > 1:
                value = min(value, tree[node ^ 1])
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value

        while (best := tree[1]) < none:
            left = best % size
            right = after[left]
            token[left], live[right] = best // size, 0
            after[left] = beyond = after[right]
            before[beyond] = left
            put(right, none)
            put(left, key(left, beyond))
            if (back := before[left]) >= 0:
                put(back, key(back, left))
        return np.array([t for t, alive in zip(token, live, strict=True) if alive], np.int32).tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode ``pieces`` into the cache."""
        cache, ranks, by_size = self.cache, self.ranks, {}
        for piece in pieces:
            data = piece.encode()
            whole = ranks.get(data)
            if whole is not None:
                cache[piece] = whole.to_bytes(4, sys.byteorder)
            else:
                by_size.setdefault(1 << (len(data) - 1).bit_length(), []).append((piece, data))
        for size, group in by_size.items():
            if size >= LONG_PIECE:
                cache.update((p, self.merge_long(d)) for p, d in group)
                continue
            step = max(1, ROW_CELLS // size)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                cache.update(zip([p for p, _ in part], self.merge([d for _, d in part], size), strict=True))

    def ids_of(self, pieces: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.cache.__getitem__, pieces)), np.int32)

    def know(self, pieces: set[str]) -> None:
        """Have ``pieces`` in the cache."""
        fresh = pieces.difference(self.cache)
        if len(self.cache) + len(fresh) > CACHED_PIECES:
            self.cache.clear()
            fresh = pieces
        self.learn(fresh)

    def encode(self, texts: list[str], pattern) -> list[np.ndarray]:
        """Ids of each text. Short texts are split together, a long one is split block by block."""
        if len(texts) == 1 and len(texts[0]) > BLOCK_CHARS:
            found, parts = (m.group() for m in pattern.finditer(texts[0])), []
            while pieces := list(islice(found, BLOCK_PIECES)):
                self.know(set(pieces))
                parts.append(self.ids_of(pieces))
            return [np.concatenate(parts)]
        pieces = [pattern.findall(t) for t in texts]
        self.know(set().union(*pieces))
        return [self.ids_of(p) for p in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def blocks(sizes: list[int], most: int):
    """(start, rows) of runs of rows that weigh at most ``most`` together; a heavier row is alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i - start
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes) - start


def list_array(values: list[np.ndarray], kind=pa.int32()) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with ``out`` array<int>: the ids of the whole ``text``, no special tokens."""
    import public_tokenizers

    ship(df.sparkSession)
    path, pattern = path or default_vocabulary(), pattern or public_tokenizers.PATTERN

    def run(batch: pa.RecordBatch):
        vocab, split = vocabulary(path), compiled(pattern)
        texts = [t or "" for t in batch.column(0).to_pylist()]
        for start, rows in blocks([len(t) for t in texts], BLOCK_CHARS):
            yield start, rows, [list_array(vocab.encode(texts[start : start + rows], split))]

    return append_columns(df, [text], [(out, T.ArrayType(T.IntegerType()))], run)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with ``out`` binary: the bytes that ``ids`` stand for (null: empty)."""
    ship(df.sparkSession)
    path = path or default_vocabulary()

    def run(batch: pa.RecordBatch):
        vocab = vocabulary(path)
        column = batch.column(0)
        flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).cumsum()
        starts = [0, *ends[:-1].tolist()]
        for start, rows in blocks(np.diff(ends, prepend=0).tolist(), BLOCK_CHARS):
            part = [vocab.decode(flat[a:b]) for a, b in zip(starts[start : start + rows], ends[start : start + rows].tolist(), strict=True)]
            yield start, rows, [pa.array(part, pa.binary())]

    return append_columns(df, [ids], [(out, T.BinaryType())], run)
