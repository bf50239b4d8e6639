"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

On a bounded sample a rotation of the principal components is learned that makes the signs of the
rotated values close to the values: binary codes, one bit per component, balanced and nearly
independent. Every vector gets such a code of ``BITS`` bits. The code is cut into ``TABLES`` pieces;
two codes within ``RADIUS`` bits agree in some piece but for two bits, so that a piece with at most
one bit flipped on either side is equal. An equality join on pieces finds such pairs, each at one
place, and checks the codes' distance; what is left is reranked by the cosine of the original
vectors, in double precision.

A rotation separates some pairs at the limit, more of them where it has not seen the vectors. Each
vector therefore has a second code of an independent projection, and pairs that are near in either
code are reranked. The index holds every vector; only the projections come from the sample. Recall is a matter of how
many bits a pair's codes differ in: see the README for measurements against brute force. Equal
vectors are one row in the index, whatever their number, and count in full as links.

A vector that is null, zero or empty, or holds null or non-finite components, links with nothing, as
does a row without an id. Shorter vectors are completed with zeros. Rows that repeat an id are kept
apart in the result and count as vectors.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm.common import append_columns, components, settle, ship

BITS, TABLES, FLIPS = 64, 4, 2
RADIUS = (FLIPS + 1) * TABLES - 1
#: Codes of a vector, each by a rotation of its own.
CODES = 2
#: Vectors the rotation is learned on, and steps of learning.
SAMPLE, STEPS = 20_000, 50
#: Stands for "no bit flipped".
NONE = BITS // TABLES


class Codes:
    """Centre and projection; the code of x is the signs of (x - centre) @ projection. Other seeds
    than zero start from directions of their own instead of the principal components."""

    def __init__(self, vectors: np.ndarray, bits: int = BITS, steps: int = STEPS, seed: int = 0):
        n, dims = vectors.shape
        self.dims = dims
        self.centre = vectors.mean(axis=0) if n else np.zeros(dims)
        inner = vectors - self.centre
        _, basis = np.linalg.eigh(inner.T @ inner + 1e-9 * np.eye(dims))
        basis = basis[:, ::-1][:, :bits]
        if seed and dims > bits:
            basis = np.linalg.qr(np.random.default_rng(seed + 1000).normal(size=(dims, bits)))[0]
        lift = np.zeros((dims, bits))
        lift[:, : basis.shape[1]] = basis
        values = inner @ lift
        rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
        for _ in range(steps if n else 0):
            signs = np.where(values @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(values.T @ signs)
            rotation = left @ right
        self.projection = lift @ rotation

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.centre) @ self.projection >= 0
        return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def with_codes(vectors: DataFrame, dims: int, codes: list[Codes]) -> DataFrame:
    """``vectors`` (rep, unit array<double>) with ``code0``, ``code1``, ... one of each of ``codes``."""

    def run(batch: pa.RecordBatch):
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        yield 0, batch.num_rows, [pa.array(c(x), pa.int64()) for c in codes]

    return append_columns(vectors, ["unit"], [(f"code{i}", T.LongType()) for i in range(len(codes))], run)


def piece(code: Column, table: int) -> Column:
    size = BITS // TABLES
    return F.shiftright(code, table * size).bitwiseAND(F.lit((1 << size) - 1))


def entries(coded: DataFrame) -> DataFrame:
    """A row per vector, piece and flipped bit (or none): ``slot``, what the piece reads then, ``flip``."""
    variants = F.array(
        *(
            F.struct((F.lit(t << NONE) + piece(F.col("code"), t).bitwiseXOR(F.lit((1 << i) % (1 << NONE)))).alias("slot"), F.lit(i).alias("flip"))
            for t in range(TABLES)
            for i in range(NONE + 1)
        )
    )
    return coded.select("*", F.inline(variants))


def found_here(a: Column, b: Column, slot: Column, a_flip: Column, b_flip: Column) -> Column:
    """One of the places a pair meets at: the first piece within two bits, the lower of the bits
    that differ flipped on the left, the other (or none) on the right."""
    here, earlier = F.lit(False), F.lit(False)
    for t in range(TABLES):
        close = F.bit_count(piece(a, t).bitwiseXOR(piece(b, t))) <= FLIPS
        here = here | ((F.shiftright(slot, NONE) == t) & ~earlier & close)
        earlier = earlier | close
    return here & ((a_flip < b_flip) | ((a_flip == NONE) & (b_flip == NONE)))


def near_in(coded: DataFrame, i: int, radius: int) -> DataFrame:
    """(a, b) of vectors near in their ``i``-th code and in none before it."""
    earlier = [f"code{k}" for k in range(i)]
    slots = entries(coded.select("rep", F.col(f"code{i}").alias("code"), *earlier))
    a, b = slots.alias("a"), slots.alias("b")
    x, y = F.col("a.code"), F.col("b.code")
    new = reduce(lambda c, k: c & (F.bit_count(F.col(f"a.{k}").bitwiseXOR(F.col(f"b.{k}"))) > radius), earlier, F.lit(True))
    return a.join(
        b,
        (F.col("a.slot") == F.col("b.slot"))
        & (F.col("a.rep") < F.col("b.rep"))
        & (F.bit_count(x.bitwiseXOR(y)) <= radius)
        & new
        & found_here(x, y, F.col("a.slot"), F.col("a.flip"), F.col("b.flip")),
    ).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"))


def linked_pairs(vectors: DataFrame, dims: int, codes: list[Codes], cosine: float, radius: int) -> DataFrame:
    """(a, b) of representatives, a < b, with a cosine of ``cosine`` or more."""
    coded = settle(with_codes(vectors, dims, codes), "codes")
    near = reduce(DataFrame.unionByName, (near_in(coded, i, radius) for i in range(len(codes))))
    near = settle(near, "near-codes")
    left = coded.select(F.col("rep").alias("a"), F.col("unit").alias("u"), F.col("norm").alias("un"))
    right = coded.select(F.col("rep").alias("b"), F.col("unit").alias("v"), F.col("norm").alias("vn"))
    both = near.join(left, "a").join(right, "b")
    dot = F.aggregate(F.zip_with("u", "v", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return settle(both.where(dot / (F.col("un") * F.col("vn")) >= cosine).select("a", "b"), "links")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, radius: int = RADIUS, sample: int = SAMPLE) -> DataFrame:
    """``key``, n_links (other vectors with a cosine of ``cosine`` or more), component_id (smallest
    ``key`` reachable), kept (the key is the component's)."""
    ship(df.sparkSession)
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    good = rows.where(usable(F.col("x")) & F.col("id").isNotNull())
    dims = good.agg(F.max(F.size("x"))).first()[0] or 1
    # Zeros complete short vectors; minus zero is zero.
    whole = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.get("x", i), F.lit(0.0)) + 0.0)
    good = settle(good.select("id", whole.alias("x")), "usable-vectors")
    distinct = good.groupBy("x").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    distinct = settle(distinct.select("rep", "copies", F.col("x").alias("unit"), norm.alias("norm")), "vectors")

    n, parts = distinct.count(), 1 << 20
    share = min(1.0, sample / max(n, 1))
    chosen = distinct.where(F.pmod(F.xxhash64("rep"), F.lit(parts)) < int(parts * share)).select("rep", "unit", "norm")
    learned = sorted((r["rep"], [v / r["norm"] for v in r["unit"]]) for r in chosen.collect())
    seen = np.array([v for _, v in learned], float).reshape(-1, dims)
    codes = [Codes(seen, seed=seed) for seed in range(CODES)]

    # Codes are of unit vectors; a representative may stand for several rows with its id.
    scaled = distinct.select("rep", F.transform("unit", lambda v: v / F.col("norm")).alias("unit"), F.lit(1.0).alias("norm"))
    links = linked_pairs(scaled, dims, codes, cosine, radius)
    copies = distinct.select(F.col("rep").alias("b"), "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    comps = components(links, "vector-components").withColumnRenamed("node", "a")
    known = distinct.select(F.col("rep").alias("a"), "copies", F.col("unit").alias("x"))
    known = known.join(others, "a", "left").join(comps, "a", "left")
    known = known.select(
        "x",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "a").alias("component_id"),
    )
    judged = good.join(settle(known, "known-vectors"), "x").select("id", "n_links", "component_id")
    bad = rows.where(~usable(F.col("x")) | F.col("id").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = judged.unionByName(bad)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
