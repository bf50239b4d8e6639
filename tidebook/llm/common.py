"""What the operators share: reading tables, shipping code, Arrow column maps, unions by link."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.session import scratch_path

#: Words, as every operator here means them: runs without ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tidebook_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tidebook-code-")
    sc.addPyFile(shutil.make_archive(f"{folder}/tidebook", "zip", package.parent, package.name))
    sc._tidebook_shipped = True


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_with(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`settle`, with aggregates over the rows taken while writing."""
    seen = Observation()
    out = settle(df.observe(seen, *(c.alias(k) for k, c in metrics.items())), label)
    return out, seen.get


def append_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[tuple[str, T.DataType]],
    fn: Callable[[pa.RecordBatch], Iterator[tuple[int, int, list[pa.Array]]]],
) -> DataFrame:
    """``df`` with columns computed by ``fn`` in Arrow batches.

    ``fn`` gets a batch with ``inputs`` and yields (first row, rows, new columns) pieces in order,
    so that large outputs leave in small batches. Columns of ``df`` named like a new one are replaced.
    """
    names = [n for n, _ in fields]
    if missing := [c for c in inputs if c in names]:
        raise ValueError(f"an input cannot also be an output: {missing}")
    keep = [c for c in df.columns if c not in names]
    df = df.select(*(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows, new in fn(batch.select(inputs)):
                old = batch.slice(start, rows)
                yield pa.RecordBatch.from_arrays([*old.columns, *new], names=[*keep, *names])

    return df.mapInArrow(run, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): component is the smallest node reachable.

    Alternates large-star and small-star contraction until nothing changes: each round replaces
    links by links to the smallest neighbour, so a hub never gathers its neighbours in one task and
    a chain halves its length. Links are distinct pairs; the number of rows never grows.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges, seen = settle_with(edges, label, n=F.count(F.lit(1)), h=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    while True:
        before = (seen["n"], seen["h"])
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        large = settle(large.distinct(), label)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(b.alias("a"), F.col("m").alias("b")).where(a != b).unionByName(low.select("a", F.col("m").alias("b")))
        edges, seen = settle_with(small.distinct(), label, n=F.count(F.lit(1)), h=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        if (seen["n"], seen["h"]) == before:
            break
    roots = edges.select(b.alias("node"), b.alias("component")).distinct()
    return edges.select(a.alias("node"), b.alias("component")).unionByName(roots)
