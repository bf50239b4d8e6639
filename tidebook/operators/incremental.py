"""Incremental loading of a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.session import settle
from tidebook.sources.sinks import write_parquet

HIGH_WATER = "high_water"
KEY_DIFF = "key_diff"


def new_rows(target: DataFrame, batch: DataFrame, key: str, ts: str, mode: str = HIGH_WATER) -> DataFrame:
    """The rows of ``batch`` that a load has to apply.

    ``high_water`` takes rows later than the newest loaded one: cheap, but a late
    row, or a status change that keeps its time, is not seen until a full refresh.
    ``key_diff`` takes rows whose key is new or whose values differ.
    """
    if mode == HIGH_WATER:
        # One value, looked up first: as a literal it reaches the scan of the batch,
        # below any join the batch was built with.
        mark = target.agg(F.max(ts).cast("string")).first()[0] or "1900-01-01 00:00:00"
        return batch.where(F.col(ts) > F.lit(mark).cast(batch.schema[ts].dataType))
    if mode == KEY_DIFF:
        if not set(batch.columns) <= set(target.columns):
            return batch  # every row gains a column, so all have to be applied
        shared = [c for c in batch.columns if c != key]
        loaded = target.select(F.col(key).alias("_key"), F.struct(*shared).alias("_row"))
        same = (F.col(key) == F.col("_key")) & F.struct(*shared).eqNullSafe(F.col("_row"))
        return batch.join(loaded, same, "left_anti")
    raise ValueError(f"mode must be {HIGH_WATER!r} or {KEY_DIFF!r}, not {mode!r}")


def apply_rows(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Replace by key, then append. Columns follow ``new``: added ones are NULL in
    old rows, removed ones are dropped."""
    kept = target.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True).select(*new.columns)


def merge_new(
    target: DataFrame, batch: DataFrame, key: str = "order_id", ts: str = "order_ts", mode: str = HIGH_WATER
) -> DataFrame:
    """The target after the load, as a query (``high_water`` looks up its mark now)."""
    return apply_rows(target, new_rows(target, batch, key, ts, mode), key)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def full_refresh(fact: DataFrame, path: str, partition: str = "order_month") -> None:
    """Rebuild the stored fact from scratch."""
    write_parquet(fact, path, partition)


def publish(
    batch: DataFrame,
    path: str,
    key: str = "order_id",
    ts: str = "order_ts",
    mode: str = HIGH_WATER,
    partition: str = "order_month",
) -> None:
    """Apply a batch to the fact stored at ``path``, one folder per month.

    Only months that gain or lose a row are rewritten: those of the new rows and
    those that hold a row being replaced. Everything else is left alone, so a daily
    load costs about a month of data. The new rows and the rewritten months are
    settled in the shared folder first, as a job cannot overwrite what it reads. The
    write moves folder by folder; should it be interrupted, publishing the same batch
    again with ``key_diff`` completes it (``high_water`` would not look at older months).
    """
    spark = batch.sparkSession
    if not _exists(spark, path):
        full_refresh(batch, path, partition)
        return
    target = spark.read.parquet(path)
    if sorted(target.columns) != sorted(batch.columns):
        # Changed columns touch every row of the table.
        full_refresh(settle(merge_new(target, batch, key, ts, mode), "resynced"), path, partition)
        return
    recent = target
    if mode == HIGH_WATER and partition == "order_month":
        # The newest row is in the newest month; older folders need not be read.
        newest = target.agg(F.max(partition)).first()[0]  # one date
        recent = target.where(F.col(partition) == F.lit(newest))
    new = settle(new_rows(recent, batch, key, ts, mode), "new-rows")
    replaced = target.join(new.select(key), key, "left_semi").select(partition)
    months = [r[0] for r in new.select(partition).union(replaced).distinct().collect()]  # calendar-bounded
    if not months:
        return
    touched = F.col(partition).isin(months)
    if any(m is None for m in months):
        touched = touched | F.col(partition).isNull()
    rewritten = settle(apply_rows(target.where(touched), new, key), "rewritten")
    # A month whose rows all moved elsewhere cannot be expressed as an overwrite: its folder goes
    # first, so that a replay by key finds its rows missing, never twice.
    for month in set(months) - {r[0] for r in rewritten.select(partition).distinct().collect()}:
        _remove(spark, f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")
    write_parquet(rewritten, path, partition, replace="dynamic")
