"""Writing marts for other tools: Parquet and CSV folders plus a row manifest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

FORMATS = ("csv", "parquet", "both")


def gathered(df: DataFrame, column: str) -> DataFrame:
    """Bring the rows of a folder together before writing folders.

    Otherwise every task writes a file into every folder. Unlike a plain repartition
    a rebalance lets AQE split a folder with an outsized share of the rows and merge
    small ones, so files come out near the advisory size.
    """
    return df.hint("rebalance", F.col(column))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, replace: str = "static") -> None:
    """Overwrite the table; ``replace="dynamic"`` overwrites only folders that get rows."""
    if partition_by is None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return
    rows = gathered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", replace)
    rows.partitionBy(partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with the header; one part per task."""
    df.write.mode("overwrite").option("header", True).option("sep", ",").csv(path)


def manifest_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, as a query."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def export(tables: Mapping[str, DataFrame], directory: str, fmt: str = "both") -> DataFrame:
    """Write every table as ``csv``, ``parquet`` or ``both`` and a manifest.

    Parquet is written first and the CSV is made from those files, so a mart is
    computed once however many formats are asked for. Row counts come from the
    write. Returns the manifest rows, also stored as ``_manifest``.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    counts: list[tuple[str, int]] = []
    for name, df in tables.items():
        spark = df.sparkSession
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if fmt == "csv":
            write_csv(rows, f"{directory}/csv/{name}")
        else:
            write_parquet(rows, f"{directory}/parquet/{name}")
            if fmt == "both":
                write_csv(spark.read.schema(df.schema).parquet(f"{directory}/parquet/{name}"), f"{directory}/csv/{name}")
        counts.append((name, int(seen.get["rows"])))
    manifest = spark.createDataFrame(counts, "table_name string, rows bigint").withColumn(
        "generated_at_utc", F.current_timestamp()
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{directory}/_manifest")
    return manifest
