"""The daily job: land, stage, build, test, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators.quality import freshness, reconcile, run_checks, verdict
from tidebook.operators.staging import Staged
from tidebook.operators.versions import read_table, replace_version
from tidebook.plans.warehouse import Warehouse, mart_suite, source_suite, staging_suite
from tidebook.sources import RAW_SCHEMAS, land, replace_table


def landed_tables(spark: SparkSession, landed_dir: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{landed_dir}/{name}") for name in RAW_SCHEMAS}


def freshness_verdicts(landed: dict[str, DataFrame], as_of: str) -> DataFrame:
    out = None
    for name, df in landed.items():
        line = freshness(df, as_of).select(
            F.lit("freshness").alias("check_name"),
            F.lit(name).alias("table_name"),
            F.lit("_ingested_at").alias("column_name"),
            F.when(F.col("status") == "pass", 0).otherwise(1).cast("bigint").alias("failures"),
            "status",
        )
        out = line if out is None else out.unionByName(line)
    return out


def all_checks(landed: dict[str, DataFrame], warehouse: Warehouse, as_of: str | None = None) -> DataFrame:
    """Every declared test; with ``as_of`` the freshness of the landed tables too."""
    tables = {**landed, **warehouse.staged.by_name, **warehouse.marts}
    checks = run_checks(tables, {**source_suite(), **staging_suite(), **mart_suite()})
    totals = reconcile(warehouse.kpi_daily, warehouse.staged.orders, "recognized_revenue")
    checks = checks.unionByName(verdict(totals, "reconcile", "kpi_daily", "recognized_revenue"))
    if as_of is not None:
        checks = checks.unionByName(freshness_verdicts(landed, as_of))
    return checks


def run_daily(
    spark: SparkSession,
    source_dir: str | None,
    landed_dir: str,
    export_dir: str,
    fmt: str = "both",
    as_of: str | None = None,
    versioned: bool = False,
) -> DataFrame:
    """One refresh. Without ``source_dir`` the tables landed before are used again. With ``versioned``
    a table lands as a new version, so that a lost job leaves the landed tables as they were.

    Returns the export manifest; raises when a test fails, before anything is exported.
    """
    if source_dir is not None:
        land(spark, source_dir, landed_dir, replace=replace_version if versioned else replace_table)
    landed = landed_tables(spark, landed_dir)
    warehouse = Warehouse(Staged.from_raw(landed)).settled()
    return warehouse.export(export_dir, fmt, checks=all_checks(landed, warehouse, as_of))
