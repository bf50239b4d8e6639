"""Data tests as Spark jobs: failing rows, one-line verdicts, and the export gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import exact_sum

# --- failing rows -------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, failures)`` for all columns, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, and how many rows carry them.

    Child rows are counted per key before the join, so a key with a third of the
    rows is one row when it moves.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    return keys.join(parent.select(F.col(key).alias("_parent")), F.col("orphan_key") == F.col("_parent"), "left_anti")


def accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def bounds(df: DataFrame, column: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Rows whose value lies outside ``[lo, hi]``."""
    return df.where(outside(F.col(column), lo, hi))


def outside(value: Column, lo: float | None, hi: float | None) -> Column:
    tests = []
    if lo is not None:
        tests.append(value < F.lit(lo))
    if hi is not None:
        tests.append(value > F.lit(hi))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def reconcile(a: DataFrame, b: DataFrame, column: str, tolerance: float = 1.0) -> DataFrame:
    """One row when two totals of ``column`` differ by more than ``tolerance``, else none."""
    left = a.agg(exact_sum(F.col(column)).alias("left_total"))
    right = b.agg(exact_sum(F.col(column)).alias("right_total"))
    both = left.crossJoin(F.broadcast(right))  # one row each
    return both.where(F.abs(F.col("left_total") - F.col("right_total")) > tolerance)


def freshness(
    df: DataFrame, as_of: str, loaded_at: str = "_ingested_at", warn_h: float = 36, error_h: float = 72
) -> DataFrame:
    """Age of the newest row against the agreed limits.

    A table that was never loaded has no age and is an error.
    """
    kind = df.schema[loaded_at].dataType
    newest = df.agg(F.max(loaded_at).alias("last_loaded"))
    moment = F.lit(as_of).cast(kind)
    seconds = F.timestamp_diff("SECOND", F.col("last_loaded"), moment)
    age = seconds.cast("double") / F.lit(3600.0)
    status = F.when(age.isNull() | (age > error_h), "error").when(age > warn_h, "warn").otherwise("pass")
    return newest.select("last_loaded", age.alias("age_hours"), status.alias("status"))


def null_rate(df: DataFrame, column: str, max_rate: float) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.count_if(F.col(column).isNull()).cast("double"), F.count(F.lit(1))), F.lit(0.0))
    return df.agg(rate.alias("null_rate")).select(
        "null_rate", F.when(F.col("null_rate") <= max_rate, "pass").otherwise("fail").alias("status")
    )


# --- verdicts -----------------------------------------------------------------

VERDICT = ("check_name", "table_name", "column_name", "failures", "status")


def verdict(rows: DataFrame, check: str, table: str, column: str) -> DataFrame:
    """Reduce failing rows to one line: how many there are, pass or fail."""
    return rows.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


@dataclass
class Expect:
    """The tests declared on one table."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    bounds: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)


def _row_tests(df: DataFrame, table: str, spec: Expect) -> DataFrame:
    """NULL, range and domain verdicts of a table from one scan; only what fails a test moves.

    A row that is NULL or out of range is a failure; of values outside a domain each counts once.
    """
    tests = [("not_null", c, F.col(c).isNull(), None) for c in spec.not_null]
    tests += [("bounds", c, outside(F.col(c), lo, hi), None) for c, (lo, hi) in spec.bounds.items()]
    tests += [("accepted_values", c, ~F.col(c).isin(list(values)), F.col(c).cast("string")) for c, values in spec.accepted.items()]
    no_value = F.lit(None).cast("string")
    failing = [
        F.when(test, F.struct(F.lit(i).alias("test"), (no_value if value is None else value).alias("value")))
        for i, (_, _, test, value) in enumerate(tests)
    ]
    found = df.select(F.explode(F.array_compact(F.array(*failing))).alias("f")).groupBy("f.test", "f.value").agg(F.count(F.lit(1)).alias("n"))
    found = found.groupBy("test").agg(F.sum("n").alias("failing_rows"), F.count(F.lit(1)).alias("failing_values"))
    lines = [(i, kind, table, column, value is not None) for i, (kind, column, _, value) in enumerate(tests)]
    wanted = df.sparkSession.createDataFrame(lines, "test int, check_name string, table_name string, column_name string, by_value boolean")
    failures = F.coalesce(F.when(F.col("by_value"), F.col("failing_values")).otherwise(F.col("failing_rows")), F.lit(0).cast("bigint"))
    verdicts = wanted.join(found, "test", "left").withColumn("failures", failures)
    return verdicts.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")).select(*VERDICT)


def run_checks(tables: Mapping[str, DataFrame], suite: Mapping[str, Expect]) -> DataFrame:
    """All declared tests, one verdict line each."""
    parts: list[DataFrame] = []
    for table, spec in suite.items():
        df = tables[table]
        if spec.not_null or spec.bounds or spec.accepted:
            parts.append(_row_tests(df, table, spec))
        for column in spec.unique:
            parts.append(verdict(unique(df, column), "unique", table, column))
        for column, (parent, key) in spec.relationships.items():
            orphans = relationships(df, column, tables[parent], key)
            total = orphans.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("failures"))
            parts.append(
                total.select(
                    F.lit("relationships").alias("check_name"),
                    F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    "failures",
                    F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
                )
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


class ChecksFailed(RuntimeError):
    """Raised instead of exporting marts that failed a test."""


def gate(checks: DataFrame) -> DataFrame:
    """One row: tests run, tests failed, and whether exports may go ahead."""
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status").isin("fail", "error")).alias("failed")
    ).select("checks", "failed", (F.col("failed") == 0).alias("export_allowed"))


def require_passing(checks: DataFrame) -> None:
    """Raise :class:`ChecksFailed` naming the failed tests (a warning is no failure)."""
    failed = checks.where(F.col("status").isin("fail", "error")).select("check_name", "table_name", "column_name")
    names = [".".join(map(str, r)) for r in failed.collect()]  # at most one line per declared test
    if names:
        raise ChecksFailed("exports withheld: " + ", ".join(sorted(names)))
