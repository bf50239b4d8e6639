"""Sums without rounding of what is summed, in any order, at any size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidebook.functions import exact_mean, exact_sum
from tidebook.functions.money import RATE
from tidebook.operators.slicing import pivot_explore


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_tiny_and_huge_amounts(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        tiny = spark.range(1_000_000).select(F.lit(0.00004).alias("x"))
        assert tiny.agg(exact_sum(F.col("x"))).first()[0] == 40.0
        huge = spark.range(100_000).select(F.lit(987_654_321_012.25).alias("x"))
        total, mean = huge.agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()
        assert total == 98_765_432_101_225_000.0 and mean == pytest.approx(987_654_321_012.25, rel=1e-15)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_order_does_not_matter(spark):
    rows = spark.range(10_000).select((F.rand(7) * 1000).alias("x"))
    kept = spark.createDataFrame(rows.collect(), "x double")
    totals = {kept.repartition(n).agg(exact_sum(F.col("x"))).first()[0] for n in (1, 3, 7)}
    assert len(totals) == 1


def test_nothing_to_sum(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first() == (None, None)


def test_pivot_of_tiny_shares(spark):
    shares = spark.createDataFrame([("a", 1e-9)] * 1000 + [("b", 0.5), ("b", None)], "g string, share double")
    got = {(r["g"], n): r["share"] for n in ("sum", "mean") for r in pivot_explore(shares, "g", "share", n, RATE).collect()}
    assert got == pytest.approx({("a", "sum"): 1e-6, ("a", "mean"): 1e-9, ("b", "sum"): 0.5, ("b", "mean"): 0.5}, rel=1e-12)
