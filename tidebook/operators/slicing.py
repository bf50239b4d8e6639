"""The filter bar and the no-code pivot over any mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions import exact_mean, exact_sum
from tidebook.functions.money import MONEY

AGGREGATIONS = ("sum", "mean", "count", "min", "max")


def slice_customers(
    df: DataFrame,
    regions: Sequence[str] | None = None,
    plans: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
) -> DataFrame:
    """Keep rows whose attributes are in every given list; None means no filter."""
    for column, values in (("region", regions), ("plan", plans), ("acquisition_channel", channels)):
        if values is not None:
            df = df.where(F.col(column).isin(list(values)))
    return df


def slice_orders(
    df: DataFrame,
    regions: Sequence[str] | None = None,
    plans: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """:func:`slice_customers` plus an inclusive window on ``order_date``.

    Everything is a plain predicate, so it reaches the Parquet scan; with a fact
    partitioned by month the window also prunes partitions.
    """
    df = slice_customers(df, regions, plans, channels)
    if first_day is not None:
        day = F.lit(first_day).cast("date")
        df = df.where((F.col("order_date") >= day) & (F.col("order_month") >= F.trunc(day, "month")))
    if last_day is not None:
        day = F.lit(last_day).cast("date")
        df = df.where((F.col("order_date") <= day) & (F.col("order_month") <= day))
    return df


def filter_domain(customers: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """What the filters can be set to: ``(facet, value)`` rows, sorted.

    The three attributes come from one scan; the date range is one more row each.
    """
    facets = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("facet"), F.col(column).alias("value"))
                for name, column in (("region", "region"), ("plan", "plan"), ("channel", "acquisition_channel"))
            ]
        )
    )
    values = customers.select(facets.alias("f")).select("f.facet", "f.value").distinct()
    dates = fct_orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).select(
        F.explode(
            F.array(
                F.struct(F.lit("min_date").alias("facet"), F.col("lo").cast("string").alias("value")),
                F.struct(F.lit("max_date").alias("facet"), F.col("hi").cast("string").alias("value")),
            )
        ).alias("f")
    )
    return values.unionByName(dates.select("f.facet", "f.value")).orderBy("facet", "value")


def column_kinds(df: DataFrame) -> dict[str, list[str]]:
    """Numeric columns can be metrics; all others can be groups."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return {"numeric": numeric, "categorical": [c for c in df.columns if c not in numeric]}


def pivot_explore(df: DataFrame, by: str, metric: str, agg: str = "sum", decimals: int = MONEY) -> DataFrame:
    """``metric`` aggregated per value of ``by``, largest first. NULL groups are left out.

    Sums and means of fractional columns are taken over ``decimals`` decimals: the default
    is for amounts, ``RATE`` is for shares and rates, which may all be tiny.
    """
    kinds = column_kinds(df)
    if by not in kinds["categorical"]:
        raise ValueError(f"cannot group by {by!r}; choose one of {kinds['categorical']}")
    if metric not in kinds["numeric"]:
        raise ValueError(f"cannot aggregate {metric!r}; choose one of {kinds['numeric']}")
    if agg not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation {agg!r}; choose one of {AGGREGATIONS}")
    column = F.col(metric)
    fractional = isinstance(df.schema[metric].dataType, (T.DoubleType, T.FloatType))
    expr = {
        "sum": exact_sum(column, decimals) if fractional else F.sum(column),
        "mean": exact_mean(column, decimals) if fractional else F.try_divide(F.sum(column).cast("double"), F.count(column)),
        "count": F.count(column),
        "min": F.min(column),
        "max": F.max(column),
    }[agg]
    return (
        df.where(F.col(by).isNotNull()).groupBy(by).agg(expr.alias(metric)).orderBy(F.col(metric).desc_nulls_last(), by)
    )
