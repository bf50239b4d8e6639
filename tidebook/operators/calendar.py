"""Calendar spines derived from the data's own date range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import calendar_columns, month_start


def date_bounds(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: first and last day over both feeds, and the last order day."""
    o = orders.agg(F.min("order_date").alias("o_lo"), F.max("order_date").alias("o_hi"))
    s = sessions.agg(F.min("session_date").alias("s_lo"), F.max("session_date").alias("s_hi"))
    return o.crossJoin(F.broadcast(s)).select(  # one row on either side
        F.least("o_lo", "s_lo").alias("first_day"),
        F.greatest("o_hi", "s_hi").alias("last_day"),
        F.col("o_hi").alias("last_order_day"),
    )


def day_spine(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds, both included."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date_key"))


def month_spine(bounds: DataFrame) -> DataFrame:
    """Every month of the date range up to the last month with an order."""
    first = month_start(F.col("first_day"))
    last = month_start(F.least("last_day", "last_order_day"))
    # A feed without any order has no month to report.
    months = F.when(F.col("last_order_day").isNotNull(), F.sequence(first, last, F.expr("interval 1 month")))
    return bounds.select(F.explode(months).alias("month"))


def dim_date(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    return day_spine(date_bounds(orders, sessions)).select(*calendar_columns(F.col("date_key")))
