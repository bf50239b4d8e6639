"""Calendar helpers. Months are represented by their first day, as DATE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "month").cast("date")


def add_month(day: Column, months: int = 1) -> Column:
    return F.add_months(day, months)


def month_index(day: Column) -> Column:
    return F.year(day) * F.lit(12) + F.month(day)


def month_gap(start: Column, end: Column) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (not whole months)."""
    return month_index(end) - month_index(start)


def day_gap(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def first_month_after(day: Column) -> Column:
    """First first-of-month strictly later than ``day``."""
    return add_month(month_start(day))


def first_month_from(day: Column) -> Column:
    """First first-of-month on or after ``day``."""
    return first_month_after(F.date_sub(day, 1))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def day_of_week(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - F.lit(1)


def calendar_columns(day: Column) -> list[Column]:
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        month_start(day).alias("month_start"),
        F.weekofyear(day).alias("week_num"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        day_of_week(day).isin(0, 6).alias("is_weekend"),
    ]
