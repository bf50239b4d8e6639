"""How many validity intervals cover each point of a date spine.

Comparing every interval with every spine point costs intervals x points. Here an
interval contributes +weight where it opens and -weight where it closes; the
changes are summed per day (one partial aggregation, so the rows that move are
bounded by the calendar) and a running total over days gives the level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import exact_units, from_units, no_units

OPEN_CLOSED = "(]"  # start <  point <= end
CLOSED_OPEN = "[)"  # start <= point <  end


def usable_interval(start: Column, end: Column) -> Column:
    """Intervals that can cover anything: a start, and no end before it."""
    return start.isNotNull() & (end.isNull() | (end >= start))


def endpoint_changes(start: Column, end: Column, opened: Column, closed: Column) -> Column:
    """Array of ``(at, change)``: where the interval opens and where it closes."""
    opening = F.struct(start.alias("at"), opened.alias("change"))
    closing = F.struct(end.alias("at"), closed.alias("change"))
    return F.filter(F.array(opening, closing), lambda e: e["at"].isNotNull())


def active_on_spine(
    spine: DataFrame,
    intervals: DataFrame,
    start: str,
    end: str,
    weight: str | None = None,
    bounds: str = OPEN_CLOSED,
    point: str = "month",
) -> DataFrame:
    """``(point, active)`` for each distinct DATE in ``spine[point]``.

    ``active`` is a row count, or the sum of ``weight`` (a money column) as DOUBLE.
    """
    if bounds not in (OPEN_CLOSED, CLOSED_OPEN):
        raise ValueError(f"bounds must be '(]' or '[)', not {bounds!r}")
    w = F.lit(1).cast("bigint") if weight is None else F.coalesce(exact_units(F.col(weight)), no_units())
    changes = (
        intervals.where(usable_interval(F.col(start), F.col(end)))
        .select(F.explode(endpoint_changes(F.col(start), F.col(end), w, -w)).alias("e"))
        .select(F.col("e.at").alias("at"), F.col("e.change").alias("change"), F.lit(False).alias("wanted"))
    )
    points = spine.select(F.col(point).alias("at"), F.lit(0).cast("bigint").alias("change"), F.lit(True).alias("wanted"))
    per_day = changes.unionByName(points).groupBy("at").agg(
        F.sum("change").alias("change"), F.bool_or("wanted").alias("wanted")
    )
    # At most one row per calendar day is left, so one task can order them.
    level = F.sum("change").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    if bounds == OPEN_CLOSED:
        level = level - F.col("change")  # endpoints on the point itself take effect after it
    active = level if weight is None else from_units(level)
    return per_day.select(F.col("at").alias(point), active.alias("active"), "wanted").where("wanted").drop("wanted")
