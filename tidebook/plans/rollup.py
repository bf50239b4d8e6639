"""Summing several feeds onto one calendar spine in one shuffle.

Joining a date spine to N per-date aggregates costs N aggregations and N joins, and
finding the spine's ends costs another pass over the feeds. Here each feed is
projected to ``(key, its own metric columns)``, the feeds are stacked, and a single
group-by sums them: map tasks pre-aggregate to one row per key, so what moves is
(tasks x keys) rows whatever the size of the feeds. The result has at most one row
per calendar day or month; only then is the spine laid over it, in one task.

A metric of a key without any row of its feed stays NULL, as a left join gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Marks the feeds whose dates span the calendar.
HAS_ORDER, HAS_SESSION = "has_order", "has_session"
MARKS = (HAS_ORDER, HAS_SESSION)


def mark(name: str) -> Column:
    return F.lit(True).alias(name)


def stack(feeds: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def roll_up(feeds: Sequence[DataFrame], key: str, extra: Sequence[Column] = (), latest: Sequence[str] = ()) -> DataFrame:
    """One row per key; metrics are summed, ``latest`` ones take the maximum.

    Columns starting with ``_`` are only for ``extra`` aggregates.
    """
    rows = stack(feeds)
    metrics = [c for c in rows.columns if c != key and c not in MARKS and not c.startswith("_")]
    aggs = [F.bool_or(m).alias(m) for m in MARKS if m in rows.columns]
    aggs += [F.max(m).alias(m) if m in latest else F.sum(m).alias(m) for m in metrics]
    return rows.groupBy(key).agg(*aggs, *extra)


def lay_spine(
    rolled: DataFrame,
    key: str,
    step: str,
    first: Column,
    last: Column,
    running: dict[str, str] | None = None,
    overall_latest: Sequence[str] = (),
) -> DataFrame:
    """Every key from the earliest one marked ``first`` to the latest marked ``last``.

    ``running`` maps a column of changes to the name of its level: levels count
    changes before the spine and carry over keys without rows, while all other
    metrics are NULL there. ``overall_latest`` columns become their maximum over all
    rows, those without a key included.
    """
    running = running or {}
    by_key = Window.orderBy(key)
    everything = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = by_key.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("bigint")
    plain = [c for c in rolled.columns if c != key and c not in MARKS and c not in running and c not in overall_latest]
    until_next = F.lead(key).over(by_key) - F.expr(f"interval 1 {step}")
    wide = rolled.select(
        F.col(key).alias("_key"),
        until_next.cast("date").alias("_until"),
        F.min(F.when(first, F.col(key))).over(everything).alias("_first"),
        F.max(F.when(last, F.col(key))).over(everything).alias("_last"),
        *plain,
        *[F.coalesce(F.sum(c).over(so_far), zero).alias(level) for c, level in running.items()],
        *[F.max(c).over(everything).alias(c) for c in overall_latest],
    )
    keys = F.sequence(F.col("_key"), F.coalesce("_until", "_key"), F.expr(f"interval 1 {step}"))
    filled = wide.withColumn(key, F.explode(keys)).where((F.col(key) >= F.col("_first")) & (F.col(key) <= F.col("_last")))
    own = F.col(key) == F.col("_key")
    return filled.select(
        key,
        *[F.when(own, F.col(c)).alias(c) for c in plain],
        *running.values(),
        *overall_latest,
    )
