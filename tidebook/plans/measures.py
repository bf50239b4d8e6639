"""Named measures over the marts: one aggregate each, grouped and filtered on demand.

A measure's filters and groups may name any table of the star (:mod:`tidebook.plans.star`): they reach
the measure's table through its relationships.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import exact_mean, exact_sum, month_start, rate_mean, ratio_or_null, share_label, share_of
from tidebook.plans.analysis import prior_month, year_to_date
from tidebook.plans.star import Context, Star

# Thresholds of the measure library.
CHURN_TARGET = 0.055
REVENUE_TARGET = 500_000.0
HEALTHY_RATIO, WATCH_RATIO = 3.0, 2.0
WATCH_SHARE = 0.9


@dataclass(frozen=True)
class Measure:
    table: str
    aggregate: Callable[[], Column]


def _col(name: str) -> Column:
    return F.col(name)


_PRIORITY = "priority_segment = 1"

#: Measures that are one aggregate over one table.
SIMPLE: dict[str, Measure] = {
    "recognized_revenue": Measure("fct_orders", lambda: exact_sum(_col("recognized_revenue"))),
    # One row per order is guaranteed by the unique test on order_id, so rows are counted.
    "recognized_orders": Measure("fct_orders", lambda: F.count(F.when(_col("is_recognized"), _col("order_id")))),
    "refund_rate": Measure("fct_orders", lambda: share_of(_col("status") == "refunded")),
    "churn_rate": Measure("kpi_monthly", lambda: rate_mean(_col("churn_rate"))),
    "churned_customers": Measure("kpi_monthly", lambda: F.sum("churned_customers")),
    "marketing_spend": Measure("kpi_monthly", lambda: exact_sum(_col("marketing_spend"))),
    "new_customers": Measure("kpi_monthly", lambda: F.sum("new_customers")),
    "ltv": Measure("kpi_monthly", lambda: exact_mean(_col("ltv"))),
    "sessions": Measure("kpi_monthly", lambda: F.sum("sessions")),
    "conversions": Measure("kpi_monthly", lambda: F.sum("conversions")),
    "retention_30d": Measure(
        "kpi_monthly", lambda: rate_mean(F.when(_col("cohort_is_mature"), _col("retention_30d")))
    ),
    "retention_30d_latest": Measure(
        "kpi_monthly", lambda: F.max_by("retention_30d", F.when(_col("cohort_is_mature"), _col("month")))
    ),
    "active_mrr": Measure("fct_subscriptions", lambda: exact_sum(F.when(_col("is_active"), _col("mrr")))),
    "active_customers": Measure(
        "fct_subscriptions", lambda: F.countDistinct(F.when(_col("is_active"), _col("customer_id")))
    ),
    "priority_revenue": Measure(
        "customer_segments", lambda: exact_sum(F.when(F.expr(_PRIORITY), _col("lifetime_revenue")))
    ),
    "total_segment_revenue": Measure("customer_segments", lambda: exact_sum(_col("lifetime_revenue"))),
    "priority_customer_share": Measure("customer_segments", lambda: share_of(F.expr(_PRIORITY))),
}

#: Measures computed from others, group by group.
DERIVED: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "avg_order_value": (("recognized_revenue", "recognized_orders"), ratio_or_null),
    "churn_vs_target": (("churn_rate",), lambda churn: churn - F.lit(CHURN_TARGET)),
    "cac": (("marketing_spend", "new_customers"), ratio_or_null),
    "ltv_to_cac": (("ltv", "cac"), ratio_or_null),
    "ltv_cac_status": (
        ("ltv_to_cac",),
        lambda r: F.when(r >= HEALTHY_RATIO, "Healthy").when(r >= WATCH_RATIO, "Watch").otherwise("Unhealthy"),
    ),
    "conversion_rate": (("conversions", "sessions"), ratio_or_null),
    "active_arr": (("active_mrr",), lambda mrr: mrr * F.lit(12.0)),
    "arpa": (("recognized_revenue", "active_customers"), ratio_or_null),
    "priority_revenue_share": (("priority_revenue", "total_segment_revenue"), ratio_or_null),
    "priority_label": (
        ("priority_customer_share", "priority_revenue_share"),
        lambda people, revenue: F.concat(
            share_label(people), F.lit(" of customers → "), share_label(revenue), F.lit(" of revenue")
        ),
    ),
    "revenue_vs_target_pct": (
        ("recognized_revenue",),
        lambda revenue: (revenue - F.lit(REVENUE_TARGET)) / F.lit(REVENUE_TARGET),
    ),
    "revenue_rag": (
        ("recognized_revenue",),
        lambda revenue: F.when(revenue >= REVENUE_TARGET, "On Target")
        .when(revenue >= WATCH_SHARE * REVENUE_TARGET, "Watch")
        .otherwise("Off Target"),
    ),
}

#: Measures that look along the calendar; they come back one row per month.
BY_MONTH = ("recognized_revenue_pm", "revenue_mom_pct", "revenue_ytd")

MEASURES = (*SIMPLE, *DERIVED, *BY_MONTH)


def _leaves(name: str) -> list[str]:
    if name in SIMPLE:
        return [name]
    out: list[str] = []
    for part in DERIVED[name][0]:
        out += [leaf for leaf in _leaves(part) if leaf not in out]
    return out


def _expression(name: str) -> Column:
    if name in SIMPLE:
        return F.col(name)
    parts, combine = DERIVED[name]
    return combine(*[_expression(p) for p in parts])


#: The marked date table: measures along the calendar clear the filters on it, then show the months it leaves.
CALENDAR = "dim_date"


def _context(tables: Mapping[str, DataFrame], where: Column | str | Context | None, table: str) -> DataFrame:
    """``table`` under ``where``: a predicate is the table's own, a mapping goes through the star."""
    if isinstance(where, Mapping):
        return Star(tables).sliced(table, where)
    return tables[table] if where is None else tables[table].where(where)


def _monthly_revenue(tables: Mapping[str, DataFrame], where: Column | str | Context | None) -> DataFrame:
    facts = _context(tables, where, "fct_orders").where("order_date is not null")
    month = month_start(F.col("order_date")).alias("month")
    return facts.groupBy(month).agg(exact_sum(F.col("recognized_revenue")).alias("recognized_revenue"))


def _along_calendar(names: Sequence[str], tables: Mapping[str, DataFrame], where: Column | str | Context | None) -> DataFrame:
    dated = isinstance(where, Mapping) and CALENDAR in where
    undated = {t: p for t, p in where.items() if t != CALENDAR} if dated else where
    monthly = _monthly_revenue(tables, undated)
    before = prior_month(monthly, "recognized_revenue")
    ytd = year_to_date(monthly, "recognized_revenue").drop("recognized_revenue")
    both = before.join(ytd, "month")
    if dated:
        # The month's own revenue is that of the days left; a month with no day left is not shown.
        months = tables[CALENDAR].where(where[CALENDAR]).select(month_start(F.col("date_key")).alias("month")).distinct()
        shown = _monthly_revenue(tables, where)
        both = both.drop("recognized_revenue").join(months, "month", "left_semi").join(shown, "month", "left")
    now, pm = F.col("recognized_revenue"), F.col("recognized_revenue_pm")
    columns = {
        "recognized_revenue": now,
        "recognized_revenue_pm": pm,
        "revenue_mom_pct": ratio_or_null(now - pm, pm),
        "revenue_ytd": F.col("recognized_revenue_ytd"),
    }
    return both.select("month", *[columns[n].alias(n) for n in names])


def measure(
    name: str | Sequence[str],
    tables: Mapping[str, DataFrame],
    group_cols: Sequence[str] = (),
    where: Column | str | Context | None = None,
) -> DataFrame:
    """One or several measures, per combination of ``group_cols``.

    All measures of a table share one aggregation. Measures over several tables are
    joined on the groups: columns that each table involved has, or columns of a dimension
    of all of them, as ``dim_customers.region``. ``where`` as one predicate applies to
    every table; as a mapping from tables to predicates it is a filter context, which
    goes through the star's relationships and leaves unrelated tables as they are.
    """
    names = [name] if isinstance(name, str) else list(name)
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise KeyError(f"unknown measures {unknown}")
    if any(n in BY_MONTH for n in names):
        if group_cols:
            raise ValueError("calendar measures come per month and take no further groups")
        return _along_calendar(names, tables, where)

    leaves: list[str] = []
    for n in names:
        leaves += [leaf for leaf in _leaves(n) if leaf not in leaves]
    by_table: dict[str, list[str]] = {}
    for leaf in leaves:
        by_table.setdefault(SIMPLE[leaf].table, []).append(leaf)

    star, keys = Star(tables), [c.rpartition(".")[2] for c in group_cols]
    out: DataFrame | None = None
    for table, wanted in by_table.items():
        if isinstance(where, Mapping) or any("." in c for c in group_cols):
            df, _ = star.grouped(table, group_cols, where if isinstance(where, Mapping) else None)
            df = df if where is None or isinstance(where, Mapping) else df.where(where)
        else:
            df = _context(tables, where, table)
        part = df.groupBy(*keys).agg(*[SIMPLE[leaf].aggregate().alias(leaf) for leaf in wanted])
        if out is None:
            out = part
        elif keys:
            # Customers without a dimension row are one group: NULL, on either side.
            part = part.withColumnsRenamed({k: f"_{k}" for k in keys})
            both = out.join(part, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "full")
            either = [F.coalesce(k, f"_{k}").alias(k) for k in keys]
            out = both.select(*either, *(c for c in out.columns if c not in keys), *wanted)
        else:
            out = out.crossJoin(F.broadcast(part))  # one row each
    return out.select(*keys, *[_expression(n).alias(n) for n in names])
