"""The ad-hoc questions asked of the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import (
    exact_sum,
    exact_units,
    from_units,
    ratio_or_null,
    round_half_away,
    share_of,
)
from tidebook.operators.ranking import ROWS_PER_RANGE, Ordering, places_at, prefix_sum

REVENUE_DESC = Ordering("lifetime_revenue", descending=True)


def percent(part: Column, whole: Column) -> Column:
    return ratio_or_null(part * F.lit(100.0), whole)


def last_order_month(orders: DataFrame) -> DataFrame:
    """One row: the month of the newest order, which is still being filled."""
    return orders.agg(F.trunc(F.max("order_date"), "month").cast("date").alias("open_month"))


def complete_months(monthly: DataFrame, orders: DataFrame) -> DataFrame:
    """Months before the one the newest order falls in."""
    return monthly.crossJoin(F.broadcast(last_order_month(orders))).where("month < open_month").drop("open_month")


def concentration(segments: DataFrame, flag: str = "priority_segment") -> DataFrame:
    """Customers and revenue inside and outside a flagged group, with shares."""
    groups = segments.groupBy(
        F.when(F.col(flag) == 1, "Priority (high-value)").otherwise("Everyone else").alias("cohort")
    ).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(exact_units(F.col("lifetime_revenue"))).alias("units"),
    )
    everyone = Window.partitionBy(F.lit(1))  # two rows
    return groups.select(
        "cohort",
        "customers",
        round_half_away(percent(F.col("customers"), F.sum("customers").over(everyone)), 1).alias("pct_customers"),
        round_half_away(from_units(F.col("units"))).alias("lifetime_revenue"),
        round_half_away(percent(from_units(F.col("units")), from_units(F.sum("units").over(everyone))), 1).alias("pct_revenue"),
    ).orderBy(F.col("pct_revenue").desc_nulls_last())


def pareto(
    segments: DataFrame, buckets: Sequence[int] = (10, 20, 30, 50), rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Revenue share of the top 10, 20, ... percent of customers.

    Only the customers on the bucket edges are located exactly; the shares are then
    conditional sums over an unsorted scan. ``segments`` is read three times: pass a
    settled frame. A bucket that no customer falls into (fewer than ten customers)
    has no row.
    """
    if any(b % 10 or not 0 < b <= 100 for b in buckets):
        raise ValueError("buckets are multiples of 10 up to 100")
    n = segments.count()
    ends = {b: b * n // 100 for b in sorted(set(buckets))}
    ends = {b: end for b, end in ends.items() if end > (b - 10) * n // 100}
    if not ends:
        return segments.sparkSession.createDataFrame([], "top_customers string, pct_of_revenue double")
    places = places_at(segments, [(REVENUE_DESC, list(ends.values()))], n, rows_per_range)[0]
    units = exact_units(F.col("lifetime_revenue"))
    tops = [
        F.sum(F.when(~REVENUE_DESC.after(p, segments.schema), units)).alias(f"top{b}")
        for b, p in zip(ends, places)
    ]
    sums = segments.agg(F.sum(units).alias("total"), *tops)
    lines = F.array(
        *[
            F.struct(
                F.lit(f"{b}%").alias("top_customers"),
                round_half_away(percent(from_units(F.col(f"top{b}")), from_units(F.col("total"))), 1).alias("pct_of_revenue"),
            )
            for b in ends
        ]
    )
    return sums.select(F.explode(lines).alias("l")).select("l.*")


def pareto_curve(segments: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every customer's place on the cumulative revenue curve."""
    n = segments.count()
    total = segments.agg(exact_sum(F.col("lifetime_revenue")).alias("_total"))
    ranked = prefix_sum(
        segments.select("customer_id", "lifetime_revenue"),
        "lifetime_revenue",
        REVENUE_DESC,
        n,
        "revenue_rank",
        "running_revenue",
        rows_per_range,
    )
    return ranked.crossJoin(F.broadcast(total)).select(  # one row
        "customer_id",
        "lifetime_revenue",
        "revenue_rank",
        "running_revenue",
        ratio_or_null(F.col("running_revenue"), F.col("_total")).alias("cum_rev"),
        ratio_or_null(F.col("revenue_rank"), F.lit(n)).alias("cust_pct"),
    )


def latest_kpis(monthly: DataFrame, orders: DataFrame, months: int = 2) -> DataFrame:
    """The headline KPIs of the last complete months."""
    recent = complete_months(monthly, orders).orderBy(F.col("month").desc()).limit(months)
    return recent.select(
        "month_label",
        round_half_away(F.col("recognized_revenue")).alias("revenue"),
        round_half_away(F.col("churn_rate"), 4).alias("churn_rate"),
        round_half_away(F.col("cac")).alias("cac"),
        round_half_away(F.col("ltv")).alias("ltv"),
        round_half_away(ratio_or_null(F.col("ltv"), F.col("cac")), 2).alias("ltv_cac_ratio"),
        round_half_away(F.col("conversion_rate"), 4).alias("conversion_rate"),
        round_half_away(F.col("retention_30d"), 4).alias("retention_30d"),
    ).orderBy("month_label")


def revenue_bridge(monthly: DataFrame) -> DataFrame:
    """Month-over-month change and the trailing three-month average.

    The input has one row per month, so ordering it in one task is intended.
    """
    w = Window.orderBy("month")
    revenue = F.col("recognized_revenue")
    before = F.lag(revenue).over(w)
    last3 = w.rowsBetween(-2, 0)
    mean3 = from_units(F.sum(exact_units(revenue)).over(last3)) / F.count(revenue).over(last3)
    return monthly.select(
        "month_label",
        round_half_away(revenue).alias("revenue"),
        round_half_away(revenue - before).alias("mom_delta"),
        round_half_away(percent(revenue - before, before), 1).alias("mom_pct"),
        round_half_away(mean3).alias("rev_3mo_avg"),
    ).orderBy("month_label")


def channel_efficiency(facts: DataFrame, spend: DataFrame) -> DataFrame:
    """Spend, acquired customers, blended CAC and return per channel.

    Orders collapse to (channel, customer) first, so customers are counted without a
    distinct over raw orders and no channel is too hot.
    """
    buyers = facts.groupBy(F.col("acquisition_channel").alias("channel"), "customer_id").agg(
        F.sum(exact_units(F.col("recognized_revenue"))).alias("units")
    )
    earned = buyers.groupBy("channel").agg(
        F.count("customer_id").alias("customers"), from_units(F.sum("units")).alias("earned")
    )
    paid = spend.groupBy("channel").agg(exact_sum(F.col("spend")).alias("paid"))
    cost = F.coalesce("paid", F.lit(0.0))
    return earned.join(paid, "channel", "left").select(
        "channel",
        "customers",
        round_half_away(cost).alias("marketing_spend"),
        round_half_away(ratio_or_null(cost, F.col("customers"))).alias("cac"),
        round_half_away(F.col("earned")).alias("revenue"),
        round_half_away(ratio_or_null(F.col("earned"), F.col("paid")), 2).alias("roas"),
    ).orderBy(F.col("revenue").desc_nulls_last())


def cohort_triangle(cohorts: DataFrame, months: Sequence[int] = (0, 1, 2, 3, 6)) -> DataFrame:
    """Retention of each cohort in selected months; cells without activity are NULL."""
    wide = (
        cohorts.groupBy("cohort_label", "cohort_size")
        .pivot("months_since_signup", list(months))
        .agg(F.max("retention_rate"))
    )
    cells = [round_half_away(F.col(str(m)), 2).alias(f"m{m}") for m in months]
    return wide.select("cohort_label", "cohort_size", *cells).orderBy("cohort_label")


def plan_economics(subs: DataFrame) -> DataFrame:
    tenure = F.try_divide(F.sum("months_active").cast("double"), F.count("months_active"))
    active = F.when(F.col("is_active"), F.col("mrr")).otherwise(F.lit(0.0))
    return (
        subs.groupBy("plan")
        .agg(
            F.count(F.lit(1)).alias("subscriptions"),
            round_half_away(share_of(F.col("is_active")) * F.lit(100.0), 1).alias("pct_active"),
            round_half_away(share_of(F.col("is_churned")) * F.lit(100.0), 1).alias("pct_churned"),
            round_half_away(tenure, 1).alias("avg_tenure_months"),
            round_half_away(exact_sum(active)).alias("active_mrr"),
        )
        .orderBy(F.col("active_mrr").desc_nulls_last())
    )


def regional_scorecard(customers: DataFrame) -> DataFrame:
    """Customers, revenue, average value and subscription share per region.

    ``avg_ltv`` and ``pct_with_active_sub`` are averages over the customer-order
    pairs, so a customer counts once per order (once if without orders). The pairs
    are never formed: a customer's order count is the weight. Orders are not read: the
    customer dimension (``lifetime_orders``, ``lifetime_revenue``) carries what is needed.
    """
    weight = F.greatest("lifetime_orders", F.lit(1).cast("bigint"))
    value = F.col("lifetime_revenue").cast("decimal(24,10)") * weight.cast("decimal(13,0)")
    active = F.when(F.col("has_active_sub"), weight).otherwise(F.lit(0).cast("bigint"))
    return (
        customers.groupBy("region")
        .agg(
            F.count("customer_id").alias("customers"),
            round_half_away(from_units(F.sum(F.when(F.col("lifetime_orders") > 0, exact_units(F.col("lifetime_revenue")))))).alias("revenue"),
            round_half_away(ratio_or_null(from_units(F.sum(value)), F.sum(weight))).alias("avg_ltv"),
            round_half_away(percent(F.sum(active), F.sum(weight)), 1).alias("pct_with_active_sub"),
        )
        .orderBy(F.col("revenue").desc_nulls_last())
    )


def _count_mean(name: str) -> Column:
    return F.try_divide(F.sum(name).cast("double"), F.count(name))


def tier_engagement(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("value_tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            round_half_away(_count_mean("lifetime_events"), 0).alias("avg_events"),
            round_half_away(_count_mean("lifetime_orders"), 1).alias("avg_orders"),
            round_half_away(_count_mean("tenure_months"), 1).alias("avg_tenure_months"),
            round_half_away(_count_mean("recency_days"), 0).alias("avg_recency_days"),
        )
        .orderBy(F.col("avg_events").desc_nulls_last())
    )


def prior_month(monthly: DataFrame, value: str) -> DataFrame:
    """Each month with the value of the calendar month before it, NULL if that is missing."""
    before = monthly.select(F.add_months("month", 1).alias("month"), F.col(value).alias(f"{value}_pm"))
    return monthly.select("month", value).join(before, "month", "left")


def year_to_date(monthly: DataFrame, value: str) -> DataFrame:
    """Running total of a money column within the calendar year."""
    w = Window.partitionBy(F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    total = from_units(F.sum(exact_units(F.col(value))).over(w))
    return monthly.select("month", value, total.alias(f"{value}_ytd"))

