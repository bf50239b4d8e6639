"""Data behind the dashboard views; drawing is left to the caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import (
    exact_mean,
    exact_sum,
    exact_units,
    from_units,
    rate_mean,
    ratio_or_null,
    share_of,
)
from tidebook.operators.lookup import LookupTable
from tidebook.plans.marts import priority_totals

# Display orders.
TIER_ORDER = ["High-Value", "Core", "Occasional", "Dormant"]
PLAN_ORDER = ["Free", "Starter", "Pro", "Business", "Enterprise"]


def ordinal(values: list[str], column: Column) -> Column:
    """1-based place of a value in a display order."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), column).cast("int")


def completed(facts: DataFrame) -> DataFrame:
    return facts.where("is_recognized")


# --- revenue ------------------------------------------------------------------


def revenue_summary(facts: DataFrame) -> DataFrame:
    """Totals of a slice. The refund rate is over all orders, pending ones included."""
    done = F.col("is_recognized")
    return facts.agg(
        F.coalesce(exact_sum(F.when(done, F.col("recognized_revenue"))), F.lit(0.0)).alias("revenue"),
        F.count_if(done).alias("completed_orders"),
        F.coalesce(exact_mean(F.when(done, F.col("net_amount"))), F.lit(0.0)).alias("aov"),
        F.coalesce(share_of(F.col("status") == "refunded"), F.lit(0.0)).alias("refund_rate"),
    )


def revenue_by(facts: DataFrame, column: str) -> DataFrame:
    """Recognized revenue and order count per value of ``column``; NULL groups left out."""
    return (
        completed(facts)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(exact_sum(F.col("recognized_revenue")).alias("revenue"), F.count("order_id").alias("orders"))
    )


# --- segments -----------------------------------------------------------------


def tier_economics(segments: DataFrame) -> DataFrame:
    tiers = segments.groupBy("value_tier").agg(
        F.count("customer_id").alias("customers"), F.sum(exact_units(F.col("lifetime_revenue"))).alias("units")
    )
    everyone = Window.partitionBy(F.lit(1))  # at most four rows
    return (
        tiers.select(
            "value_tier",
            "customers",
            ratio_or_null(F.col("customers"), F.sum("customers").over(everyone)).alias("cust_share"),
            from_units(F.col("units")).alias("revenue"),
            ratio_or_null(from_units(F.col("units")), from_units(F.sum("units").over(everyone))).alias("rev_share"),
            ratio_or_null(from_units(F.col("units")), F.col("customers")).alias("avg_ltv"),
            ordinal(TIER_ORDER, F.col("value_tier")).alias("display_order"),
        )
        .orderBy("display_order")
    )


def rfm_matrix(segments: DataFrame, scores: int = 5) -> DataFrame:
    """Customers per monetary score (rows) and frequency score (columns)."""
    columns = list(range(1, scores + 1))
    wide = segments.groupBy("m_score").pivot("f_score", columns).agg(F.count(F.lit(1)))
    return wide.select("m_score", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"f{c}") for c in columns]).orderBy("m_score")


def top_customers(segments: DataFrame, n: int = 25) -> DataFrame:
    best = segments.orderBy(F.col("lifetime_revenue").desc_nulls_last(), "customer_id").limit(n)
    return best.select(
        F.col("customer_name").alias("customer"),
        "region",
        "plan",
        F.col("value_tier").alias("tier"),
        F.col("lifetime_orders").alias("orders"),
        F.col("lifetime_revenue").alias("lifetime_rev"),
        F.col("revenue_share").alias("pct_of_total"),
    )


def priority_headline(customers: DataFrame) -> DataFrame:
    return priority_totals(customers).select(
        F.col("priority_customer_share").alias("customer_share"), F.col("priority_revenue_share").alias("revenue_share")
    )


# --- retention ----------------------------------------------------------------


def retention_summary(monthly: DataFrame, subs: DataFrame) -> DataFrame:
    kpis = monthly.agg(
        F.coalesce(rate_mean(F.when(F.col("cohort_is_mature"), F.col("retention_30d"))), F.lit(0.0)).alias(
            "avg_retention_30d"
        ),
        rate_mean(F.col("churn_rate")).alias("avg_churn"),
    )
    return kpis.crossJoin(F.broadcast(subs.agg(share_of(F.col("is_active")).alias("active_share"))))  # one row each


def cohort_heatmap(cohorts: DataFrame, max_months: int = 12) -> DataFrame:
    """Cohorts as rows, months since signup as columns; no activity stays NULL."""
    months = list(range(max_months + 1))
    wide = cohorts.groupBy("cohort_label").pivot("months_since_signup", months).agg(F.max("retention_rate"))
    return wide.select("cohort_label", *[F.col(str(m)).alias(f"m{m}") for m in months]).orderBy("cohort_label")


def retention_curve(cohorts: DataFrame) -> DataFrame:
    """Unweighted mean over the cohorts that have a cell."""
    return (
        cohorts.groupBy("months_since_signup").agg(rate_mean(F.col("retention_rate")).alias("retention_rate"))
    ).orderBy("months_since_signup")


def churn_by_plan(subs: DataFrame, plans: list[str] = PLAN_ORDER) -> DataFrame:
    """Share churned per plan, in display order; a plan without subscriptions stays, as NULL."""
    order = subs.sparkSession.createDataFrame([(i + 1, p) for i, p in enumerate(plans)], "display_order int, plan string")
    rates = subs.groupBy("plan").agg(share_of(F.col("is_churned")).alias("churn_rate"))
    return F.broadcast(order).join(rates, "plan", "left").select("plan", "churn_rate", "display_order").orderBy("display_order")


# --- acquisition --------------------------------------------------------------


def conversion_by_channel(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy("channel")
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("converted").alias("conversions"))
        .withColumn("conv_rate", ratio_or_null(F.col("conversions"), F.col("sessions")))
        .orderBy(F.col("sessions").desc(), "channel")
    )


def acquisition_funnel(sessions: DataFrame, customers: DataFrame) -> DataFrame:
    """Page views, sessions, conversions and customers, each as its own row.

    The three session totals share one scan.
    """
    web = sessions.agg(
        F.coalesce(F.sum("pages_viewed"), F.lit(0)).cast("bigint").alias("views"),
        F.count(F.lit(1)).alias("sessions"),
        F.coalesce(F.sum("converted"), F.lit(0)).cast("bigint").alias("conversions"),
    )
    steps = [("Page views", 1, "views"), ("Sessions", 2, "sessions"), ("Conversions", 3, "conversions")]
    rows = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(n).alias("step"), F.col(c).alias("value")) for s, n, c in steps])
    people = customers.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("New customers").alias("stage"), F.lit(4).alias("step"), "value"
    )
    return web.select(F.explode(rows).alias("r")).select("r.*").unionByName(people).orderBy("step")


def spend_matrix(spend: DataFrame) -> DataFrame:
    return spend.groupBy("channel", "region").agg(exact_sum(F.col("spend")).alias("spend"))


def average_cac(monthly: DataFrame) -> DataFrame:
    """Mean over the months that had a CAC."""
    return monthly.agg(exact_mean(F.nullif(F.col("cac"), F.lit(0.0))).alias("avg_cac"))


# --- executive ----------------------------------------------------------------


def last_months(monthly: DataFrame, n: int = 12) -> DataFrame:
    """The newest ``n`` months as a report, oldest first."""
    recent = monthly.orderBy(F.col("month").desc()).limit(n)
    return recent.orderBy("month").select(
        F.col("month_label").alias("report_month"),
        F.col("recognized_revenue").alias("revenue"),
        F.col("active_customers").alias("active"),
        F.col("churn_rate").alias("churn"),
        "cac",
        "ltv",
        F.col("conversion_rate").alias("conversion"),
        "retention_30d",
    )


# --- drill-through ------------------------------------------------------------


def drill_through(customer_id: int, facts: DataFrame, subs: DataFrame, segments: DataFrame) -> DataFrame:
    """One line per order of a customer, with subscription, tier and value alongside.

    The id filter sits on every input, so each scan is pruned to that customer.
    """
    mine = F.col("customer_id") == F.lit(customer_id)
    return drill_lines(facts.where(mine), subs.where(mine), segments.where(mine))


def drill_lookup(customer_id: int, facts: LookupTable, subs: LookupTable, segments: LookupTable) -> DataFrame:
    """:func:`drill_through` on stored tables: a folder of each is opened, whatever the tables weigh."""
    return drill_lines(facts.of(customer_id), subs.of(customer_id), segments.of(customer_id))


def drill_lines(facts: DataFrame, subs: DataFrame, segments: DataFrame) -> DataFrame:
    """:func:`drill_through` for every customer of the inputs at once.

    Subscriptions and segments are unique per customer or nearly so; the orders are
    the side AQE may split.
    """
    plan = subs.select(
        "customer_id", "subscription_id", F.col("plan").alias("sub_plan"), F.col("status").alias("sub_status"), "mrr"
    )
    value = segments.select("customer_id", "value_tier", "lifetime_revenue")
    return (
        facts.select("customer_id", "order_id", "order_date", "status", "net_amount")
        .join(value.join(plan, "customer_id", "left"), "customer_id")
        .select(
            "customer_id",
            "order_id",
            "order_date",
            "status",
            "net_amount",
            "subscription_id",
            "sub_plan",
            "sub_status",
            "mrr",
            "value_tier",
            "lifetime_revenue",
        )
    )


def high_value_audit(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of completed revenue, and of customers, in the flagged group, from raw orders.

    Revenue is summed per customer before the semi-join.
    """
    earned = (
        completed(orders).groupBy("customer_id").agg(F.sum(exact_units(F.col("net_amount"))).alias("units"))
    )
    flagged = customers.where("is_high_value_seed = 1").select("customer_id")
    top = earned.join(flagged, "customer_id", "left_semi").agg(F.sum("units").alias("top"))
    total = earned.agg(F.sum("units").alias("total"))
    people = customers.agg(
        F.count_if(F.col("is_high_value_seed") == 1).alias("top_customers"), F.count(F.lit(1)).alias("customers")
    )
    one_row_each = [top, total, people]
    joined = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), one_row_each)
    return joined.select(
        F.coalesce(from_units(F.col("top")), F.lit(0.0)).alias("high_value_revenue"),
        F.coalesce(from_units(F.col("total")), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(ratio_or_null(from_units(F.col("top")), from_units(F.col("total"))), F.lit(0.0)).alias("revenue_share"),
        ratio_or_null(F.col("top_customers"), F.col("customers")).alias("customer_share"),
    )
