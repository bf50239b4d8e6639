"""Retention of signup cohorts, from any activity feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import month_gap, month_label, month_start, ratio_or_null, ratio_or_zero


def active_days(activity: DataFrame, customer: str = "customer_id", day: str = "event_date") -> DataFrame:
    """Distinct (customer, day). The duplicates go before the shuffle, so a customer
    with a third of all events still leaves at most one row per calendar day."""
    return activity.select(F.col(customer).alias("customer_id"), F.col(day).alias("active_day")).distinct()


def retained_customers(customers: DataFrame, activity: DataFrame, lo: int = 30, hi: int = 60, **columns: str) -> DataFrame:
    """Customers active at least once in ``[signup + lo, signup + hi)`` days.

    A semi-join: no per-customer regrouping, no fan-out.
    """
    days = active_days(activity, **columns).withColumnRenamed("customer_id", "_who")
    inside = (F.col("active_day") >= F.date_add("signup_date", lo)) & (F.col("active_day") < F.date_add("signup_date", hi))
    return customers.join(days, (F.col("customer_id") == F.col("_who")) & inside, "left_semi")


def retention_feeds(
    customers: DataFrame, activity: DataFrame, lo: int = 30, hi: int = 60, **columns: str
) -> list[DataFrame]:
    """Cohort size, latest signup and retained count as ``month``-keyed rows to be summed."""
    members = customers.where(F.col("signup_date").isNotNull())
    one = F.lit(1).cast("bigint")
    month = month_start(F.col("signup_date")).alias("month")
    return [
        members.select(month, one.alias("cohort_size"), F.col("signup_date").alias("last_signup")),
        retained_customers(members, activity, lo, hi, **columns).select(month, one.alias("retained_30d")),
    ]


def window_retention(
    customers: DataFrame, activity: DataFrame, lo: int = 30, hi: int = 60, day: str = "event_date"
) -> DataFrame:
    """Per signup month: cohort size, retained customers, rate, and maturity.

    A cohort is mature once every member's window has closed before the last
    activity; that is the case exactly when the latest member's has.
    """
    sizes, kept = retention_feeds(customers, activity, lo, hi, day=day)
    last_activity = activity.agg(F.max(day).alias("last_activity"))
    both = sizes.unionByName(kept, allowMissingColumns=True)
    return (
        both.groupBy("month")
        .agg(
            F.coalesce(F.sum("cohort_size"), F.lit(0)).alias("cohort_size"),
            F.coalesce(F.sum("retained_30d"), F.lit(0)).alias("retained_30d"),
            F.max("last_signup").alias("last_signup"),
        )
        .crossJoin(F.broadcast(last_activity))  # one row
        .select(
            "month",
            "cohort_size",
            "retained_30d",
            F.coalesce(F.date_add("last_signup", hi) <= F.col("last_activity"), F.lit(False)).alias("cohort_is_mature"),
            ratio_or_zero(F.col("retained_30d"), F.col("cohort_size")).alias("retention_30d"),
        )
    )


def cohort_retention(
    customers: DataFrame, activity: DataFrame, max_months: int = 12, day: str = "event_date"
) -> DataFrame:
    """Signup month x months since signup: how many of the cohort were active.

    (customer, month) pairs are made distinct before the join, so counting rows
    counts customers and no second distinct is needed.
    """
    members = customers.where(F.col("signup_date").isNotNull()).select(
        "customer_id", month_start(F.col("signup_date")).alias("cohort_month")
    )
    months = activity.select("customer_id", month_start(F.col(day)).alias("active_month")).distinct()
    gap = month_gap(F.col("cohort_month"), F.col("active_month"))
    active = (
        members.join(months, "customer_id")
        .withColumn("months_since_signup", gap)
        .where(F.col("months_since_signup").between(0, max_months))
        .groupBy("cohort_month", "months_since_signup")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    sizes = members.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return active.join(sizes, "cohort_month").select(
        "cohort_month",
        month_label(F.col("cohort_month")).alias("cohort_label"),
        "months_since_signup",
        "cohort_size",
        "active_customers",
        ratio_or_null(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
    )
