"""Typed, cleaned views of the six extracts. Casts here are the type contract."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import month_start


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def segment_band(company_size: Column) -> Column:
    """Size bands; unknown sizes count as small."""
    return F.when(company_size >= 500, "Enterprise").when(company_size >= 100, "Mid-Market").otherwise("SMB")


def recognized(status: Column, amount: Column) -> Column:
    return F.when(status == "completed", amount).otherwise(F.lit(0.0))


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("customer_id").cast("bigint"),
        F.trim("customer_name").alias("customer_name"),
        blank_to_null(F.col("email")).alias("email"),
        F.col("signup_date").cast("date"),
        "region",
        "country",
        "acquisition_channel",
        "plan",
        F.col("company_size").cast("int"),
        "industry",
        F.col("is_high_value_seed").cast("int"),
        segment_band(F.col("company_size").cast("int")).alias("segment_band"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    ts = F.col("order_ts").cast("timestamp_ntz")
    day = F.to_date(ts)
    net = F.col("net_amount").cast("double")
    status = F.col("status")
    return raw.select(
        F.col("order_id").cast("bigint"),
        F.col("customer_id").cast("bigint"),
        ts.alias("order_ts"),
        day.alias("order_date"),
        month_start(day).alias("order_month"),
        F.col("gross_amount").cast("double"),
        F.col("discount_pct").cast("double"),
        net.alias("net_amount"),
        F.col("num_items").cast("int"),
        "channel",
        "status",
        recognized(status, net).alias("recognized_revenue"),
        (status == "completed").alias("is_recognized"),
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    status = F.col("status")
    return raw.select(
        F.col("subscription_id").cast("bigint"),
        F.col("customer_id").cast("bigint"),
        "plan",
        F.col("mrr").cast("double"),
        F.col("start_date").cast("date"),
        "status",
        # Blank or unreadable churn dates mean "not churned", not a failed load.
        F.col("churn_date").try_cast("date").alias("churn_date"),
        F.col("months_active").cast("int"),
        "billing_interval",
        (status == "churned").alias("is_churned"),
        (status == "active").alias("is_active"),
    )


def stg_web_sessions(raw: DataFrame) -> DataFrame:
    ts = F.col("session_ts").cast("timestamp_ntz")
    day = F.to_date(ts)
    return raw.select(
        "session_id",
        ts.alias("session_ts"),
        day.alias("session_date"),
        month_start(day).alias("session_month"),
        "channel",
        "device",
        "landing_page",
        F.col("pages_viewed").cast("int"),
        F.col("duration_sec").cast("int"),
        F.col("converted").cast("int"),
        blank_to_null(F.col("customer_id").cast("string")).cast("bigint").alias("customer_id"),
    )


def stg_marketing_spend(raw: DataFrame) -> DataFrame:
    day = F.col("spend_date").cast("date")
    return raw.select(
        day.alias("spend_date"),
        month_start(day).alias("spend_month"),
        "channel",
        "region",
        F.col("spend").cast("double"),
        F.col("impressions").cast("bigint"),
        F.col("clicks").cast("bigint"),
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """``raw`` is already flattened (:func:`tidebook.sources.flatten`)."""
    ts = F.col("event_ts").cast("timestamp_ntz")
    return raw.select(
        F.col("event_id").cast("bigint"),
        F.col("customer_id").cast("bigint"),
        "event_type",
        ts.alias("event_ts"),
        F.to_date(ts).alias("event_date"),
        "platform",
        "app_version",
        F.col("session_len_sec").cast("bigint"),
        "feature",
    )


STAGING = {
    "customers": stg_customers,
    "orders": stg_orders,
    "subscriptions": stg_subscriptions,
    "web_sessions": stg_web_sessions,
    "marketing_spend": stg_marketing_spend,
    "events": stg_events,
}


class Staged:
    """The six staged frames, the input of every mart. Each is built when first used."""

    def __init__(self, frame_of: Callable[[str], DataFrame]):
        self._frame_of = frame_of

    @classmethod
    def from_raw(cls, raw: Mapping[str, DataFrame]) -> Staged:
        return cls(lambda name: STAGING[name](raw[name]))

    @cached_property
    def customers(self) -> DataFrame:
        return self._frame_of("customers")

    @cached_property
    def orders(self) -> DataFrame:
        return self._frame_of("orders")

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self._frame_of("subscriptions")

    @cached_property
    def web_sessions(self) -> DataFrame:
        return self._frame_of("web_sessions")

    @cached_property
    def marketing_spend(self) -> DataFrame:
        return self._frame_of("marketing_spend")

    @cached_property
    def events(self) -> DataFrame:
        return self._frame_of("events")

    @cached_property
    def by_name(self) -> dict[str, DataFrame]:
        return {f"stg_{name}": getattr(self, name) for name in STAGING}
