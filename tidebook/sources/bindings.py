"""The driver's TPC-H-like tables presented as the six raw extracts.

Each function returns a raw-shaped frame; the staging operators then treat it as
they would a landed file. All rows of the base tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import month_gap, month_start
from tidebook.sources.readers import flatten

# Fixed values of the data domain.
CHANNELS = ["Paid Search", "Paid Social", "Organic", "Referral", "Email", "Affiliate", "Direct"]
PAID_CHANNELS = ["Paid Search", "Paid Social", "Referral", "Email", "Affiliate"]
PLAN_BY_MARKET = {
    "AUTOMOBILE": "Free",
    "BUILDING": "Starter",
    "FURNITURE": "Pro",
    "HOUSEHOLD": "Business",
    "MACHINERY": "Enterprise",
}
PLAN_PRICE = {"Free": 0.0, "Starter": 49.0, "Pro": 149.0, "Business": 499.0, "Enterprise": 1499.0}
STATUS_BY_CODE = {"F": "completed", "P": "refunded", "O": "pending"}
DEVICES = ["desktop", "mobile", "tablet"]
LANDING_PAGES = ["/", "/pricing", "/features", "/blog", "/demo", "/signup"]
PLATFORMS = ["web", "ios", "android", "api"]
FEATURES = ["dashboard", "reports", "exports", "billing", "integrations", "admin", "search"]
FIRST_DAY = "1995-01-01"
DAY_SPAN = 2404


# The base tables' columns. Stating them saves a footer-reading job per table.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _at(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _lookup(mapping: dict, key: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.to_date("o_orderdate")).alias("signup_date"))
    )
    key = F.col("c_custkey")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first_order, "c_custkey", "left")
        .select(
            key.alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.when(key % 67 == 0, F.lit(""))
            .otherwise(F.concat(F.lower("c_name"), F.lit("@example.com")))
            .alias("email"),
            "signup_date",
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            _at(CHANNELS, key % 7).alias("acquisition_channel"),
            _lookup(PLAN_BY_MARKET, F.col("c_mktsegment")).alias("plan"),
            F.floor(F.col("c_acctbal") / 10).cast("int").alias("company_size"),
            F.col("c_mktsegment").alias("industry"),
            F.when(key % 8 == 0, 1).otherwise(0).alias("is_high_value_seed"),
        )
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dropped by the optimizer wherever num_items is not read.
    items = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("num_items"))
    )
    return (
        table(spark, sf_dir, "orders")
        .join(items, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_totalprice").alias("gross_amount"),
            F.lit(0.0).alias("discount_pct"),
            F.col("o_totalprice").alias("net_amount"),
            F.coalesce(F.col("num_items"), F.lit(0)).alias("num_items"),
            F.col("o_orderpriority").alias("channel"),
            _lookup(STATUS_BY_CODE, F.col("o_orderstatus")).alias("status"),
        )
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription per ordering customer, churned 90 days after the last order."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"))
    span = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("d").alias("start_date"), F.date_add(F.max("d"), 90).alias("lapse")
    )
    last_day = orders.agg(F.max("d").alias("last_day"))
    key = F.col("c_custkey")
    churn = F.when(F.col("lapse") <= F.col("last_day"), F.col("lapse"))
    plan = _lookup(PLAN_BY_MARKET, F.col("c_mktsegment"))
    return (
        table(spark, sf_dir, "customer")
        .join(span, "c_custkey")
        .crossJoin(F.broadcast(last_day))  # one row
        .select(
            (key + 700000).alias("subscription_id"),
            key.alias("customer_id"),
            plan.alias("plan"),
            _lookup(PLAN_PRICE, plan).alias("mrr"),
            "start_date",
            F.when(churn.isNotNull(), "churned").when(key % 33 == 0, "paused").otherwise("active").alias("status"),
            churn.alias("churn_date"),
            month_gap(F.col("start_date"), F.coalesce(churn, F.col("last_day"))).alias("months_active"),
            F.when(key % 10 < 7, "monthly").otherwise("annual").alias("billing_interval"),
        )
    )


def _event_day() -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), ((F.col("event_id") * 37) % DAY_SPAN).cast("int"))


def _event_moment() -> Column:
    """The bound day with the time of day of the base row."""
    ts = F.col("ts").cast("timestamp_ntz")
    return _event_day().cast("timestamp_ntz") + (ts - F.to_date(ts).cast("timestamp_ntz"))


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def raw_web_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _props_k()
    bought = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("session_id"),
        _event_moment().alias("session_ts"),
        _at(CHANNELS, k % 7).alias("channel"),
        _at(DEVICES, k % 3).alias("device"),
        _at(LANDING_PAGES, k % 6).alias("landing_page"),
        (k % 13 + 1).alias("pages_viewed"),
        (k * 10).alias("duration_sec"),
        F.when(bought, 1).otherwise(0).alias("converted"),
        F.when(bought, F.col("user_id").cast("string")).otherwise(F.lit("")).alias("customer_id"),
    )


def raw_events_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their ``properties`` object, as the JSON extract has them."""
    k = _props_k()
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        "event_type",
        _event_moment().alias("event_ts"),
        F.struct(
            _at(PLATFORMS, k % 4).alias("platform"),
            F.concat(F.lit("3."), (k % 10).cast("string")).alias("app_version"),
            F.floor(F.col("value") * 60).cast("bigint").alias("session_len_sec"),
            _at(FEATURES, k % 7).alias("feature"),
        ).alias("properties"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(raw_events_nested(spark, sf_dir), "properties")


def raw_marketing_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Exact products of two-decimal numbers, summed as whole units.
    units = F.rint(F.col("l_extendedprice") * 100).cast("bigint") * F.rint(F.col("l_discount") * 100).cast("bigint")
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("region"))
    )
    # Collapse the lines to supplier x month first: the join then sees few rows
    # and no supplier, however large, is hot.
    monthly = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", month_start(F.to_date("l_shipdate")).alias("spend_date"))
        .agg(
            F.sum(units).alias("units"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("impressions"),
            F.count(F.lit(1)).alias("clicks"),
        )
    )
    return (
        monthly.join(suppliers, "l_suppkey")
        .groupBy("spend_date", _at(PAID_CHANNELS, F.col("l_suppkey") % 5).alias("channel"), "region")
        .agg(
            (F.sum("units").cast("double") / F.lit(10000.0)).alias("spend"),
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
        )
    )


RAW = {
    "customers": raw_customers,
    "orders": raw_orders,
    "subscriptions": raw_subscriptions,
    "web_sessions": raw_web_sessions,
    "marketing_spend": raw_marketing_spend,
    "events": raw_events,
}
