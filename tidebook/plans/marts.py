"""The eight marts: two dimensions, two facts, two KPI tables, segments, cohorts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import (
    calendar_columns,
    day_gap,
    exact_units,
    no_units,
    first_month_after,
    first_month_from,
    from_units,
    month_label,
    month_start,
    ratio_or_null,
    ratio_or_zero,
)
from tidebook.operators.intervals import usable_interval
from tidebook.operators.ranking import ROWS_PER_RANGE, Ordering, distributed_ntile
from tidebook.operators.retention import retention_feeds
from tidebook.plans.rollup import HAS_ORDER, HAS_SESSION, lay_spine, mark, roll_up, stack
from tidebook.session import settle_counted

CUSTOMER_ATTRIBUTES = ("region", "plan", "segment_band", "acquisition_channel")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _flag(condition: Column) -> Column:
    """1 / 0 to be summed; 0 when the condition is NULL."""
    return F.when(condition, 1).otherwise(0).cast("bigint")


# --- dimensions and facts -----------------------------------------------------


def customer_rollup(orders: DataFrame, subscriptions: DataFrame, events: DataFrame) -> DataFrame:
    """Per customer: order, subscription and engagement totals, from one shuffle.

    The three feeds are stacked and grouped once. Map-side aggregation folds a hot
    customer's rows to one per task before anything moves.
    """
    done = F.col("is_recognized")
    feeds = [
        orders.select(
            "customer_id",
            _one().alias("lifetime_orders"),
            exact_units(F.col("recognized_revenue")).alias("revenue_units"),
            F.when(done, exact_units(F.col("net_amount"))).alias("recognized_units"),
            F.when(done & F.col("net_amount").isNotNull(), 1).cast("bigint").alias("recognized_orders"),
            F.col("order_date").alias("first_order_date"),
            F.col("order_date").alias("last_order_date"),
        ),
        subscriptions.select(
            "customer_id",
            "mrr",
            F.col("is_active").alias("has_active_sub"),
            F.col("is_churned").alias("has_churned"),
            F.col("months_active").alias("tenure_months"),
        ),
        events.select("customer_id", _one().alias("lifetime_events")),
    ]
    return (
        stack(feeds)
        .groupBy("customer_id")
        .agg(
            F.sum("lifetime_orders").alias("lifetime_orders"),
            from_units(F.sum("revenue_units")).alias("lifetime_revenue"),
            F.try_divide(from_units(F.sum("recognized_units")), F.sum("recognized_orders")).alias("avg_order_value"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
            F.max("mrr").alias("mrr"),
            F.bool_or("has_active_sub").alias("has_active_sub"),
            F.bool_or("has_churned").alias("has_churned"),
            F.max("tenure_months").alias("tenure_months"),
            F.sum("lifetime_events").alias("lifetime_events"),
        )
    )


def dim_customers(
    customers: DataFrame, orders: DataFrame, subscriptions: DataFrame, events: DataFrame
) -> DataFrame:
    last_order = orders.agg(F.max("order_date").alias("_last_order"))
    zero = F.lit(0)

    def or_zero(name: str, kind: str) -> Column:
        return F.coalesce(F.col(name), zero.cast(kind)).alias(name)

    return (
        customers.join(customer_rollup(orders, subscriptions, events), "customer_id", "left")
        .crossJoin(F.broadcast(last_order))  # one row
        .select(
            "customer_id",
            "customer_name",
            "email",
            "signup_date",
            "region",
            "country",
            "acquisition_channel",
            "plan",
            "company_size",
            "segment_band",
            "industry",
            "is_high_value_seed",
            or_zero("lifetime_orders", "bigint"),
            or_zero("lifetime_revenue", "double"),
            or_zero("avg_order_value", "double"),
            "first_order_date",
            "last_order_date",
            or_zero("mrr", "double"),
            F.coalesce("has_active_sub", F.lit(False)).alias("has_active_sub"),
            F.coalesce("has_churned", F.lit(False)).alias("has_churned"),
            or_zero("tenure_months", "int"),
            or_zero("lifetime_events", "bigint"),
            # NULL for customers who never ordered.
            day_gap(F.col("last_order_date"), F.col("_last_order")).alias("recency_days"),
        )
    )


def fct_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the customer's conformed attributes.

    A plain left join: the optimizer broadcasts a small customer table by its
    measured size, and otherwise shuffles on the key, where AQE splits the
    partition of a customer that holds an outsized share of the orders.
    """
    attributes = customers.select("customer_id", *CUSTOMER_ATTRIBUTES)
    return orders.join(attributes, "customer_id", "left").select(
        "order_id",
        "customer_id",
        "order_ts",
        "order_date",
        "order_month",
        *CUSTOMER_ATTRIBUTES,
        F.col("channel").alias("order_channel"),
        "gross_amount",
        "discount_pct",
        "net_amount",
        "recognized_revenue",
        "num_items",
        "status",
        "is_recognized",
    )


def fct_subscriptions(subscriptions: DataFrame, customers: DataFrame) -> DataFrame:
    attributes = customers.select("customer_id", "region", "acquisition_channel", "segment_band")
    return subscriptions.join(attributes, "customer_id", "left").select(
        "subscription_id",
        "customer_id",
        "region",
        "acquisition_channel",
        "segment_band",
        "plan",
        "mrr",
        (F.col("mrr") * F.lit(12.0)).alias("arr"),
        "start_date",
        month_start(F.col("start_date")).alias("cohort_month"),
        "status",
        "churn_date",
        "months_active",
        "billing_interval",
        "is_churned",
        "is_active",
    )


# --- KPI tables ---------------------------------------------------------------


def _order_metrics() -> list[Column]:
    done = F.col("is_recognized")
    return [
        exact_units(F.col("recognized_revenue")).alias("revenue_units"),
        _one().alias("total_orders"),
        _flag(done).alias("completed_orders"),
        _flag(F.col("status") == "refunded").alias("refunded_orders"),
        F.when(done, exact_units(F.col("net_amount"))).alias("recognized_units"),
        F.when(done & F.col("net_amount").isNotNull(), 1).cast("bigint").alias("recognized_orders"),
    ]


def _session_metrics() -> list[Column]:
    return [_one().alias("sessions"), F.col("converted").cast("bigint").alias("conversions")]


def _counted(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def _average_order() -> Column:
    mean = F.try_divide(from_units(F.col("recognized_units")), F.col("recognized_orders"))
    return F.coalesce(mean, F.lit(0.0)).alias("avg_order_value")


def _revenue_or_null() -> Column:
    return from_units(F.col("revenue_units"))


def kpi_daily(orders: DataFrame, customers: DataFrame, sessions: DataFrame, events: DataFrame) -> DataFrame:
    """One row per calendar day. Calendar fields are functions of the day itself, so
    the days need no join back to the date dimension."""
    feeds = [
        orders.select(
            F.col("order_date").alias("date_key"), mark(HAS_ORDER), F.col("customer_id").alias("_buyer"), *_order_metrics()
        ),
        customers.select(F.col("signup_date").alias("date_key"), _one().alias("new_customers")),
        sessions.select(F.col("session_date").alias("date_key"), mark(HAS_SESSION), *_session_metrics()),
        events.select(F.col("event_date").alias("date_key"), _one().alias("product_events")),
    ]
    buyers = F.countDistinct("_buyer").alias("ordering_customers")
    either = F.col(HAS_ORDER) | F.col(HAS_SESSION)
    rolled = lay_spine(roll_up(feeds, "date_key", extra=[buyers]), "date_key", "day", either, either)
    fields = {f"c{i}": c for i, c in enumerate(calendar_columns(F.col("date_key")))}
    year, quarter, month_name, day_name, weekend = (fields[f"c{i}"] for i in (1, 2, 4, 8, 9))
    return rolled.select(
        "date_key",
        year,
        quarter,
        month_name,
        day_name,
        weekend,
        F.coalesce(_revenue_or_null(), F.lit(0.0)).alias("recognized_revenue"),
        _counted("total_orders"),
        _counted("completed_orders"),
        _counted("refunded_orders"),
        _counted("ordering_customers"),
        _average_order(),
        _counted("new_customers"),
        _counted("sessions"),
        _counted("conversions"),
        ratio_or_zero(F.col("conversions"), F.col("sessions")).alias("conversion_rate"),
        _counted("product_events"),
    )


def subscription_feed(subscriptions: DataFrame) -> DataFrame:
    """Monthly changes that add up to the active base, MRR and churn.

    A month is represented by its first day m. "Active at start" means
    ``start < m <= churn``: in from the first month after the start, out from the
    first month after churn. "Active" (and MRR) means ``start <= m < churn``. The
    status column is not consulted, so a paused subscription counts.
    """
    start, end = F.col("start_date"), F.col("churn_date")
    usable = usable_interval(start, end)
    units = F.coalesce(exact_units(F.col("mrr")), no_units())
    none = F.lit(0).cast("bigint")
    one = _one()

    def change(month: Column, at_start: Column, active: Column, mrr: Column, churned: Column) -> Column:
        return F.struct(
            month.alias("month"),
            at_start.alias("at_start_change"),
            active.alias("active_change"),
            mrr.alias("mrr_change"),
            churned.alias("churned_customers"),
        )

    opened = F.when(usable, first_month_after(start)), F.when(usable, first_month_from(start))
    closed = F.when(usable, first_month_after(end)), F.when(usable, first_month_from(end))
    changes = F.array(
        change(opened[0], one, none, no_units(), none),
        change(opened[1], none, one, units, none),
        change(closed[0], -one, none, no_units(), none),
        change(closed[1], none, -one, -units, none),
        change(month_start(end), none, none, no_units(), one),
    )
    return (
        subscriptions.select(F.explode(changes).alias("c"))
        .select("c.*")
        .where(F.col("month").isNotNull())
    )


#: Metric groups of :func:`kpi_monthly`; a caller may ask for a few only.
KPI_GROUPS = ("revenue", "signups", "subscriptions", "spend", "sessions", "retention")


def kpi_monthly(
    orders: DataFrame,
    customers: DataFrame | None,
    subscriptions: DataFrame | None,
    spend: DataFrame | None,
    sessions: DataFrame,
    events: DataFrame | None,
    groups: Iterable[str] = KPI_GROUPS,
) -> DataFrame:
    """The executive table: one row per month of the date range.

    Feeds of ``groups`` not asked for are left out of the plan, and so are the
    columns that need them; their inputs may be None.
    """
    groups = set(groups)
    # Orders and sessions always take part: their dates span the calendar.
    order_month, session_month = F.col("order_month").alias("month"), F.col("session_month").alias("month")
    feeds = [
        orders.select(order_month, mark(HAS_ORDER), *(_order_metrics() if "revenue" in groups else [])),
        sessions.select(session_month, mark(HAS_SESSION), *(_session_metrics() if "sessions" in groups else [])),
    ]
    running, overall = {}, []
    if "signups" in groups:
        feeds.append(
            customers.select(month_start(F.col("signup_date")).alias("month"), _one().alias("new_customers"))
        )
    if "subscriptions" in groups:
        feeds.append(subscription_feed(subscriptions))
        running = {
            "at_start_change": "active_at_start",
            "active_change": "active_customers",
            "mrr_change": "mrr_units",
        }
    if "spend" in groups:
        feeds.append(spend.select(F.col("spend_month").alias("month"), exact_units(F.col("spend")).alias("spend_units")))
    if "retention" in groups:
        feeds.extend(retention_feeds(customers, events))
        no_month = F.lit(None).cast("date").alias("month")
        feeds.append(events.select(no_month, F.col("event_date").alias("last_event")))
        overall = ["last_event"]
    rolled = lay_spine(
        roll_up(feeds, "month", latest=("last_signup", "last_event")),
        "month",
        "month",
        first=F.col(HAS_ORDER) | F.col(HAS_SESSION),
        last=F.col(HAS_ORDER),
        running=running,
        overall_latest=overall,
    )

    def arpa() -> Column:
        return ratio_or_zero(_revenue_or_null(), F.col("active_customers"))

    def churn() -> Column:
        return ratio_or_zero(F.coalesce("churned_customers", F.lit(0)), F.col("active_at_start"))

    def ltv() -> Column:
        known = [F.col(c) > 0 for c in ("active_customers", "active_at_start", "churned_customers")]
        return F.when(known[0] & known[1] & known[2], F.try_divide(arpa(), churn())).otherwise(F.lit(0.0))

    def refunds() -> Column:
        return ratio_or_zero(F.col("refunded_orders"), F.col("completed_orders") + F.col("refunded_orders"))

    def mature() -> Column:
        return F.coalesce(F.date_add("last_signup", 60) <= F.col("last_event"), F.lit(False))

    paid = lambda: from_units(F.col("spend_units"))
    # (groups needed, column name, how to make it), in output order.
    columns: list[tuple[str, str, Callable[[], Column]]] = [
        ("", "month", lambda: F.col("month")),
        ("", "year", lambda: F.year("month")),
        ("", "month_label", lambda: month_label(F.col("month"))),
        ("revenue", "recognized_revenue", lambda: F.coalesce(_revenue_or_null(), F.lit(0.0))),
        ("revenue", "completed_orders", lambda: _counted("completed_orders")),
        ("revenue", "refunded_orders", lambda: _counted("refunded_orders")),
        ("revenue", "refund_rate", refunds),
        ("revenue", "avg_order_value", _average_order),
        ("signups", "new_customers", lambda: _counted("new_customers")),
        ("subscriptions", "active_mrr", lambda: from_units(F.col("mrr_units"))),
        ("subscriptions", "active_customers", lambda: F.col("active_customers")),
        ("revenue subscriptions", "arpa", arpa),
        ("subscriptions", "churned_customers", lambda: _counted("churned_customers")),
        ("subscriptions", "active_at_start", lambda: F.col("active_at_start")),
        ("subscriptions", "churn_rate", churn),
        ("spend", "marketing_spend", lambda: F.coalesce(paid(), F.lit(0.0))),
        ("spend signups", "cac", lambda: ratio_or_zero(paid(), F.col("new_customers"))),
        ("revenue subscriptions", "ltv", ltv),
        ("sessions", "sessions", lambda: _counted("sessions")),
        ("sessions", "conversions", lambda: _counted("conversions")),
        ("sessions", "conversion_rate", lambda: ratio_or_zero(F.col("conversions"), F.col("sessions"))),
        ("retention", "cohort_size", lambda: _counted("cohort_size")),
        ("retention", "retained_30d", lambda: _counted("retained_30d")),
        ("retention", "cohort_is_mature", mature),
        (
            "retention",
            "retention_30d",
            lambda: ratio_or_zero(F.coalesce("retained_30d", F.lit(0)), F.col("cohort_size")),
        ),
    ]
    return rolled.select(*[make().alias(name) for needs, name, make in columns if groups.issuperset(needs.split())])


# --- segments -----------------------------------------------------------------


def value_tier(tile: Column, tiles: int = 10) -> Column:
    """The top two tenths, the next three, the next three, and the rest; in whole tiles."""
    from_tile = lambda tenths: tiles * tenths // 10 + 1
    return (
        F.when(tile >= from_tile(8), "High-Value")
        .when(tile >= from_tile(5), "Core")
        .when(tile >= from_tile(2), "Occasional")
        .otherwise("Dormant")
    )


def priority_totals(customers: DataFrame) -> DataFrame:
    """One row: revenue and customers in all and in the priority group, and its shares. Needs no tiles."""
    priority = F.col("is_high_value_seed") == 1
    units = exact_units(F.col("lifetime_revenue"))
    sums = customers.agg(
        from_units(F.sum(units)).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_customers"),
        from_units(F.sum(F.when(priority, units).otherwise(no_units()))).alias("priority_revenue"),
        F.sum("is_high_value_seed").alias("priority_customers"),
    )
    return sums.select(
        "*",
        ratio_or_null(F.col("priority_revenue"), F.col("total_revenue")).alias("priority_revenue_share"),
        ratio_or_null(F.col("priority_customers"), F.col("total_customers")).alias("priority_customer_share"),
    )


SEGMENT_COLUMNS = (
    "customer_id",
    "customer_name",
    "region",
    "plan",
    "segment_band",
    "acquisition_channel",
    "industry",
    "signup_date",
    "lifetime_orders",
    "lifetime_revenue",
    "avg_order_value",
    "mrr",
    "tenure_months",
    "lifetime_events",
    "recency_days",
    "has_active_sub",
    "has_churned",
)


def customer_segments(
    customers: DataFrame,
    tiles: int = 10,
    rfm: int = 5,
    null_recency: str = "best",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """RFM scores, value tiers and revenue concentration, one row per customer.

    The dimension is settled once; finding the tile boundaries, the totals per tier
    and the final rows are then scans of those files, and the final rows are a
    map-only pass with at most four broadcast rows.

    Customers who never ordered have no recency. They sort last and so get the top
    recency score (``null_recency="best"``); ``"worst"`` puts them in tile 1.
    """
    if null_recency not in ("best", "worst"):
        raise ValueError("null_recency must be 'best' or 'worst'")
    kept = customers.select(*SEGMENT_COLUMNS, "is_high_value_seed")
    base, rows = settle_counted(kept, "dim_customers")
    recency = "recency_days"
    if null_recency == "worst":
        recency = "_recency"
        base = base.withColumn(recency, F.coalesce("recency_days", F.lit(2**31 - 1)))
    scored = distributed_ntile(
        base,
        [
            ("revenue_decile", tiles, Ordering("lifetime_revenue")),
            ("r_score", rfm, Ordering(recency, descending=True)),
            ("f_score", rfm, Ordering("lifetime_orders")),
            ("m_score", rfm, Ordering("lifetime_revenue")),
        ],
        rows,
        rows_per_range,
    ).withColumn("value_tier", value_tier(F.col("revenue_decile"), tiles))

    priority = F.col("is_high_value_seed") == 1
    units = exact_units(F.col("lifetime_revenue"))
    everyone = Window.partitionBy(F.lit(1))
    tiers = (  # at most four rows
        scored.groupBy("value_tier")
        .agg(
            F.sum(units).alias("tier_units"),
            F.count(F.lit(1)).alias("tier_customers"),
            F.sum(F.when(priority, units).otherwise(no_units())).alias("p_units"),
            F.sum("is_high_value_seed").alias("p_customers"),
        )
        .select(
            "value_tier",
            "tier_units",
            "tier_customers",
            F.sum("tier_units").over(everyone).alias("all_units"),
            F.sum("tier_customers").over(everyone).alias("total_customers"),
            F.sum("p_units").over(everyone).alias("priority_units"),
            F.sum("p_customers").over(everyone).alias("priority_customers"),
        )
    )
    total = from_units(F.col("all_units"))
    people = F.col("total_customers")
    return scored.join(F.broadcast(tiers), "value_tier").select(
        *SEGMENT_COLUMNS,
        "revenue_decile",
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
        "value_tier",
        F.col("is_high_value_seed").alias("priority_segment"),
        total.alias("total_revenue"),
        "total_customers",
        ratio_or_null(F.col("lifetime_revenue"), total).alias("revenue_share"),
        ratio_or_null(from_units(F.col("tier_units")), total).alias("tier_revenue_share"),
        ratio_or_null(F.col("tier_customers"), people).alias("tier_customer_share"),
        ratio_or_null(from_units(F.col("priority_units")), total).alias("priority_revenue_share"),
        ratio_or_null(F.col("priority_customers"), people).alias("priority_customer_share"),
    )
