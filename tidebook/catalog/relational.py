"""P, F, J, A, W, T: projections, filters, joins, aggregates, windows and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.catalog.base import Bound, Once, add
from tidebook.catalog.oracle import money, money_avg, rate_avg
from tidebook.functions import (
    exact_mean,
    exact_sum,
    exact_units,
    from_units,
    month_start,
    rate_mean,
    ratio_or_null,
    ratio_or_zero,
    share_of,
)
from tidebook.functions.money import RATE
from tidebook.operators.incremental import apply_rows
from tidebook.operators.intervals import CLOSED_OPEN, OPEN_CLOSED, active_on_spine
from tidebook.operators.quality import relationships
from tidebook.operators.ranking import Ordering, distributed_ntile, distributed_rank, prefix_sum
from tidebook.operators.slicing import column_kinds, pivot_explore, slice_orders
from tidebook.plans import analysis, dashboard
from tidebook.plans.marts import customer_rollup, priority_totals, value_tier
from tidebook.plans.star import Star
from tidebook.session import settle

# --- projections --------------------------------------------------------------

for number, name in enumerate(
    ("customers", "orders", "subscriptions", "web_sessions", "marketing_spend", "events"), start=1
):
    add(f"p{number:02d}_stg_{name}", lambda b, n=name: getattr(b.staged, n), f"SELECT * FROM stg_{name}")

add(
    "p07_segment_band",
    lambda b: b.staged.customers.groupBy("segment_band").agg(
        F.count(F.lit(1)).alias("customers"), F.min("company_size").alias("lo"), F.max("company_size").alias("hi")
    ),
    "SELECT segment_band, count(*) AS customers, min(company_size) AS lo, max(company_size) AS hi FROM stg_customers GROUP BY 1",
)
add(
    "p08_recognized_revenue",
    lambda b: b.staged.orders.select("order_id", "status", "recognized_revenue"),
    """SELECT o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'refunded' ELSE 'pending' END
    AS status, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS recognized_revenue FROM orders""",
)
add(
    "p09_status_flags",
    lambda b: b.staged.subscriptions.select("subscription_id", "is_active", "is_churned"),
    "SELECT subscription_id, status = 'active' AS is_active, churn_date IS NOT NULL AS is_churned FROM stg_subscriptions",
)
add(
    "p10_arr",
    lambda b: b.wh.fct_subscriptions.select("subscription_id", "mrr", "arr"),
    "SELECT subscription_id, mrr, mrr * 12 AS arr FROM stg_subscriptions",
)
add(
    "p11_value_tier",
    lambda b: distributed_ntile(
        settle(b.wh.dim_customers.select("customer_id", "lifetime_revenue")),
        [("revenue_decile", 10, Ordering("lifetime_revenue"))],
    ).select("customer_id", "revenue_decile", value_tier(F.col("revenue_decile")).alias("value_tier")),
    "SELECT customer_id, revenue_decile, value_tier FROM scored",
)
add(
    "p12_rfm_score",
    lambda b: b.wh.customer_segments.select("customer_id", "rfm_score"),
    "SELECT customer_id, r_score + f_score + m_score AS rfm_score FROM scored",
)
add(
    "p13_column_subset_rename",
    lambda b: b.wh.kpis("revenue", "subscriptions").select(
        F.col("month_label").alias("report_month"), F.col("recognized_revenue").alias("revenue"), F.col("arpa").alias("per_account")
    ),
    "SELECT month_label AS report_month, recognized_revenue AS revenue, arpa AS per_account FROM kpi_monthly",
)


def column_profile(b: Bound) -> DataFrame:
    """Every mart column, which kind it is, and how many values it has."""
    df = b.wh.fct_orders
    kinds = {c: k for k, cs in column_kinds(df).items() for c in cs}
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("kind"), F.col(c).alias("n")) for c in df.columns]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


_NUMERIC = ("order_id", "customer_id", "gross_amount", "discount_pct", "net_amount", "recognized_revenue", "num_items")
_OTHER = (
    "order_ts",
    "order_date",
    "order_month",
    "region",
    "plan",
    "segment_band",
    "acquisition_channel",
    "order_channel",
    "status",
    "is_recognized",
)
add(
    "p14_numeric_vs_categorical",
    column_profile,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS kind, count({c}) AS n FROM fct_orders"
        for kind, cs in (("numeric", _NUMERIC), ("categorical", _OTHER))
        for c in cs
    ),
)
add(
    "p15_safe_ratio",
    lambda b: b.wh.dim_customers.select(
        "customer_id",
        ratio_or_null(F.col("lifetime_revenue"), F.col("lifetime_events")).alias("per_event_or_null"),
        ratio_or_zero(F.col("lifetime_revenue"), F.col("lifetime_events")).alias("per_event_or_zero"),
    ),
    """SELECT customer_id, lifetime_revenue / nullif(lifetime_events, 0) AS per_event_or_null,
    CASE lifetime_events WHEN 0 THEN 0 ELSE lifetime_revenue / lifetime_events END AS per_event_or_zero FROM dim_customers""",
)

# --- filters ------------------------------------------------------------------

add(
    "f01_equality_filter",
    lambda b: b.staged.orders.where("status = 'refunded'").select("order_id", "customer_id", "net_amount"),
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS net_amount FROM orders WHERE o_orderstatus = 'P'",
)
add(
    "f02_range_between",
    lambda b: slice_orders(b.staged.orders, first_day="1997-03-15", last_day="1998-03-15").select("order_id", "order_date"),
    """SELECT order_id, order_date FROM stg_orders WHERE order_date >= DATE '1997-03-15' AND order_date <= DATE '1998-03-15'""",
)
add(
    "f03_in_list",
    lambda b: b.staged.customers.where(F.col("plan").isin("Pro", "Business")).select("customer_id", "plan"),
    "SELECT customer_id, plan FROM stg_customers WHERE plan IN ('Business', 'Pro')",
)
add(
    "f04_scalar_subquery_compare",
    lambda b: b.staged.orders.crossJoin(
        F.broadcast(b.staged.orders.agg(month_start(F.max("order_date")).alias("open_month")))  # one row
    )
    .where("order_month < open_month")
    .select("order_id", "order_month"),
    "SELECT order_id, order_month FROM stg_orders WHERE order_month < (SELECT max(order_month) FROM stg_orders)",
)
add(
    "f05_validity_predicate",
    lambda b: b.staged.subscriptions.where(
        (F.col("start_date") < "1999-01-01") & (F.col("churn_date").isNull() | (F.col("churn_date") >= "1999-01-01"))
    ).select("subscription_id", "start_date", "churn_date"),
    """SELECT subscription_id, start_date, churn_date FROM stg_subscriptions
    WHERE start_date < DATE '1999-01-01' AND NOT coalesce(churn_date < DATE '1999-01-01', false)""",
)
add(
    "f06_temporal_lower_bound",
    lambda b: b.staged.customers.select("customer_id", month_start(F.col("signup_date")).alias("cohort_month"))
    .join(
        b.staged.events.select("customer_id", month_start(F.col("event_date")).alias("active_month")).distinct(), "customer_id"
    )
    .where("active_month >= cohort_month"),
    """SELECT DISTINCT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month,
    CAST(date_trunc('month', event_date) AS DATE) AS active_month FROM stg_customers JOIN stg_events USING (customer_id)
    WHERE datediff('month', signup_date, event_date) >= 0""",
)
_SLICE = dict(
    regions=["ASIA", "EUROPE"],
    plans=["Pro", "Business", "Enterprise"],
    channels=["Organic", "Email", "Direct"],
    first_day="1996-01-10",
    last_day="2000-06-30",
)
_SLICE_SQL = """region IN ('ASIA', 'EUROPE') AND plan IN ('Pro', 'Business', 'Enterprise')
    AND acquisition_channel IN ('Organic', 'Email', 'Direct')
    AND order_date BETWEEN DATE '1996-01-10' AND DATE '2000-06-30'"""
add(
    "f07_global_slice",
    lambda b: slice_orders(b.wh.fct_orders, **_SLICE).select("order_id", "region", "plan", "acquisition_channel", "order_date"),
    f"SELECT order_id, region, plan, acquisition_channel, order_date FROM fct_orders WHERE {_SLICE_SQL}",
)
add(
    "f08_complete_months",
    lambda b: analysis.complete_months(b.wh.kpis("revenue"), b.staged.orders),
    """SELECT month, year, month_label, recognized_revenue, completed_orders, refunded_orders, refund_rate, avg_order_value
    FROM kpi_monthly WHERE month < (SELECT date_trunc('month', last_order_day) FROM span)""",
)
add(
    "f09_mature_cohorts",
    lambda b: b.wh.kpis("retention").where("cohort_is_mature").select("month", "cohort_size", "retention_30d"),
    "SELECT month, cohort_size, retention_30d FROM kpi_monthly WHERE cohort_is_mature",
)

# --- joins --------------------------------------------------------------------

add(
    "j01_inner_equi_join",
    lambda b: b.staged.subscriptions.join(b.staged.customers.select("customer_id", "region"), "customer_id").select(
        "subscription_id", "region", "mrr"
    ),
    "SELECT subscription_id, region, mrr FROM stg_subscriptions JOIN stg_customers USING (customer_id)",
)
add(
    "j02_left_join_preaggregated",
    lambda b: b.staged.customers.select("customer_id")
    .join(customer_rollup(b.staged.orders, b.staged.subscriptions, b.staged.events), "customer_id", "left")
    .select("customer_id", "lifetime_orders", "lifetime_revenue", "mrr", "tenure_months", "lifetime_events"),
    f"""SELECT customer_id, n AS lifetime_orders, rev AS lifetime_revenue, s.mrr, s.months_active AS tenure_months,
    m AS lifetime_events FROM stg_customers
    LEFT JOIN (SELECT customer_id, count(*) AS n, {money("recognized_revenue")} AS rev FROM stg_orders GROUP BY 1) USING (customer_id)
    LEFT JOIN stg_subscriptions s USING (customer_id)
    LEFT JOIN (SELECT customer_id, count(*) AS m FROM stg_events GROUP BY 1) USING (customer_id)""",
)
add(
    "j03_left_join_using",
    lambda b: b.wh.fct_orders.select("order_id", "customer_id", "region", "segment_band"),
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, region, segment_band FROM orders
    LEFT JOIN stg_customers ON customer_id = o_custkey""",
)
add("j04_spine_star_join", lambda b: b.wh.kpis("revenue", "signups", "spend", "sessions"),
    """SELECT month, year, month_label, recognized_revenue, completed_orders, refunded_orders, refund_rate, avg_order_value,
    new_customers, marketing_spend, cac, sessions, conversions, conversion_rate FROM kpi_monthly""")
add(
    "j05_left_join_then_group",
    lambda b: b.staged.customers.select("customer_id")
    .join(
        b.staged.events.groupBy("customer_id", "event_date").agg(F.max("session_len_sec").alias("longest")),
        "customer_id",
        "left",
    )
    .groupBy("customer_id")
    .agg(
        F.max(F.when(F.col("event_date") >= "1998-01-01", 1).otherwise(0)).alias("seen_late"),
        F.max("longest").alias("longest_session"),
    ),
    """SELECT c.customer_id, CAST(coalesce(bool_or(event_date >= DATE '1998-01-01'), false) AS INTEGER) AS seen_late,
    max(session_len_sec) AS longest_session
    FROM stg_customers c LEFT JOIN stg_events e ON e.customer_id = c.customer_id GROUP BY 1""",
)


def interval_overlap(b: Bound) -> DataFrame:
    spine = b.wh.kpis("sessions").select("month")
    subs = settle(b.staged.subscriptions.select("start_date", "churn_date", "mrr"))
    args = (spine, subs, "start_date", "churn_date")
    at_start = active_on_spine(*args, bounds=OPEN_CLOSED).withColumnRenamed("active", "active_at_start")
    active = active_on_spine(*args, bounds=CLOSED_OPEN).withColumnRenamed("active", "active_customers")
    mrr = active_on_spine(*args, weight="mrr", bounds=CLOSED_OPEN).withColumnRenamed("active", "active_mrr")
    return at_start.join(active, "month").join(mrr, "month")


add(
    "j06_interval_overlap_join",
    interval_overlap,
    f"""SELECT month, count(*) FILTER (WHERE start_date < month AND (churn_date IS NULL OR month <= churn_date)) AS active_at_start,
    count(*) FILTER (WHERE live) AS active_customers,
    coalesce({money("CASE WHEN live THEN mrr END")}, 0) AS active_mrr
    FROM (SELECT *, start_date <= month AND (churn_date IS NULL OR month < churn_date) AS live FROM months, stg_subscriptions)
    GROUP BY month""",
)
add(
    "j07_cross_join_one_row",
    lambda b: b.wh.kpi_daily.agg(exact_sum(F.col("recognized_revenue")).alias("daily_rev")).crossJoin(
        b.staged.orders.agg(exact_sum(F.col("recognized_revenue")).alias("order_rev"))
    ),
    f"SELECT {money('recognized_revenue')} AS daily_rev, {money('recognized_revenue')} AS order_rev FROM stg_orders",
)
add(
    "j08_anti_join",
    lambda b: relationships(b.staged.customers, "customer_id", b.staged.events, "customer_id"),
    """SELECT c_custkey AS orphan_key, CAST(1 AS BIGINT) AS child_rows FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
add(
    "j09_semi_join",
    # Summed first: a customer with a third of all orders is one row per task before the join.
    lambda b: b.staged.orders.where("is_recognized")
    .groupBy("customer_id")
    .agg(exact_sum(F.col("net_amount")).alias("revenue"))
    .join(b.staged.customers.where("is_high_value_seed = 1").select("customer_id"), "customer_id", "left_semi"),
    f"""SELECT o_custkey AS customer_id, {money("o_totalprice")} AS revenue FROM orders
    WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 8 = 0) GROUP BY 1""",
)
add(
    "j10_dimension_fact_distinct",
    lambda b: b.wh.dim_customers.select("customer_id", "region")
    .join(b.staged.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")), "customer_id", "left")
    .groupBy("region")
    .agg(F.count("customer_id").alias("customers"), F.sum(F.coalesce("n", F.lit(1))).alias("pair_rows")),
    """SELECT region, count(DISTINCT c.customer_id) AS customers, count(*) AS pair_rows
    FROM stg_customers c LEFT JOIN stg_orders o ON o.customer_id = c.customer_id GROUP BY region""",
)


def upsert(b: Bound) -> DataFrame:
    """Refunds are re-stated with half the amount: deleted and inserted by key."""
    facts = b.staged.orders.select("order_id", "status", "net_amount")
    restated = facts.where("status = 'refunded'").withColumn("net_amount", F.col("net_amount") / 2)
    return apply_rows(facts, restated, "order_id")


add(
    "j11_upsert_join",
    upsert,
    """SELECT order_id, status, CASE status WHEN 'refunded' THEN net_amount / 2 ELSE net_amount END AS net_amount
    FROM stg_orders""",
)
add(
    "j12_star_relationships",
    lambda b: b.wh.fct_orders.select("order_id", "customer_id", F.col("order_date").alias("date_key"), "net_amount")
    .join(b.wh.dim_date.select("date_key", "day_name", "is_weekend"), "date_key", "left")
    .groupBy("day_name", "is_weekend")
    .agg(F.count(F.lit(1)).alias("orders"), exact_sum(F.col("net_amount")).alias("net")),
    f"""SELECT dayname(o_orderdate) AS day_name, dayofweek(o_orderdate) IN (0, 6) AS is_weekend, count(*) AS orders,
    {money("o_totalprice")} AS net FROM orders GROUP BY ALL""",
)

def star(b: Bound) -> Star:
    """The model over the marts; a mart is planned when a question needs it."""
    return Star(Once(lambda name: getattr(b.wh, name)))


add(
    "j12_date_filters_orders",
    lambda b: star(b).aggregate(
        "fct_orders",
        {"orders": F.count(F.lit(1)), "net": exact_sum(F.col("net_amount"))},
        ["dim_date.month_start", "status"],
        {"dim_date": "NOT is_weekend AND quarter = 2"},
    ),
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, status, count(*) AS orders, {money("net_amount")} AS net
    FROM stg_orders WHERE dayofweek(order_date) BETWEEN 1 AND 5 AND quarter(order_date) = 2 GROUP BY ALL""",
)
add(
    "j12_date_filters_daily_kpis",
    lambda b: star(b).aggregate(
        "kpi_daily",
        {"sessions": F.sum("sessions"), "revenue": exact_sum(F.col("recognized_revenue"))},
        ["dim_date.week_num"],
        {"dim_date": "day_of_week = 1"},
    ),
    f"""SELECT CAST(weekofyear(date_key) AS INTEGER) AS week_num, CAST(sum(sessions) AS BIGINT) AS sessions,
    {money("recognized_revenue")} AS revenue FROM kpi_daily WHERE dayofweek(date_key) = 1 GROUP BY ALL""",
)
add(
    "j12_customer_filters_orders",
    lambda b: star(b).aggregate(
        "fct_orders",
        {"orders": F.count(F.lit(1)), "revenue": exact_sum(F.col("recognized_revenue"))},
        ["dim_customers.industry"],
        {"dim_customers": "company_size >= 500 AND lifetime_orders > 3", "dim_date": "is_weekend"},
    ),
    f"""SELECT industry, count(*) AS orders, {money("recognized_revenue")} AS revenue
    FROM stg_orders JOIN dim_customers USING (customer_id)
    WHERE company_size >= 500 AND lifetime_orders > 3 AND dayofweek(order_date) IN (0, 6) GROUP BY industry""",
)
add(
    "j12_customer_filters_subscriptions",
    lambda b: star(b).aggregate(
        "fct_subscriptions",
        {"subscriptions": F.count(F.lit(1)), "mrr": exact_sum(F.col("mrr"))},
        ["dim_customers.country", "status"],
        {"dim_customers": "recency_days < 200"},
    ),
    f"""SELECT country, status, count(*) AS subscriptions, {money("s.mrr")} AS mrr
    FROM stg_subscriptions s JOIN dim_customers USING (customer_id) WHERE recency_days < 200 GROUP BY country, status""",
)
add(
    "j12_customer_filters_segments",
    lambda b: star(b).aggregate(
        "customer_segments",
        {"customers": F.count(F.lit(1)), "revenue": exact_sum(F.col("lifetime_revenue"))},
        ["value_tier", "dim_customers.country"],
        {"dim_customers": "has_active_sub"},
    ),
    f"""SELECT value_tier, country, count(*) AS customers, {money("lifetime_revenue")} AS revenue
    FROM scored WHERE has_active_sub GROUP BY value_tier, country""",
)
add(
    "j12_segment_filters_orders",
    lambda b: star(b).aggregate(
        "fct_orders",
        {"orders": F.count(F.lit(1)), "revenue": exact_sum(F.col("recognized_revenue"))},
        ["dim_date.year"],
        {"customer_segments": "value_tier = 'High-Value'", "dim_customers": "acquisition_channel <> 'Email'"},
    ),
    f"""SELECT CAST(year(order_date) AS INTEGER) AS year, count(*) AS orders, {money("recognized_revenue")} AS revenue
    FROM stg_orders JOIN scored USING (customer_id)
    WHERE value_tier = 'High-Value' AND acquisition_channel <> 'Email' GROUP BY ALL""",
)

# --- aggregates ---------------------------------------------------------------

add(
    "a01_group_aggregates",
    lambda b: b.staged.orders.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum(F.col("net_amount")).alias("total"),
        exact_mean(F.col("net_amount")).alias("mean"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    ),
    f"""SELECT o_orderpriority AS channel, count(*) AS n, {money("o_totalprice")} AS total, {money_avg("o_totalprice")} AS mean,
    CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1""",
)
add(
    "a02_conditional_average",
    lambda b: b.staged.orders.groupBy("channel").agg(
        exact_mean(F.when(F.col("is_recognized"), F.col("net_amount"))).alias("avg_completed")
    ),
    f"""SELECT o_orderpriority AS channel, {money_avg("o_totalprice")} AS avg_completed FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1""",
)
add(
    "a03_filter_aggregate",
    lambda b: b.staged.orders.groupBy("order_month").agg(
        F.count_if("is_recognized").alias("completed"),
        F.count_if(F.col("status") == "refunded").alias("refunded"),
        exact_sum(F.when(F.col("status") == "refunded", F.col("net_amount"))).alias("refunded_amount"),
    ),
    f"""SELECT order_month, count(*) FILTER (WHERE status = 'completed') AS completed,
    count(*) FILTER (WHERE status = 'refunded') AS refunded,
    {money("CASE status WHEN 'refunded' THEN net_amount END")} AS refunded_amount FROM stg_orders GROUP BY 1""",
)
add(
    "a04_count_distinct",
    lambda b: b.staged.orders.groupBy("order_date").agg(F.countDistinct("customer_id").alias("ordering_customers")),
    "SELECT order_date, count(DISTINCT customer_id) AS ordering_customers FROM stg_orders GROUP BY 1",
)
add(
    "a05_count_distinct_filter",
    lambda b: b.staged.orders.groupBy("order_month").agg(
        F.countDistinct(F.when(F.col("is_recognized"), F.col("customer_id"))).alias("paying_customers")
    ),
    "SELECT order_month, count(DISTINCT customer_id) FILTER (WHERE is_recognized) AS paying_customers FROM stg_orders GROUP BY 1",
)
add(
    "a06_bool_or_and",
    lambda b: b.staged.subscriptions.groupBy("plan", "billing_interval").agg(
        F.bool_or("is_churned").alias("any_churned"), F.bool_and("is_churned").alias("all_churned")
    ),
    """SELECT plan, billing_interval, count(churn_date) > 0 AS any_churned, count(churn_date) = count(*) AS all_churned
    FROM stg_subscriptions GROUP BY ALL""",
)
add(
    "a07_any_indicator",
    lambda b: b.staged.events.groupBy("customer_id").agg(
        F.max(F.when(F.col("platform") == "ios", 1).otherwise(0)).alias("used_ios")
    ),
    "SELECT customer_id, CAST(bool_or(platform = 'ios') AS INTEGER) AS used_ios FROM stg_events GROUP BY 1",
)
add(
    "a08_mean_indicator",
    lambda b: b.staged.subscriptions.groupBy("plan").agg(
        share_of(F.col("is_active")).alias("active_share"), share_of(F.col("is_churned")).alias("churned_share")
    ),
    """SELECT plan, CAST(count(*) FILTER (WHERE is_active) AS DOUBLE) / count(*) AS active_share,
    CAST(count(churn_date) AS DOUBLE) / count(*) AS churned_share FROM stg_subscriptions GROUP BY 1""",
)
add(
    "a09_pivot_conditional_max",
    lambda b: b.wh.cohort_retention.groupBy("cohort_label", "cohort_size")
    .pivot("months_since_signup", [0, 1, 2, 3, 6])
    .agg(F.max("active_customers"))
    .toDF("cohort_label", "cohort_size", "m0", "m1", "m2", "m3", "m6"),
    "SELECT cohort_label, cohort_size, "
    + ", ".join(f"max(active_customers) FILTER (WHERE months_since_signup = {m}) AS m{m}" for m in (0, 1, 2, 3, 6))
    + " FROM cohort_retention GROUP BY ALL",
)
_RFM_SQL = (
    "SELECT m_score, " + ", ".join(f"count(*) FILTER (WHERE f_score = {f}) AS f{f}" for f in range(1, 6)) + " FROM scored GROUP BY 1"
)
add("a10_pivot_matrix_fill", lambda b: dashboard.rfm_matrix(b.wh.customer_segments), _RFM_SQL)
add(
    "a11_global_aggregate",
    lambda b: b.staged.orders.agg(
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        F.count(F.lit(1)).alias("n"),
        exact_sum(F.col("recognized_revenue")).alias("revenue"),
    ),
    f"""SELECT min(order_date) AS first_day, max(order_date) AS last_day, count(*) AS n, {money("recognized_revenue")} AS revenue
    FROM stg_orders""",
)
add(
    "a12_distinct",
    lambda b: b.staged.events.select("customer_id", month_start(F.col("event_date")).alias("active_month")).distinct(),
    "SELECT customer_id, CAST(date_trunc('month', event_date) AS DATE) AS active_month FROM stg_events GROUP BY ALL",
)


def aggregate_over_aggregate(b: Bound) -> DataFrame:
    groups = b.staged.orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(exact_units(F.col("net_amount"))).alias("units")
    )
    everyone = Window.partitionBy(F.lit(1))  # one row per status
    return groups.select(
        "status",
        "orders",
        F.sum("orders").over(everyone).alias("all_orders"),
        from_units(F.sum("units").over(everyone)).alias("all_net"),
    )


add(
    "a13_aggregate_over_aggregate",
    aggregate_over_aggregate,
    f"""SELECT status, count(*) AS orders, (SELECT count(*) FROM orders) AS all_orders,
    (SELECT {money("o_totalprice")} FROM orders) AS all_net FROM stg_orders GROUP BY status""",
)
add(
    "a14_dynamic_group_by",
    lambda b: pivot_explore(b.wh.fct_orders, "region", "net_amount", "sum"),
    f"SELECT region, {money('net_amount')} AS net_amount FROM fct_orders WHERE region IS NOT NULL GROUP BY 1",
)
add(
    "a14_dynamic_group_by_mean",
    lambda b: pivot_explore(b.wh.fct_subscriptions, "plan", "months_active", "mean"),
    "SELECT plan, CAST(sum(months_active) AS DOUBLE) / count(months_active) AS months_active FROM stg_subscriptions GROUP BY 1",
)
for _agg, _sql in (
    ("sum", "CAST(sum(v) AS DOUBLE)"),
    ("mean", "CAST(sum(v) AS DOUBLE) / count(v)"),
):
    # Shares of one customer in all revenue: the more customers, the smaller.
    add(
        f"a14_share_{_agg}",
        lambda b, agg=_agg: pivot_explore(b.wh.customer_segments, "value_tier", "revenue_share", agg, RATE),
        f"""SELECT value_tier, {_sql} AS revenue_share
        FROM (SELECT value_tier, CAST(revenue_share AS DECIMAL(28,15)) AS v FROM customer_segments) GROUP BY 1""",
    )
    for _rate in ("conversion_rate", "churn_rate"):
        add(
            f"a14_{_rate}_{_agg}",
            lambda b, agg=_agg, rate=_rate: pivot_explore(
                b.wh.kpi_monthly.select(F.date_format("month", "yyyy").alias("year"), rate), "year", rate, agg, RATE
            ),
            f"""SELECT year, {_sql} AS {_rate} FROM
            (SELECT strftime(month, '%Y') AS year, CAST({_rate} AS DECIMAL(28,15)) AS v FROM kpi_monthly) GROUP BY 1""",
        )
add(
    "a15_mean_ignoring_zeros",
    lambda b: b.staged.orders.groupBy("channel").agg(
        exact_mean(F.nullif(F.col("recognized_revenue"), F.lit(0.0))).alias("avg_nonzero")
    ),
    f"""SELECT channel, {money_avg("CASE WHEN recognized_revenue <> 0 THEN recognized_revenue END")} AS avg_nonzero
    FROM stg_orders GROUP BY 1""",
)
add(
    "a16_share_of_total",
    lambda b: b.staged.orders.groupBy("channel")
    .agg(F.sum(exact_units(F.col("net_amount"))).alias("units"))
    .crossJoin(F.broadcast(b.staged.orders.agg(F.sum(exact_units(F.col("net_amount"))).alias("all_units"))))  # one row
    .select("channel", ratio_or_null(from_units(F.col("units")), from_units(F.col("all_units"))).alias("share")),
    f"""SELECT o_orderpriority AS channel, {money("o_totalprice")} / (SELECT {money("o_totalprice")} FROM orders) AS share
    FROM orders GROUP BY 1""",
)

# --- windows ------------------------------------------------------------------


def ranked_customers(b: Bound) -> DataFrame:
    return settle(b.wh.dim_customers.select("customer_id", "lifetime_revenue", "lifetime_orders", "recency_days"))


add(
    "w01_ntile_decile",
    lambda b: distributed_ntile(ranked_customers(b), [("decile", 10, Ordering("lifetime_revenue"))]).select("customer_id", "decile"),
    """SELECT customer_id, CAST(ntile(10) OVER (ORDER BY lifetime_revenue ASC, customer_id) AS INTEGER) AS decile
    FROM dim_customers""",
)
add(
    "w02_ntile_rfm",
    lambda b: distributed_ntile(
        ranked_customers(b),
        [
            ("r_score", 5, Ordering("recency_days", descending=True)),
            ("f_score", 5, Ordering("lifetime_orders")),
            ("m_score", 5, Ordering("lifetime_revenue")),
        ],
    ).select("customer_id", "r_score", "f_score", "m_score"),
    "SELECT customer_id, r_score, f_score, m_score FROM scored",
)


def totals_on_rows(b: Bound) -> DataFrame:
    base = ranked_customers(b)
    total = base.agg(exact_sum(F.col("lifetime_revenue")).alias("total_revenue"), F.count(F.lit(1)).alias("total_customers"))
    return base.crossJoin(F.broadcast(total)).select("customer_id", "total_revenue", "total_customers")  # one row


add("w03_totals_over_all", totals_on_rows, "SELECT customer_id, total_revenue, total_customers FROM dim_customers, totals")
add(
    "w04_conditional_total",
    lambda b: b.wh.dim_customers.select("customer_id")
    .crossJoin(F.broadcast(priority_totals(b.wh.dim_customers)))  # one row
    .select("customer_id", "priority_revenue_share", "priority_customer_share"),
    """SELECT customer_id, flagged_revenue / total_revenue AS priority_revenue_share,
    flagged_customers / total_customers AS priority_customer_share FROM dim_customers, totals""",
)
add(
    "w05_partition_totals",
    lambda b: b.wh.customer_segments.select("customer_id", "value_tier", "tier_revenue_share", "tier_customer_share"),
    """SELECT customer_id, value_tier, tier_revenue / total_revenue AS tier_revenue_share,
    tier_customers / total_customers AS tier_customer_share FROM scored JOIN tiers USING (value_tier), totals""",
)
_DESC = Ordering("lifetime_revenue", descending=True)
add(
    "w06_running_sum",
    lambda b: prefix_sum(ranked_customers(b), "lifetime_revenue", _DESC).select("customer_id", "running"),
    """SELECT customer_id, CAST(sum(CAST(lifetime_revenue AS DECIMAL(18,4))) OVER (ORDER BY lifetime_revenue DESC, customer_id
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM dim_customers""",
)
add(
    "w07_row_number",
    lambda b: distributed_rank(ranked_customers(b), _DESC, name="rn").select("customer_id", "rn"),
    "SELECT customer_id, row_number() OVER (ORDER BY lifetime_revenue DESC, customer_id) AS rn FROM dim_customers",
)


def lag_month(b: Bound) -> DataFrame:
    monthly = b.wh.kpis("revenue")  # one row per month
    before = F.lag("recognized_revenue").over(Window.orderBy("month"))
    return monthly.select(
        "month",
        before.alias("previous"),
        ((exact_units(F.col("recognized_revenue")) - exact_units(before)) * 10_000).cast("bigint").alias("delta_units"),
    )


add(
    "w08_lag",
    lag_month,
    """SELECT month, lag(recognized_revenue) OVER w AS previous,
    CAST((CAST(recognized_revenue AS DECIMAL(18,4)) - CAST(lag(recognized_revenue) OVER w AS DECIMAL(18,4))) * 10000 AS BIGINT)
    AS delta_units FROM kpi_monthly WINDOW w AS (ORDER BY month)""",
)


def moving_average(b: Bound) -> DataFrame:
    w = Window.orderBy("month").rowsBetween(-2, 0)
    units = F.sum(exact_units(F.col("recognized_revenue"))).over(w)
    return b.wh.kpis("revenue").select("month", (from_units(units) / F.count(F.lit(1)).over(w)).alias("avg3"))


add(
    "w09_moving_average",
    moving_average,
    """SELECT month, CAST(sum(CAST(recognized_revenue AS DECIMAL(18,4))) OVER w AS DOUBLE) / count(*) OVER w AS avg3
    FROM kpi_monthly WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
_CURVE_SQL = """SELECT customer_id, lifetime_revenue, row_number() OVER w AS revenue_rank,
    CAST(sum(CAST(lifetime_revenue AS DECIMAL(18,4))) OVER w AS DOUBLE) AS running_revenue,
    CAST(sum(CAST(lifetime_revenue AS DECIMAL(18,4))) OVER w AS DOUBLE) / total_revenue AS cum_rev,
    CAST(row_number() OVER w AS DOUBLE) / total_customers AS cust_pct
    FROM dim_customers, totals WINDOW w AS (ORDER BY lifetime_revenue DESC, customer_id ROWS UNBOUNDED PRECEDING)"""
add("w10_cumulative_share", lambda b: analysis.pareto_curve(ranked_customers(b)), _CURVE_SQL)


def percentile_bucket(b: Bound) -> DataFrame:
    base = ranked_customers(b)
    n = base.count()
    ranked = distributed_rank(base, _DESC, n, name="rn")
    return ranked.select("customer_id", (F.ceil(F.lit(10.0) * F.col("rn") / n).cast("int") * 10).alias("pct_bucket"))


add(
    "w11_percentile_bucket",
    percentile_bucket,
    """SELECT customer_id, CAST(ceil(10 * row_number() OVER (ORDER BY lifetime_revenue DESC, customer_id) / total_customers)
    AS INTEGER) * 10 AS pct_bucket FROM dim_customers, totals""",
)
add(
    "w12_prior_month",
    lambda b: analysis.prior_month(b.wh.kpis("revenue"), "recognized_revenue"),
    """SELECT m.month, m.recognized_revenue, p.recognized_revenue AS recognized_revenue_pm
    FROM kpi_monthly m LEFT JOIN kpi_monthly p ON p.month + INTERVAL 1 MONTH = m.month""",
)
add(
    "w13_year_to_date",
    lambda b: analysis.year_to_date(b.wh.kpis("revenue"), "recognized_revenue"),
    """SELECT month, recognized_revenue, (SELECT CAST(sum(CAST(recognized_revenue AS DECIMAL(18,4))) AS DOUBLE)
    FROM kpi_monthly p WHERE p.year = m.year AND p.month <= m.month) AS recognized_revenue_ytd FROM kpi_monthly m""",
)

# --- sorts and limits ---------------------------------------------------------

add(
    "t01_order_by",
    lambda b: b.wh.cohort_retention.orderBy("cohort_month", F.col("months_since_signup").desc()),
    "SELECT * FROM cohort_retention ORDER BY cohort_month, months_since_signup DESC",
)
add(
    "t02_latest_two",
    lambda b: b.wh.kpis("revenue").orderBy(F.col("month").desc()).limit(2).select("month", "recognized_revenue"),
    "SELECT month, recognized_revenue FROM kpi_monthly ORDER BY month DESC LIMIT 2",
)
add(
    "t03_top_customers",
    lambda b: b.wh.dim_customers.orderBy(F.col("lifetime_revenue").desc_nulls_last(), "customer_id")
    .limit(25)
    .select("customer_id", "lifetime_revenue"),
    "SELECT customer_id, lifetime_revenue FROM dim_customers ORDER BY lifetime_revenue DESC, customer_id LIMIT 25",
)
add(
    "t04_tail_months",
    lambda b: b.wh.kpis("sessions").orderBy(F.col("month").desc()).limit(12).orderBy("month"),
    """SELECT month, year, month_label, sessions, conversions, conversion_rate FROM kpi_monthly
    WHERE month > (SELECT max(month) - INTERVAL 12 MONTH FROM months)""",
)
add(
    "t05_head_rows",
    lambda b: b.wh.fct_orders.orderBy("order_id").limit(500).select("order_id", "region", "net_amount"),
    "SELECT order_id, region, net_amount FROM fct_orders ORDER BY order_id LIMIT 500",
)
add(
    "t06_custom_order",
    lambda b: dashboard.churn_by_plan(b.staged.subscriptions, [*dashboard.PLAN_ORDER, "Legacy"]),
    """SELECT plan, churn_rate, display_order FROM (
    SELECT unnest(['Free','Starter','Pro','Business','Enterprise','Legacy']) AS plan,
        CAST(unnest(range(1, 7)) AS INTEGER) AS display_order)
    LEFT JOIN (SELECT plan, CAST(count(churn_date) AS DOUBLE) / count(*) AS churn_rate FROM stg_subscriptions GROUP BY 1)
    USING (plan)""",
)


def last_two_rows(b: Bound) -> DataFrame:
    """The newest month next to the one before it, as one row."""
    two = b.wh.kpis("revenue").orderBy(F.col("month").desc()).limit(2)
    return two.agg(
        F.max("month").alias("last_month"),
        F.max_by("recognized_revenue", "month").alias("last_revenue"),
        F.min_by("recognized_revenue", "month").alias("previous_revenue"),
    )


add(
    "t07_last_and_previous",
    last_two_rows,
    """SELECT month AS last_month, recognized_revenue AS last_revenue,
    lag(recognized_revenue) OVER (ORDER BY month) AS previous_revenue FROM kpi_monthly ORDER BY month DESC LIMIT 1""",
)
add(
    "u01_stacked_totals",
    lambda b: dashboard.acquisition_funnel(b.staged.web_sessions, b.staged.customers),
    """SELECT 'Page views' AS stage, 1 AS step, CAST(sum(pages_viewed) AS BIGINT) AS value FROM stg_web_sessions
    UNION ALL SELECT 'Sessions', 2, count(*) FROM events
    UNION ALL SELECT 'Conversions', 3, count(*) FILTER (WHERE event_type = 'purchase') FROM events
    UNION ALL SELECT 'New customers', 4, count(*) FROM customer""",
)
add(
    "a08_rate_mean",
    lambda b: b.wh.kpis("sessions").groupBy("year").agg(rate_mean(F.col("conversion_rate")).alias("avg_conversion")),
    f"SELECT year, {rate_avg('conversion_rate')} AS avg_conversion FROM kpi_monthly GROUP BY 1",
)
