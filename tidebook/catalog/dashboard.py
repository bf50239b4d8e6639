"""D1-D23: the data behind the dashboard views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebook.catalog.base import Bound, add
from tidebook.catalog.oracle import money, money_avg, rate_avg, ratio_avg
from tidebook.catalog.relational import _CURVE_SQL, _RFM_SQL, _SLICE, _SLICE_SQL
from tidebook.operators.lookup import LookupTable
from tidebook.operators.slicing import pivot_explore, slice_customers, slice_orders
from tidebook.plans import analysis as A
from tidebook.plans import dashboard as D
from tidebook.functions.money import RATE
from tidebook.session import scratch_path, settle


def sliced(b: Bound):
    return slice_orders(b.wh.fct_orders, **_SLICE)


_DONE = f"fct_orders WHERE is_recognized AND {_SLICE_SQL}"

add(
    "d01_revenue_summary",
    lambda b: D.revenue_summary(sliced(b)),
    f"""SELECT {money("recognized_revenue")} AS revenue, count(*) FILTER (WHERE is_recognized) AS completed_orders,
    {money_avg("CASE WHEN is_recognized THEN net_amount END")} AS aov,
    CAST(count(*) FILTER (WHERE status = 'refunded') AS DOUBLE) / count(*) AS refund_rate FROM fct_orders WHERE {_SLICE_SQL}""",
)
for key, column in (
    ("d02_monthly_revenue", "order_month"),
    ("d03_revenue_by_region", "region"),
    ("d04_revenue_by_plan", "plan"),
):
    add(
        key,
        lambda b, c=column: D.revenue_by(sliced(b), c).select(c, "revenue").orderBy(F.col("revenue").desc()),
        f"SELECT {column}, {money('recognized_revenue')} AS revenue FROM {_DONE} GROUP BY 1",
    )
add(
    "d05_revenue_by_channel",
    lambda b: D.revenue_by(b.wh.fct_orders, "acquisition_channel"),
    f"""SELECT acquisition_channel, {money("recognized_revenue")} AS revenue, count(*) AS orders FROM fct_orders
    WHERE status = 'completed' GROUP BY 1""",
)
add(
    "d06_tier_economics",
    lambda b: D.tier_economics(b.wh.customer_segments),
    """SELECT value_tier, CAST(tier_customers AS BIGINT) AS customers, tier_customers / total_customers AS cust_share,
    tier_revenue AS revenue, tier_revenue / total_revenue AS rev_share, tier_revenue / tier_customers AS avg_ltv,
    CASE value_tier WHEN 'High-Value' THEN 1 WHEN 'Core' THEN 2 WHEN 'Occasional' THEN 3 ELSE 4 END AS display_order
    FROM tiers, totals""",
)
add(
    "d07_pareto_curve",
    lambda b: A.pareto_curve(settle(b.wh.dim_customers.select("customer_id", "lifetime_revenue"))),
    _CURVE_SQL,
)
add(
    "d08_rfm_matrix",
    lambda b: D.rfm_matrix(slice_customers(b.wh.customer_segments, plans=["Pro", "Business", "Enterprise"])),
    _RFM_SQL.replace("FROM scored", "FROM scored WHERE plan IN ('Pro', 'Business', 'Enterprise')"),
)
add(
    "d09_top_customers",
    lambda b: D.top_customers(b.wh.customer_segments),
    """SELECT customer_name AS customer, region, plan, value_tier AS tier, lifetime_orders AS orders,
    lifetime_revenue AS lifetime_rev, lifetime_revenue / total_revenue AS pct_of_total
    FROM scored, totals ORDER BY lifetime_revenue DESC, customer_id LIMIT 25""",
)
add(
    "d10_retention_summary",
    lambda b: D.retention_summary(b.wh.kpis("subscriptions", "retention"), b.staged.subscriptions),
    f"""SELECT {rate_avg("CASE WHEN cohort_is_mature THEN retention_30d END")} AS avg_retention_30d,
    {rate_avg("churn_rate")} AS avg_churn,
    (SELECT CAST(count(*) FILTER (WHERE is_active) AS DOUBLE) / count(*) FROM stg_subscriptions) AS active_share
    FROM kpi_monthly""",
)
add(
    "d11_cohort_heatmap",
    lambda b: D.cohort_heatmap(b.wh.cohort_retention),
    "SELECT cohort_label, "
    + ", ".join(f"max(CASE months_since_signup WHEN {m} THEN retention_rate END) AS m{m}" for m in range(13))
    + " FROM cohort_retention GROUP BY cohort_label",
)
add(
    "d12_retention_curve",
    lambda b: D.retention_curve(b.wh.cohort_retention),
    f"SELECT months_since_signup, {rate_avg('retention_rate')} AS retention_rate FROM cohort_retention GROUP BY 1",
)
add(
    "d13_churn_by_plan",
    lambda b: D.churn_by_plan(b.staged.subscriptions),
    """SELECT plan, CAST(count(churn_date) AS DOUBLE) / count(*) AS churn_rate,
    CAST(list_position(['Free','Starter','Pro','Business','Enterprise'], plan) AS INTEGER) AS display_order
    FROM stg_subscriptions GROUP BY plan""",
)
add(
    "d14_conversion_by_channel",
    lambda b: D.conversion_by_channel(b.staged.web_sessions),
    """SELECT channel, count(*) AS sessions, count(customer_id) AS conversions,
    CAST(count(customer_id) AS DOUBLE) / count(*) AS conv_rate FROM stg_web_sessions GROUP BY channel""",
)
add(
    "d15_acquisition_funnel",
    lambda b: D.acquisition_funnel(b.staged.web_sessions, b.staged.customers),
    """WITH t AS (SELECT sum(pages_viewed) AS a, count(*) AS s, sum(converted) AS c FROM stg_web_sessions)
SELECT unnest(['Page views', 'Sessions', 'Conversions', 'New customers']) AS stage, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS step,
    CAST(unnest([a, s, c, (SELECT count(*) FROM customer)]) AS BIGINT) AS value FROM t""",
)
add(
    "d16_spend_by_channel_region",
    lambda b: D.spend_matrix(b.staged.marketing_spend),
    f"SELECT channel, region, {money('spend')} AS spend FROM stg_marketing_spend GROUP BY ALL",
)
add(
    "d17_cac_vs_ltv",
    lambda b: b.wh.kpis("revenue", "subscriptions", "spend", "signups").select("month", "cac", "ltv").orderBy("month"),
    "SELECT month, cac, ltv FROM kpi_monthly",
)
add(
    "d17_average_cac",
    lambda b: D.average_cac(b.wh.kpis("spend", "signups")),
    f"SELECT {ratio_avg('CASE WHEN cac <> 0 THEN cac END')} AS avg_cac FROM kpi_monthly",
)
add(
    "d18_revenue_mrr_trend",
    lambda b: b.wh.kpis("revenue", "subscriptions")
    .select("month", "recognized_revenue", "active_mrr", "active_customers")
    .orderBy("month"),
    "SELECT month, recognized_revenue, active_mrr, active_customers FROM kpi_monthly",
)
add(
    "d19_twelve_month_scorecard",
    lambda b: D.last_months(b.wh.kpi_monthly),
    """SELECT month_label AS report_month, recognized_revenue AS revenue, active_customers AS active, churn_rate AS churn, cac,
    ltv, conversion_rate AS conversion, retention_30d FROM kpi_monthly ORDER BY month DESC LIMIT 12""",
)
add(
    "d20_no_code_pivot",
    lambda b: pivot_explore(b.wh.customer_segments, "value_tier", "lifetime_revenue", "max"),
    "SELECT value_tier, max(lifetime_revenue) AS lifetime_revenue FROM scored GROUP BY 1",
)
add(
    "d20_no_code_pivot_mean",
    lambda b: pivot_explore(b.wh.customer_segments, "region", "revenue_share", "mean", RATE),
    """SELECT region, CAST(sum(CAST(revenue_share AS DECIMAL(28,15))) AS DOUBLE) / count(revenue_share) AS revenue_share
    FROM customer_segments WHERE region IS NOT NULL GROUP BY 1""",
)
add(
    "d21_priority_headline",
    lambda b: D.priority_headline(b.wh.dim_customers),
    """SELECT flagged_customers / total_customers AS customer_share, flagged_revenue / total_revenue AS revenue_share
    FROM totals""",
)
add(
    "d22_customer_drill_through",
    lambda b: D.drill_lines(b.wh.fct_orders, b.wh.fct_subscriptions, b.wh.customer_segments),
    """SELECT customer_id, order_id, order_date, o.status, net_amount, subscription_id, s.plan AS sub_plan,
    s.status AS sub_status, s.mrr, value_tier, lifetime_revenue
    FROM stg_orders o JOIN stg_subscriptions s USING (customer_id) JOIN scored USING (customer_id)""",
)


def looked_up(b: Bound):
    """The lines of the customer worth most, from marts stored for lookups."""
    tables = []
    for name in ("fct_orders", "fct_subscriptions", "customer_segments"):
        tables.append(LookupTable(b.spark, scratch_path(b.spark, f"{name}-by-customer"), slots=16))
        tables[-1].write(getattr(b.wh, name))
    best = tables[2].read().orderBy(F.desc("lifetime_revenue"), "customer_id").select("customer_id").first()
    return D.drill_lookup(best[0] if best else None, *tables)


add(
    "d22_customer_lookup",
    looked_up,
    """SELECT customer_id, order_id, order_date, o.status, net_amount, subscription_id, s.plan AS sub_plan,
    s.status AS sub_status, s.mrr, value_tier, lifetime_revenue
    FROM stg_orders o JOIN stg_subscriptions s USING (customer_id) JOIN scored USING (customer_id)
    WHERE customer_id = (SELECT customer_id FROM dim_customers ORDER BY lifetime_revenue DESC, customer_id LIMIT 1)""",
)
add(
    "d23_high_value_audit",
    lambda b: D.high_value_audit(b.staged.orders, b.staged.customers),
    f"""SELECT {money("o_totalprice * (o_custkey % 8 = 0)::INTEGER")} AS high_value_revenue, {money("o_totalprice")} AS total_revenue,
    {money("o_totalprice * (o_custkey % 8 = 0)::INTEGER")} / {money("o_totalprice")} AS revenue_share,
    (SELECT CAST(count(*) FILTER (WHERE c_custkey % 8 = 0) AS DOUBLE) / count(*) FROM customer) AS customer_share
    FROM orders WHERE o_orderstatus = 'F'""",
)
