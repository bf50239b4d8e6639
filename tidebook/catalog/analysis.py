"""Q1-Q9: the ad-hoc analysis queries."""

from __future__ import annotations

from tidebook.catalog.base import add
from tidebook.catalog.oracle import money
from tidebook.plans import analysis as A
from tidebook.session import settle

add(
    "q1_revenue_concentration",
    lambda b: A.concentration(b.wh.dim_customers, "is_high_value_seed"),  # no tiles are needed
    f"""SELECT CASE is_high_value_seed WHEN 1 THEN 'Priority (high-value)' ELSE 'Everyone else' END AS cohort,
    count(*) AS customers, round(100.0::DOUBLE * count(*) / any_value(total_customers), 1) AS pct_customers,
    round({money("lifetime_revenue")}) AS lifetime_revenue,
    round(100.0::DOUBLE * {money("lifetime_revenue")} / any_value(total_revenue), 1) AS pct_revenue
    FROM dim_customers, totals GROUP BY is_high_value_seed""",
)
add(
    "q2_pareto",
    lambda b: A.pareto(settle(b.wh.dim_customers.select("customer_id", "lifetime_revenue"))),
    """WITH placed AS (SELECT total_revenue,
        CAST(sum(CAST(lifetime_revenue AS DECIMAL(18,4))) OVER w AS DOUBLE) AS so_far,
        CAST(ceil(10 * row_number() OVER w / total_customers) AS INTEGER) * 10 AS bucket
    FROM dim_customers, totals WINDOW w AS (ORDER BY lifetime_revenue DESC, customer_id ROWS UNBOUNDED PRECEDING))
SELECT bucket || '%' AS top_customers, round(100.0::DOUBLE * max(so_far) / any_value(total_revenue), 1) AS pct_of_revenue
FROM placed WHERE bucket IN (10, 20, 30, 50) GROUP BY bucket""",
)
add(
    "q3_latest_two_months",
    lambda b: A.latest_kpis(b.wh.kpi_monthly, b.staged.orders),
    """SELECT month_label, round(recognized_revenue) AS revenue, round(churn_rate, 4) AS churn_rate, round(cac) AS cac,
    round(ltv) AS ltv, round(ltv / nullif(cac, 0), 2) AS ltv_cac_ratio, round(conversion_rate, 4) AS conversion_rate,
    round(retention_30d, 4) AS retention_30d
    FROM kpi_monthly, span WHERE month < date_trunc('month', last_order_day) ORDER BY month DESC LIMIT 2""",
)
add(
    "q4_revenue_bridge",
    lambda b: A.revenue_bridge(b.wh.kpis("revenue")),
    """SELECT month_label, round(now) AS revenue, round(now - before) AS mom_delta,
    round(100.0::DOUBLE * (now - before) / nullif(before, 0), 1) AS mom_pct, round(mean3) AS rev_3mo_avg
    FROM (SELECT month_label, recognized_revenue AS now, lag(recognized_revenue) OVER o AS before,
        CAST(sum(CAST(recognized_revenue AS DECIMAL(18,4))) OVER w AS DOUBLE) / count(*) OVER w AS mean3
    FROM kpi_monthly WINDOW o AS (ORDER BY month), w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
)
add(
    "q5_channel_efficiency",
    lambda b: A.channel_efficiency(b.wh.fct_orders, b.staged.marketing_spend),
    f"""WITH paid AS (SELECT channel, {money("spend")} AS cost FROM stg_marketing_spend GROUP BY channel),
got AS (SELECT acquisition_channel AS channel, count(DISTINCT customer_id) AS customers, {money("recognized_revenue")} AS rev
    FROM fct_orders GROUP BY 1)
SELECT got.channel, customers, round(coalesce(cost, 0)) AS marketing_spend, round(coalesce(cost, 0) / customers) AS cac,
    round(rev) AS revenue, round(rev / nullif(cost, 0), 2) AS roas FROM got LEFT JOIN paid ON paid.channel = got.channel""",
)
add(
    "q6_cohort_triangle",
    lambda b: A.cohort_triangle(b.wh.cohort_retention),
    "SELECT cohort_label, cohort_size, "
    + ", ".join(f"round(max(retention_rate) FILTER (WHERE months_since_signup = {m}), 2) AS m{m}" for m in (0, 1, 2, 3, 6))
    + " FROM cohort_retention GROUP BY ALL",
)
add(
    "q7_plan_economics",
    lambda b: A.plan_economics(b.wh.fct_subscriptions),
    f"""SELECT plan, count(*) AS subscriptions,
    round(100.0::DOUBLE * (CAST(count(*) FILTER (WHERE is_active) AS DOUBLE) / count(*)), 1) AS pct_active,
    round(100.0::DOUBLE * (CAST(count(churn_date) AS DOUBLE) / count(*)), 1) AS pct_churned,
    round(CAST(sum(months_active) AS DOUBLE) / count(months_active), 1) AS avg_tenure_months,
    round({money("CASE WHEN is_active THEN mrr ELSE 0 END")}) AS active_mrr FROM stg_subscriptions GROUP BY plan""",
)
add(
    "q8_regional_scorecard",
    lambda b: A.regional_scorecard(b.wh.dim_customers),
    f"""SELECT region, count(DISTINCT c.customer_id) AS customers, round({money("o.recognized_revenue")}) AS revenue,
    round({money("c.lifetime_revenue")} / count(*)) AS avg_ltv,
    round(100.0::DOUBLE * CAST(count(*) FILTER (WHERE has_active_sub) AS DOUBLE) / count(*), 1) AS pct_with_active_sub
    FROM dim_customers c LEFT JOIN stg_orders o ON c.customer_id = o.customer_id GROUP BY region""",
)
add(
    "q9_engagement_by_tier",
    lambda b: A.tier_engagement(b.wh.customer_segments),
    """SELECT value_tier, count(*) AS customers, round(CAST(sum(lifetime_events) AS DOUBLE) / count(*), 0) AS avg_events,
    round(CAST(sum(lifetime_orders) AS DOUBLE) / count(*), 1) AS avg_orders,
    round(CAST(sum(tenure_months) AS DOUBLE) / count(*), 1) AS avg_tenure_months,
    round(CAST(sum(recency_days) AS DOUBLE) / count(recency_days), 0) AS avg_recency_days FROM scored GROUP BY value_tier""",
)
