"""B1-B12: the measure library."""

from __future__ import annotations

from tidebook.catalog.base import Bound, Once, add
from tidebook.catalog.oracle import money, rate_avg, ratio_avg
from tidebook.plans.measures import measure


def tables(b: Bound, *names: str) -> dict:
    return {n: getattr(b.wh, n) for n in names}


def of(names: list[str], *marts: str, by: tuple[str, ...] = (), where: str | None = None):
    return lambda b: measure(names, tables(b, *marts), by, where)


_BY_MONTH = f"SELECT order_month AS month, {money('recognized_revenue')} AS rev FROM stg_orders GROUP BY 1"

add(
    "b01_revenue_prior_month",
    of(["recognized_revenue", "recognized_revenue_pm", "revenue_mom_pct"], "fct_orders"),
    f"""WITH r AS ({_BY_MONTH})
SELECT a.month, a.rev AS recognized_revenue, p.rev AS recognized_revenue_pm, (a.rev - p.rev) / nullif(p.rev, 0) AS revenue_mom_pct
FROM r a LEFT JOIN r p ON a.month = p.month + INTERVAL 1 MONTH""",
)
add(
    "b02_revenue_ytd",
    of(["revenue_ytd"], "fct_orders"),
    f"""WITH r AS ({_BY_MONTH})
SELECT month, CAST(sum(CAST(rev AS DECIMAL(18,4))) OVER (PARTITION BY year(month) ORDER BY month) AS DOUBLE) AS revenue_ytd
FROM r""",
)
add(
    "b03_avg_order_value",
    of(["avg_order_value"], "fct_orders", by=("region",)),
    f"""SELECT region, {money("recognized_revenue")} / count(DISTINCT order_id) FILTER (WHERE is_recognized) AS avg_order_value
    FROM fct_orders GROUP BY region""",
)
add(
    "b04_refund_rate",
    of(["refund_rate"], "fct_orders", by=("plan",)),
    """SELECT plan, CAST(sum(CASE status WHEN 'refunded' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS refund_rate
    FROM fct_orders GROUP BY plan""",
)
add(
    "b05_churn_measures",
    of(["churn_rate", "churned_customers", "churn_vs_target"], "kpi_monthly"),
    f"""SELECT {rate_avg("churn_rate")} AS churn_rate, CAST(sum(churned_customers) AS BIGINT) AS churned_customers,
    {rate_avg("churn_rate")} - 0.055::DOUBLE AS churn_vs_target FROM kpi_monthly""",
)
add(
    "b06_acquisition_measures",
    of(["marketing_spend", "new_customers", "cac"], "kpi_monthly", by=("year",)),
    f"""SELECT year, {money("marketing_spend")} AS marketing_spend, CAST(sum(new_customers) AS BIGINT) AS new_customers,
    {money("marketing_spend")} / nullif(sum(new_customers), 0) AS cac FROM kpi_monthly GROUP BY year""",
)
add(
    "b07_ltv_measures",
    of(["ltv", "ltv_to_cac", "ltv_cac_status"], "kpi_monthly"),
    f"""WITH m AS (SELECT {ratio_avg("ltv")} AS ltv,
    {money("marketing_spend")} / sum(new_customers) AS cac FROM kpi_monthly)
SELECT ltv, ltv / cac AS ltv_to_cac, CASE WHEN ltv / cac < 2 THEN 'Unhealthy' WHEN ltv / cac < 3 THEN 'Watch' ELSE 'Healthy' END
    AS ltv_cac_status FROM m""",
)
add(
    "b08_conversion_measures",
    of(["sessions", "conversions", "conversion_rate"], "kpi_monthly", by=("year",)),
    """SELECT year, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(conversions) AS BIGINT) AS conversions,
    CAST(sum(conversions) AS DOUBLE) / CAST(sum(sessions) AS DOUBLE) AS conversion_rate FROM kpi_monthly GROUP BY year""",
)
add(
    "b09_retention_measures",
    of(["retention_30d", "retention_30d_latest"], "kpi_monthly"),
    f"""SELECT {rate_avg("retention_30d")} AS retention_30d, arg_max(retention_30d, month) AS retention_30d_latest
    FROM kpi_monthly WHERE cohort_is_mature""",
)
add(
    "b10_subscription_measures",
    of(
        ["active_mrr", "active_arr", "active_customers", "arpa"],
        "fct_orders",
        "fct_subscriptions",
        by=("region",),
    ),
    f"""SELECT region, active_mrr, active_mrr * 12 AS active_arr, active_customers, rev / active_customers AS arpa
    FROM (SELECT region, {money("mrr")} AS active_mrr, count(DISTINCT customer_id) AS active_customers
        FROM fct_subscriptions WHERE is_active GROUP BY region)
    JOIN (SELECT region, {money("recognized_revenue")} AS rev FROM fct_orders GROUP BY region) USING (region)""",
)
add(
    "b11_priority_measures",
    of(
        [
            "priority_revenue",
            "total_segment_revenue",
            "priority_revenue_share",
            "priority_customer_share",
            "priority_label",
        ],
        "customer_segments",
    ),
    """SELECT flagged_revenue AS priority_revenue, total_revenue AS total_segment_revenue,
    flagged_revenue / total_revenue AS priority_revenue_share, flagged_customers / total_customers AS priority_customer_share,
    CAST(round(flagged_customers / total_customers * 100) AS INTEGER) || '% of customers → '
    || CAST(round(flagged_revenue / total_revenue * 100) AS INTEGER) || '% of revenue' AS priority_label FROM totals""",
)
add(
    "b12_revenue_target_measures",
    of(["recognized_revenue", "revenue_vs_target_pct", "revenue_rag"], "fct_orders", by=("order_month",)),
    f"""WITH r AS ({_BY_MONTH})
SELECT month AS order_month, rev AS recognized_revenue, (rev - 500000) / 500000 AS revenue_vs_target_pct,
    CASE WHEN rev < 450000 THEN 'Off Target' WHEN rev < 500000 THEN 'Watch' ELSE 'On Target' END AS revenue_rag FROM r""",
)

# --- the same measures under a filter context ---------------------------------------


def under(names: list[str], where: dict[str, str], by: tuple[str, ...] = ()):
    """Measures whose filters and groups go through the star."""
    return lambda b: measure(names, Once(lambda name: getattr(b.wh, name)), by, where)


add(
    "b13_sliced_by_customer",
    under(
        ["recognized_revenue", "recognized_orders", "active_mrr", "active_customers", "arpa"],
        {"dim_customers": "company_size BETWEEN 100 AND 800"},
        ("dim_customers.industry",),
    ),
    f"""WITH people AS (SELECT customer_id, industry FROM stg_customers WHERE company_size BETWEEN 100 AND 800)
SELECT industry, rev AS recognized_revenue, n AS recognized_orders, active_mrr, live AS active_customers,
    rev / nullif(live, 0) AS arpa
FROM (SELECT industry, {money("recognized_revenue")} AS rev, count(*) FILTER (WHERE is_recognized) AS n
    FROM stg_orders JOIN people USING (customer_id) GROUP BY industry)
FULL JOIN (SELECT industry, {money("CASE WHEN is_active THEN mrr END")} AS active_mrr,
        count(DISTINCT customer_id) FILTER (WHERE is_active) AS live
    FROM stg_subscriptions JOIN people USING (customer_id) GROUP BY industry) USING (industry)""",
)
add(
    "b14_sliced_by_date_and_tier",
    under(
        ["recognized_revenue", "avg_order_value", "refund_rate", "active_mrr", "marketing_spend"],
        {"dim_date": "year = 1996", "customer_segments": "value_tier = 'Core'"},
    ),
    f"""SELECT rev AS recognized_revenue, rev / nullif(n, 0) AS avg_order_value, refund_rate, active_mrr, marketing_spend
FROM (SELECT {money("recognized_revenue")} AS rev, count(*) FILTER (WHERE is_recognized) AS n,
        CAST(count(*) FILTER (WHERE status = 'refunded') AS DOUBLE) / nullif(count(*), 0) AS refund_rate
    FROM stg_orders JOIN scored USING (customer_id) WHERE value_tier = 'Core' AND year(order_date) = 1996),
    (SELECT {money("CASE WHEN s.is_active THEN s.mrr END")} AS active_mrr
    FROM stg_subscriptions s JOIN scored USING (customer_id) WHERE value_tier = 'Core'),
    (SELECT {money("marketing_spend")} AS marketing_spend FROM kpi_monthly)""",
)
add(
    "b15_calendar_measures_of_a_slice",
    under(
        ["recognized_revenue", "recognized_revenue_pm", "revenue_mom_pct", "revenue_ytd"],
        {"dim_date": "year = 1997 AND month_num > 3", "dim_customers": "industry = 'MACHINERY'"},
    ),
    f"""WITH r AS (SELECT order_month AS month, {money("recognized_revenue")} AS rev
    FROM stg_orders JOIN stg_customers USING (customer_id) WHERE industry = 'MACHINERY' GROUP BY 1),
along AS (SELECT month, rev, (SELECT rev FROM r p WHERE r.month = p.month + INTERVAL 1 MONTH) AS pm,
    CAST(sum(CAST(rev AS DECIMAL(18,4))) OVER (PARTITION BY year(month) ORDER BY month) AS DOUBLE) AS ytd FROM r)
SELECT month, rev AS recognized_revenue, pm AS recognized_revenue_pm, (rev - pm) / nullif(pm, 0) AS revenue_mom_pct,
    ytd AS revenue_ytd FROM along WHERE year(month) = 1997 AND month(month) > 3""",
)
