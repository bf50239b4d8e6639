"""K1-K16: each KPI as its own query; only the feeds it needs are in the plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebook.catalog.base import add
from tidebook.operators.retention import window_retention
from tidebook.plans.kpis import ltv_to_cac, scorecard


def kpi(name: str, groups: tuple[str, ...], *columns: str) -> None:
    add(
        name,
        lambda b: b.wh.kpis(*groups).select("month", *columns),
        f"SELECT month, {', '.join(columns)} FROM kpi_monthly",
    )


kpi("k01_recognized_revenue", ("revenue",), "recognized_revenue", "completed_orders")
kpi("k02_refund_rate", ("revenue",), "refunded_orders", "refund_rate")
kpi("k03_avg_order_value", ("revenue",), "avg_order_value")
kpi("k04_new_customers", ("signups",), "new_customers")
kpi("k05_active_at_start", ("subscriptions",), "active_at_start")
kpi("k06_churned_in_month", ("subscriptions",), "churned_customers")
kpi("k07_churn_rate", ("subscriptions",), "churn_rate")
kpi("k08_active_mrr", ("subscriptions",), "active_mrr", "active_customers")
kpi("k09_arpa", ("revenue", "subscriptions"), "arpa")
kpi("k10_spend_and_cac", ("spend", "signups"), "marketing_spend", "cac")
kpi("k11_ltv", ("revenue", "subscriptions"), "ltv")
kpi("k12_conversion_rate", ("sessions",), "sessions", "conversions", "conversion_rate")
kpi("k13_retention_30d", ("retention",), "cohort_size", "retained_30d", "retention_30d")
kpi("k14_cohort_maturity", ("retention",), "cohort_is_mature")

add(
    "k13_retention_by_orders",
    lambda b: window_retention(
        b.staged.customers, b.staged.orders.select("customer_id", "order_date"), 60, 120, day="order_date"
    ),
    """WITH flags AS (
    SELECT customer_id, signup_date, coalesce((SELECT bool_or(order_date - signup_date BETWEEN 60 AND 119)
        FROM stg_orders o WHERE o.customer_id = c.customer_id), false) AS back
    FROM stg_customers c WHERE signup_date IS NOT NULL)
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS month, count(*) AS cohort_size,
    count(*) FILTER (WHERE back) AS retained_30d,
    bool_and(signup_date + 120 <= (SELECT max(order_date) FROM stg_orders)) AS cohort_is_mature,
    CAST(count(*) FILTER (WHERE back) AS DOUBLE) / count(*) AS retention_30d FROM flags GROUP BY 1""",
)

_KPIS = ("recognized_revenue", "churn_rate", "cac", "ltv", "conversion_rate")

add(
    "k15_scorecard",
    lambda b: scorecard(b.wh.kpi_monthly, b.staged.orders),
    """WITH done AS (SELECT *, row_number() OVER (ORDER BY month DESC) AS age FROM kpi_monthly
        WHERE month < (SELECT date_trunc('month', last_order_day) FROM span)),
cur AS (SELECT *, ltv / nullif(cac, 0) AS ratio FROM done WHERE age = 1),
prv AS (SELECT * FROM done WHERE age = 2),
ret AS (SELECT month_label, retention_30d FROM kpi_monthly WHERE cohort_is_mature ORDER BY month DESC LIMIT 1),
lines AS (
    SELECT 'recognized_revenue' AS kpi, cur.month_label, cur.recognized_revenue AS value, prv.recognized_revenue AS prior,
        CASE WHEN cur.recognized_revenue >= 500000 THEN 'on' WHEN cur.recognized_revenue >= 0.9 * 500000 THEN 'watch'
             ELSE 'off' END AS status, 500000::DOUBLE AS target, cur.recognized_revenue / 500000 AS reached, 1 AS up FROM cur, prv
    UNION ALL SELECT 'churn_rate', cur.month_label, cur.churn_rate, prv.churn_rate,
        CASE WHEN cur.churn_rate <= 0.055 THEN 'on' ELSE 'off' END, 0.055::DOUBLE,
        0.055::DOUBLE / greatest(cur.churn_rate, 1e-9), -1 FROM cur, prv
    UNION ALL SELECT 'cac', cur.month_label, cur.cac, prv.cac, CASE WHEN cur.cac <= 1200 THEN 'on' ELSE 'off' END,
        1200::DOUBLE, 1200::DOUBLE / greatest(cur.cac, 1e-9), -1 FROM cur, prv
    UNION ALL SELECT 'ltv', month_label, ltv, NULL, CASE WHEN coalesce(ratio, 0) >= 3 THEN 'on'
        WHEN coalesce(ratio, 0) >= 2 THEN 'watch' ELSE 'off' END, 2500::DOUBLE, coalesce(ratio, 0) / 3, 0 FROM cur
    UNION ALL SELECT 'conversion_rate', cur.month_label, cur.conversion_rate, prv.conversion_rate,
        CASE WHEN cur.conversion_rate >= 0.045 THEN 'on' ELSE 'off' END, 0.045::DOUBLE,
        cur.conversion_rate / 0.045::DOUBLE, 1 FROM cur, prv
    UNION ALL SELECT 'retention_30d', month_label, retention_30d, NULL, CASE WHEN retention_30d >= 0.55 THEN 'on'
        WHEN retention_30d >= 0.5 THEN 'watch' ELSE 'off' END, 0.55::DOUBLE, retention_30d / 0.55::DOUBLE, 0 FROM ret)
SELECT kpi, month_label, value, prior, (value - prior) / nullif(abs(prior), 0) * 100 AS delta_pct,
    CASE WHEN up <> 0 THEN coalesce((value - prior) / nullif(abs(prior), 0), 0) * up >= 0 END AS delta_good,
    status, target, least(greatest(reached, 0), 1) AS progress FROM lines""",
)
add(
    "k16_ltv_to_cac",
    lambda b: b.wh.kpis("revenue", "subscriptions", "spend", "signups").select(
        "month", ltv_to_cac(F.col("ltv"), F.col("cac")).alias("ltv_to_cac")
    ),
    "SELECT month, CASE WHEN cac = 0 THEN 0 ELSE ltv / cac END AS ltv_to_cac FROM kpi_monthly",
)
