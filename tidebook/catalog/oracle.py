"""DuckDB statements of the staged tables and marts, written independently of the plans."""

from __future__ import annotations


def money(expr: str) -> str:
    """An exact total as DOUBLE."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,4))) AS DOUBLE)"


def money_avg(expr: str) -> str:
    return f"({money(expr)} / nullif(count({expr}), 0))"


def ratio_avg(expr: str) -> str:
    """Mean of amounts that are themselves quotients, to ten decimals each."""
    return f"(CAST(SUM(CAST(({expr}) AS DECIMAL(28,10))) AS DOUBLE) / nullif(count({expr}), 0))"


def rate_avg(expr: str) -> str:
    """Mean of rates, to fifteen decimals each."""
    return f"(CAST(SUM(CAST(({expr}) AS DECIMAL(28,15))) AS DOUBLE) / nullif(count({expr}), 0))"


_CHANNELS = "['Paid Search','Paid Social','Organic','Referral','Email','Affiliate','Direct']"
_PAID = "['Paid Search','Paid Social','Referral','Email','Affiliate']"
_PLAN = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Free' WHEN 'BUILDING' THEN 'Starter'
    WHEN 'FURNITURE' THEN 'Pro' WHEN 'HOUSEHOLD' THEN 'Business' WHEN 'MACHINERY' THEN 'Enterprise' END"""
_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
_DAY = "CAST(DATE '1995-01-01' + CAST((event_id * 37) % 2404 AS INTEGER) AS DATE)"
_MOMENT = f"CAST({_DAY} AS TIMESTAMP) + (ts - date_trunc('day', ts))"

CTES: dict[str, str] = {}

CTES["stg_customers"] = f"""
SELECT c_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN c_custkey % 67 <> 0 THEN lower(c_name) || '@example.com' END AS email,
    (SELECT CAST(min(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS signup_date,
    r_name AS region, n_name AS country,
    {_CHANNELS}[c_custkey % 7 + 1] AS acquisition_channel,
    {_PLAN} AS plan,
    CAST(floor(c_acctbal / 10) AS INTEGER) AS company_size,
    c_mktsegment AS industry,
    CAST(c_custkey % 8 = 0 AS INTEGER) AS is_high_value_seed,
    CASE WHEN floor(c_acctbal / 10) < 100 THEN 'SMB' WHEN floor(c_acctbal / 10) < 500 THEN 'Mid-Market'
         ELSE 'Enterprise' END AS segment_band
FROM customer, nation, region
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
"""

CTES["stg_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
    CAST(o_orderdate AS DATE) AS order_date,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
    o_totalprice AS gross_amount, CAST(0 AS DOUBLE) AS discount_pct, o_totalprice AS net_amount,
    CAST(coalesce(lines, 0) AS INTEGER) AS num_items,
    o_orderpriority AS channel,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'refunded' ELSE 'pending' END AS status,
    CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE CAST(0 AS DOUBLE) END AS recognized_revenue,
    o_orderstatus = 'F' AS is_recognized
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey)
    ON l_orderkey = o_orderkey
"""

CTES["stg_subscriptions"] = f"""
SELECT 700000 + c_custkey AS subscription_id, c_custkey AS customer_id, {_PLAN} AS plan,
    CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 49 WHEN 'FURNITURE' THEN 149
         WHEN 'HOUSEHOLD' THEN 499 WHEN 'MACHINERY' THEN 1499 END AS DOUBLE) AS mrr,
    lo AS start_date,
    CASE WHEN gone IS NOT NULL THEN 'churned' WHEN c_custkey % 33 = 0 THEN 'paused' ELSE 'active' END AS status,
    gone AS churn_date,
    CAST(datediff('month', lo, coalesce(gone, newest)) AS INTEGER) AS months_active,
    CASE WHEN c_custkey % 10 < 7 THEN 'monthly' ELSE 'annual' END AS billing_interval,
    gone IS NOT NULL AS is_churned,
    gone IS NULL AND c_custkey % 33 <> 0 AS is_active
FROM customer JOIN (
    SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, any_value(newest) AS newest,
        CASE WHEN CAST(max(o_orderdate) AS DATE) + 90 <= any_value(newest)
             THEN CAST(max(o_orderdate) AS DATE) + 90 END AS gone
    FROM orders, (SELECT CAST(max(o_orderdate) AS DATE) AS newest FROM orders)
    GROUP BY o_custkey) ON o_custkey = c_custkey
"""

CTES["stg_web_sessions"] = f"""
SELECT 'S' || event_id AS session_id, {_MOMENT} AS session_ts, {_DAY} AS session_date,
    CAST(date_trunc('month', {_DAY}) AS DATE) AS session_month,
    {_CHANNELS}[{_K} % 7 + 1] AS channel,
    ['desktop','mobile','tablet'][{_K} % 3 + 1] AS device,
    ['/','/pricing','/features','/blog','/demo','/signup'][{_K} % 6 + 1] AS landing_page,
    {_K} % 13 + 1 AS pages_viewed, {_K} * 10 AS duration_sec,
    CAST(event_type = 'purchase' AS INTEGER) AS converted,
    CASE WHEN event_type = 'purchase' THEN user_id END AS customer_id
FROM events
"""

CTES["stg_events"] = f"""
SELECT event_id, user_id AS customer_id, event_type, {_MOMENT} AS event_ts, {_DAY} AS event_date,
    ['web','ios','android','api'][{_K} % 4 + 1] AS platform,
    '3.' || ({_K} % 10) AS app_version,
    CAST(floor(value * 60) AS BIGINT) AS session_len_sec,
    ['dashboard','reports','exports','billing','integrations','admin','search'][{_K} % 7 + 1] AS feature
FROM events
"""

CTES["stg_marketing_spend"] = f"""
SELECT spend_date, spend_date AS spend_month, channel, region, CAST(total AS DOUBLE) AS spend, impressions, clicks
FROM (
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS spend_date, {_PAID}[l_suppkey % 5 + 1] AS channel,
        r_name AS region,
        SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS total,
        CAST(SUM(l_quantity) AS BIGINT) AS impressions, count(*) AS clicks
    FROM lineitem, supplier, nation, region
    WHERE l_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
    GROUP BY ALL)
"""

CTES["span"] = """
SELECT min(d) AS first_day, max(d) AS last_day, max(d) FILTER (WHERE src = 'o') AS last_order_day
FROM (SELECT order_date AS d, 'o' AS src FROM stg_orders UNION ALL SELECT session_date, 's' FROM stg_web_sessions)
"""

CTES["dim_date"] = """
SELECT CAST(day AS DATE) AS date_key, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter,
    CAST(month(day) AS INTEGER) AS month_num, monthname(day) AS month_name,
    CAST(date_trunc('month', day) AS DATE) AS month_start, CAST(weekofyear(day) AS INTEGER) AS week_num,
    CAST(dayofweek(day) AS INTEGER) AS day_of_week, dayname(day) AS day_name,
    dayofweek(day) = 0 OR dayofweek(day) = 6 AS is_weekend
FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS day FROM span)
"""

CTES["dim_customers"] = f"""
SELECT b.customer_id, customer_name, email, signup_date, region, country, acquisition_channel, plan, company_size,
    segment_band, industry, is_high_value_seed,
    coalesce(n_orders, 0) AS lifetime_orders, coalesce(earned, 0) AS lifetime_revenue,
    coalesce(basket, 0) AS avg_order_value, first_order_date, last_order_date,
    coalesce(price, 0) AS mrr, coalesce(any_active, false) AS has_active_sub, coalesce(any_churned, false) AS has_churned,
    coalesce(tenure, 0) AS tenure_months, coalesce(n_events, 0) AS lifetime_events,
    CAST((SELECT max(order_date) FROM stg_orders) - last_order_date AS INTEGER) AS recency_days
FROM stg_customers b
LEFT JOIN (SELECT customer_id, count(*) AS n_orders, {money("recognized_revenue")} AS earned,
        {money_avg("CASE WHEN is_recognized THEN net_amount END")} AS basket,
        min(order_date) AS first_order_date, max(order_date) AS last_order_date
    FROM stg_orders GROUP BY customer_id) o USING (customer_id)
LEFT JOIN (SELECT customer_id, max(mrr) AS price, bool_or(is_active) AS any_active, bool_or(is_churned) AS any_churned,
        max(months_active) AS tenure FROM stg_subscriptions GROUP BY customer_id) s USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS n_events FROM stg_events GROUP BY customer_id) e USING (customer_id)
"""
CTES["fct_orders"] = """
SELECT order_id, customer_id, order_ts, order_date, order_month, c.region, c.plan, c.segment_band,
    c.acquisition_channel, channel AS order_channel, gross_amount, discount_pct, net_amount, recognized_revenue,
    num_items, status, is_recognized
FROM stg_orders LEFT JOIN stg_customers AS c USING (customer_id)
"""

CTES["fct_subscriptions"] = """
SELECT subscription_id, customer_id, c.region, c.acquisition_channel, c.segment_band, f.plan, mrr, 12 * mrr AS arr,
    start_date, CAST(date_trunc('month', start_date) AS DATE) AS cohort_month, status, churn_date, months_active,
    billing_interval, is_churned, is_active
FROM stg_subscriptions AS f LEFT JOIN stg_customers AS c USING (customer_id)
"""

CTES["kpi_daily"] = f"""
SELECT date_key, year, quarter, month_name, day_name, is_weekend,
    coalesce(rev, 0) AS recognized_revenue, coalesce(n, 0) AS total_orders, coalesce(n_done, 0) AS completed_orders,
    coalesce(n_back, 0) AS refunded_orders, coalesce(buyers, 0) AS ordering_customers,
    coalesce(basket, 0) AS avg_order_value,
    (SELECT count(*) FROM stg_customers WHERE signup_date = date_key) AS new_customers,
    coalesce(visits, 0) AS sessions, coalesce(won, 0) AS conversions,
    coalesce(CAST(won AS DOUBLE) / visits, 0) AS conversion_rate,
    (SELECT count(*) FROM stg_events WHERE event_date = date_key) AS product_events
FROM dim_date
LEFT JOIN (SELECT order_date AS date_key, {money("recognized_revenue")} AS rev, count(*) AS n,
        count(CASE WHEN is_recognized THEN 1 END) AS n_done, count(CASE WHEN status = 'refunded' THEN 1 END) AS n_back,
        count(DISTINCT customer_id) AS buyers, {money_avg("CASE WHEN is_recognized THEN net_amount END")} AS basket
    FROM stg_orders GROUP BY order_date) USING (date_key)
LEFT JOIN (SELECT session_date AS date_key, count(*) AS visits, CAST(sum(converted) AS BIGINT) AS won
    FROM stg_web_sessions GROUP BY session_date) USING (date_key)
"""

CTES["months"] = """
SELECT CAST(unnest(generate_series(date_trunc('month', first_day), date_trunc('month', last_order_day),
    INTERVAL 1 MONTH)) AS DATE) AS month
FROM span
"""

CTES["kept"] = """
SELECT CAST(date_trunc('month', signup_date) AS DATE) AS month, count(*) AS cohort_size,
    count(*) FILTER (WHERE EXISTS (SELECT 1 FROM stg_events e WHERE e.customer_id = c.customer_id
        AND e.event_date - c.signup_date BETWEEN 30 AND 59)) AS retained_30d,
    max(signup_date) + 60 <= (SELECT max(event_date) FROM stg_events) AS ripe
FROM stg_customers c WHERE signup_date IS NOT NULL GROUP BY ALL
"""

CTES["month_facts"] = f"""
SELECT month, rev, n_done, n_back, basket,
    (SELECT count(*) FROM stg_customers WHERE date_trunc('month', signup_date) = month) AS joined,
    (SELECT count(*) FROM stg_subscriptions
        WHERE start_date < month AND coalesce(churn_date, DATE '9999-12-31') >= month) AS base,
    (SELECT count(*) FROM stg_subscriptions WHERE date_trunc('month', churn_date) = month) AS lost,
    (SELECT count(*) FROM stg_subscriptions
        WHERE start_date <= month AND coalesce(churn_date, DATE '9999-12-31') > month) AS live,
    coalesce((SELECT {money("mrr")} FROM stg_subscriptions
        WHERE start_date <= month AND coalesce(churn_date, DATE '9999-12-31') > month), 0) AS live_mrr,
    (SELECT {money("spend")} FROM stg_marketing_spend WHERE spend_month = month) AS paid,
    (SELECT count(*) FROM stg_web_sessions WHERE session_month = month) AS visits,
    coalesce((SELECT CAST(sum(converted) AS BIGINT) FROM stg_web_sessions WHERE session_month = month), 0) AS won
FROM months LEFT JOIN (
    SELECT order_month AS month, {money("recognized_revenue")} AS rev,
        sum(CASE WHEN is_recognized THEN 1 ELSE 0 END) AS n_done,
        sum(CASE WHEN status = 'refunded' THEN 1 ELSE 0 END) AS n_back,
        {money_avg("CASE WHEN is_recognized THEN net_amount END")} AS basket
    FROM stg_orders GROUP BY order_month) USING (month)
"""

CTES["kpi_monthly"] = """
SELECT month, CAST(year(month) AS INTEGER) AS year, strftime(month, '%Y-%m') AS month_label,
    coalesce(rev, 0) AS recognized_revenue,
    CAST(coalesce(n_done, 0) AS BIGINT) AS completed_orders, CAST(coalesce(n_back, 0) AS BIGINT) AS refunded_orders,
    CASE WHEN n_done + n_back > 0 THEN CAST(n_back AS DOUBLE) / CAST(n_done + n_back AS DOUBLE) ELSE 0 END AS refund_rate,
    coalesce(basket, 0) AS avg_order_value,
    joined AS new_customers, live_mrr AS active_mrr, live AS active_customers,
    CASE WHEN live > 0 THEN rev / live ELSE 0 END AS arpa,
    lost AS churned_customers, base AS active_at_start,
    CASE WHEN base > 0 THEN CAST(lost AS DOUBLE) / base ELSE 0 END AS churn_rate,
    coalesce(paid, 0) AS marketing_spend,
    CASE WHEN joined > 0 THEN paid / joined ELSE 0 END AS cac,
    CASE WHEN least(live, base, lost) > 0 THEN (rev / live) / (CAST(lost AS DOUBLE) / base) ELSE 0 END AS ltv,
    visits AS sessions, won AS conversions,
    CASE WHEN visits > 0 THEN CAST(won AS DOUBLE) / visits ELSE 0 END AS conversion_rate,
    coalesce(cohort_size, 0) AS cohort_size, coalesce(retained_30d, 0) AS retained_30d,
    coalesce(ripe, false) AS cohort_is_mature,
    coalesce(CAST(retained_30d AS DOUBLE) / cohort_size, 0) AS retention_30d
FROM month_facts LEFT JOIN kept USING (month)
"""

CTES["scored"] = """
SELECT *, CASE WHEN revenue_decile > 8 THEN 'High-Value' WHEN revenue_decile > 5 THEN 'Core'
    WHEN revenue_decile > 2 THEN 'Occasional' ELSE 'Dormant' END AS value_tier
FROM (SELECT *,
    CAST(ntile(10) OVER (ORDER BY lifetime_revenue, customer_id) AS INTEGER) AS revenue_decile,
    CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_id) AS INTEGER) AS r_score,
    CAST(ntile(5) OVER (ORDER BY lifetime_orders, customer_id) AS INTEGER) AS f_score,
    CAST(ntile(5) OVER (ORDER BY lifetime_revenue, customer_id) AS INTEGER) AS m_score
    FROM dim_customers)
"""

CTES["totals"] = f"""
SELECT {money("lifetime_revenue")} AS total_revenue, count(*) AS total_customers,
    {money("lifetime_revenue * is_high_value_seed")} AS flagged_revenue,
    CAST(sum(is_high_value_seed) AS DOUBLE) AS flagged_customers
FROM dim_customers
"""

CTES["tiers"] = f"""
SELECT value_tier, {money("lifetime_revenue")} AS tier_revenue, CAST(count(*) AS DOUBLE) AS tier_customers
FROM scored GROUP BY value_tier
"""

CTES["customer_segments"] = """
SELECT customer_id, customer_name, region, plan, segment_band, acquisition_channel, industry, signup_date,
    lifetime_orders, lifetime_revenue, avg_order_value, mrr, tenure_months, lifetime_events, recency_days,
    has_active_sub, has_churned, revenue_decile, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_score,
    value_tier, is_high_value_seed AS priority_segment, total_revenue, total_customers,
    lifetime_revenue / total_revenue AS revenue_share, tier_revenue / total_revenue AS tier_revenue_share,
    tier_customers / total_customers AS tier_customer_share, flagged_revenue / total_revenue AS priority_revenue_share,
    flagged_customers / total_customers AS priority_customer_share
FROM scored JOIN tiers USING (value_tier) CROSS JOIN totals
"""

CTES["cohort_retention"] = """
SELECT cohort_month, strftime(cohort_month, '%Y-%m') AS cohort_label, gap AS months_since_signup, cohort_size,
    count(DISTINCT customer_id) AS active_customers,
    CAST(count(DISTINCT customer_id) AS DOUBLE) / cohort_size AS retention_rate
FROM (
    SELECT month AS cohort_month, cohort_size, c.customer_id,
        CAST(datediff('month', c.signup_date, e.event_date) AS INTEGER) AS gap
    FROM kept, stg_customers c, stg_events e
    WHERE month = date_trunc('month', c.signup_date) AND e.customer_id = c.customer_id)
WHERE gap >= 0 AND gap <= 12 GROUP BY cohort_month, gap, cohort_size
"""
