from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import customer, d, event, order, session, spend, staged, subscription
from tidebook.plans import analysis, dashboard
from tidebook.plans.kpis import scorecard
from tidebook.plans.marts import customer_segments
from tidebook.plans.measures import BY_MONTH, MEASURES, measure
from tidebook.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    """Three months; January starts the spine and April's session lies past the last order."""
    return Warehouse(
        staged(
            spark,
            customers=[
                customer(1, "2024-01-10", seed=1, channel="Paid Search"),
                customer(2, "2024-02-01", region="APAC"),
                customer(3, "2024-02-15", plan="Free"),
                customer(4, "2023-12-31"),
            ],
            orders=[
                order(1, 1, "2024-01-15 09:00", 100.10),
                order(2, 1, "2024-01-15 10:00", 50.0, "refunded"),
                order(3, 2, "2024-01-20 10:00", 200.20),
                order(4, 2, "2024-03-02 10:00", 10.0, "refunded"),
                order(5, 1, "2024-03-05 10:00", 0.30),
                order(6, 99, "2024-03-06 10:00", 5.0, "pending"),
            ],
            subscriptions=[
                subscription(1, 1, "2024-01-01", "2024-03-01", mrr=49.0),
                subscription(2, 2, "2024-02-10", mrr=100.0),
                subscription(3, 3, "2024-02-15", "2024-02-20", mrr=7.0),
            ],
            sessions=[
                session(1, "2024-01-05 10:00", 1, "1"),
                session(2, "2024-01-06 10:00"),
                session(3, "2024-04-01 10:00", 1, "2"),
            ],
            spends=[spend("2024-01-01", "Paid Search", 90.0), spend("2024-03-01", "Email", 10.0)],
            events=[event(1, 1, "2024-02-10 10:00"), event(2, 1, "2024-02-10 11:00"), event(3, 2, "2024-04-10 10:00")],
        )
    )


def monthly(wh, rows, *columns):
    return {r[0]: r[1:] for r in rows(wh.kpi_monthly, "month_label", *columns)}


def test_what_marts_share_is_written_once(wh, rows):
    done = wh.settled()
    for frame in (done.staged.customers, done.staged.subscriptions, done.dim_customers):
        assert frame.inputFiles()
    assert rows(done.staged.subscriptions) == rows(wh.staged.subscriptions)
    assert rows(wh.prepared().fct_subscriptions) == rows(wh.fct_subscriptions)


def test_customer_rollup(wh, rows):
    got = {r[0]: r[1:] for r in rows(wh.dim_customers, "customer_id", "lifetime_orders", "lifetime_revenue", "avg_order_value", "mrr", "lifetime_events", "recency_days")}
    assert got[1] == (3, 100.4, 50.2, 49.0, 2, 1)
    assert got[2] == (2, 200.2, 200.2, 100.0, 1, 4)
    assert got[4] == (0, 0.0, 0.0, 0.0, 0, None)  # never ordered


def test_only_refunded_orders_have_no_average(spark, rows):
    s = staged(spark, customers=[customer(1, "2024-01-01")], orders=[order(1, 1, "2024-01-02 00:00", 9.0, "refunded")])
    assert rows(Warehouse(s).dim_customers, "lifetime_orders", "avg_order_value", "lifetime_revenue") == [(1, 0.0, 0.0)]


def test_order_of_an_unknown_customer_is_kept(wh, rows):
    got = {r[0]: r[1] for r in rows(wh.fct_orders, "order_id", "region")}
    assert got[6] is None and got[3] == "APAC" and len(got) == 6


def test_monthly_spine_and_revenue(wh, rows):
    got = monthly(wh, rows, "recognized_revenue", "completed_orders", "refunded_orders", "refund_rate", "avg_order_value")
    assert got == {
        "2024-01": (300.3, 2, 1, 1 / 3, 150.15),
        "2024-02": (0.0, 0, 0, 0.0, 0.0),
        "2024-03": (0.3, 1, 1, 0.5, 0.3),
    }


def test_monthly_subscription_levels(wh, rows):
    """Churn on 1 March counts as active at the start of March but not as active."""
    got = monthly(wh, rows, "active_at_start", "churned_customers", "churn_rate", "active_customers", "active_mrr")
    assert got == {
        "2024-01": (0, 0, 0.0, 1, 49.0),
        "2024-02": (1, 1, 1.0, 1, 49.0),
        "2024-03": (2, 1, 0.5, 1, 100.0),
    }


def test_monthly_null_ratios(wh, rows):
    """Active customers without any order row: ARPA and LTV are NULL, not 0."""
    got = monthly(wh, rows, "arpa", "ltv", "new_customers", "marketing_spend", "cac")
    assert got["2024-01"] == (300.3, 0.0, 1, 90.0, 90.0)  # no churn: LTV 0
    assert got["2024-02"] == (None, None, 2, 0.0, None)  # customers, but no spend row
    assert got["2024-03"] == (0.3, 0.6, 0, 10.0, 0.0)  # spend, but no new customer


def test_monthly_sessions_and_retention(wh, rows):
    got = monthly(wh, rows, "sessions", "conversions", "conversion_rate", "cohort_size", "retained_30d", "cohort_is_mature")
    assert got["2024-01"] == (2, 1, 0.5, 1, 1, True)
    assert got["2024-02"] == (0, 0, 0.0, 2, 0, False)
    assert got["2024-03"] == (0, 0, 0.0, 0, 0, False)


def test_groups_give_the_same_columns_as_the_whole_table(wh, rows):
    for groups in (("revenue",), ("subscriptions",), ("spend", "signups"), ("sessions",), ("retention",)):
        part = wh.kpis(*groups)
        assert rows(part) == rows(wh.kpi_monthly.select(*part.columns))


def test_daily(wh, rows):
    got = {r[0]: r[1:] for r in rows(wh.kpi_daily, "date_key", "total_orders", "ordering_customers", "recognized_revenue", "new_customers", "sessions", "product_events")}
    assert len(got) == (d("2024-04-01") - d("2024-01-05")).days + 1
    assert got[d("2024-01-15")] == (2, 1, 100.1, 0, 0, 0)
    assert got[d("2024-02-10")] == (0, 0, 0.0, 0, 0, 2)
    assert got[d("2024-01-10")] == (0, 0, 0.0, 1, 0, 0)
    assert d("2023-12-31") not in got  # a signup before the calendar starts


def test_subscriptions_fact(wh, rows):
    assert rows(wh.fct_subscriptions, "subscription_id", "arr", "cohort_month", "region")[1] == (2, 1200.0, d("2024-02-01"), "APAC")


@pytest.fixture(scope="module")
def segments(spark):
    """100 customers with revenue 1..100, two of them flagged, one never ordered."""
    people = [customer(i, "2024-01-01", seed=int(i in (99, 100))) for i in range(1, 102)]
    orders = [order(i, i, f"2024-0{1 + i % 6}-03 00:00", float(i)) for i in range(1, 101)]
    return customer_segments(Warehouse(staged(spark, customers=people, orders=orders)).dim_customers)


def test_tiers_and_shares(segments, rows):
    got = {r[0]: r[1:] for r in rows(segments, "customer_id", "revenue_decile", "value_tier", "m_score", "priority_revenue_share", "total_customers")}
    assert got[100] == (10, "High-Value", 5, 199 / 5050, 101)
    assert got[101][:2] == (1, "Dormant")
    assert segments.agg(F.sum("revenue_share")).first()[0] == pytest.approx(1.0)


def test_customers_without_orders_score_best_on_recency_unless_told_otherwise(segments, spark, rows):
    assert rows(segments.where("customer_id = 101"), "r_score", "recency_days") == [(5, None)]
    base = segments.withColumn("is_high_value_seed", F.col("priority_segment"))
    worst = customer_segments(base, null_recency="worst")
    assert rows(worst.where("customer_id = 101"), "r_score", "recency_days") == [(1, None)]


def test_pareto_is_exact(segments, rows):
    got = dict(rows(analysis.pareto(segments, rows_per_range=7)))
    want = {f"{b}%": round(100 * sum(range(101 - 101 * b // 100, 101)) / 5050, 1) for b in (10, 20, 30, 50)}
    assert got == want


def test_pareto_of_few_customers_has_only_reached_buckets(segments, rows):
    assert rows(analysis.pareto(segments.where("customer_id <= 5"))) == [("20%", 33.3)]
    assert rows(analysis.pareto(segments.where("customer_id < 0"))) == []


def test_concentration(segments, rows):
    assert rows(analysis.concentration(segments)) == [
        ("Everyone else", 99, 98.0, 4851.0, 96.1),
        ("Priority (high-value)", 2, 2.0, 199.0, 3.9),
    ]


def test_channel_without_spend(wh, rows):
    got = {r[0]: r[1:] for r in rows(analysis.channel_efficiency(wh.fct_orders, wh.staged.marketing_spend))}
    assert got["Organic"] == (1, 0.0, 0.0, 200.0, None)
    assert got["Paid Search"] == (1, 90.0, 90.0, 100.0, 1.12)


def test_regional_scorecard_weights_by_orders(wh, rows):
    """EMEA: customer 1 has three orders, 3 and 4 have none and count once."""
    got = {r[0]: r[1:] for r in rows(analysis.regional_scorecard(wh.dim_customers))}
    assert got["EMEA"] == (3, 100.0, round(3 * 100.4 / 5), 0.0)
    assert got["APAC"] == (1, 200.0, 200.0, 100.0)


def test_prior_month_does_not_skip_gaps(spark, rows):
    m = spark.createDataFrame([(d("2024-01-01"), 1.0), (d("2024-03-01"), 3.0)], "month date, v double")
    assert rows(analysis.prior_month(m, "v")) == [(d("2024-01-01"), 1.0, None), (d("2024-03-01"), 3.0, None)]


def test_scorecard_compares_complete_months(wh, rows):
    got = {r[0]: r[1:] for r in rows(scorecard(wh.kpi_monthly, wh.staged.orders), "kpi", "month_label", "value", "prior", "delta_pct", "delta_good", "status")}
    # March holds the newest order, so February is reported against January.
    assert got["recognized_revenue"] == ("2024-02", 0.0, 300.3, -100.0, False, "off")
    assert got["churn_rate"] == ("2024-02", 1.0, 0.0, None, True, "off")
    assert got["cac"][1] is None and got["cac"][5] == "off"
    assert got["retention_30d"][:2] == ("2024-01", 1.0) and got["retention_30d"][5] == "on"


def test_scorecard_status_and_progress(spark, rows):
    km = spark.createDataFrame(
        [
            (d("2024-01-01"), "2024-01", 400000.0, 0.05, 1000.0, 2900.0, 0.04, 0.4, True),
            (d("2024-02-01"), "2024-02", 460000.0, 0.0, 0.0, 2900.0, 0.05, 0.52, False),
        ],
        "month date, month_label string, recognized_revenue double, churn_rate double, cac double, ltv double, "
        "conversion_rate double, retention_30d double, cohort_is_mature boolean",
    )
    got = {r[0]: r[1:] for r in rows(scorecard(km, None, as_of_month="2024-03-01"), "kpi", "status", "progress", "delta_pct")}
    assert got["recognized_revenue"] == ("watch", 0.92, 15.0)
    assert got["churn_rate"] == ("on", 1.0, -100.0)
    assert got["ltv"] == ("off", 0.0, None)  # no CAC: ratio 0
    assert got["retention_30d"] == ("off", 0.4 / 0.55, None)
    first = {r[0]: r[1:] for r in rows(scorecard(km, None, as_of_month="2024-02-01"), "kpi", "status", "prior")}
    assert first["ltv"] == ("watch", None) and first["recognized_revenue"] == ("off", None)


def test_dashboard_drops_null_groups_and_keeps_missing_plans(wh, rows):
    assert rows(dashboard.revenue_by(wh.fct_orders, "region")) == [("APAC", 200.2, 1), ("EMEA", 100.4, 2)]
    plans = {r[0]: r[1] for r in rows(dashboard.churn_by_plan(wh.staged.subscriptions))}
    assert plans == {"Free": None, "Starter": None, "Pro": 2 / 3, "Business": None, "Enterprise": None}


def test_refund_rate_of_a_slice_is_over_all_orders(wh, rows):
    assert rows(dashboard.revenue_summary(wh.fct_orders)) == [(300.6, 3, 100.2, 2 / 6)]
    assert rows(dashboard.revenue_summary(wh.fct_orders.where("order_id < 0"))) == [(0.0, 0, 0.0, 0.0)]


def test_every_measure_computes(wh):
    for name in MEASURES:
        df = measure(name, wh.marts)
        assert df.columns == (["month", name] if name in BY_MONTH else [name])
    assert set(measure("arpa", wh.marts, ("region",)).columns) == {"region", "arpa"}
    with pytest.raises(KeyError):
        measure("nonsense", wh.marts)


def test_drill_through(wh, rows):
    got = rows(dashboard.drill_through(2, wh.fct_orders, wh.fct_subscriptions, wh.customer_segments), "order_id", "subscription_id", "mrr")
    assert got == [(3, 2, 100.0), (4, 2, 100.0)]


def test_adhoc_sql_over_views(wh, spark, rows):
    wh.register_views(["stg_orders", "kpi_monthly"])
    assert rows(spark.sql("SELECT count(*) AS n FROM stg_orders")) == [(6,)]
    assert rows(spark.sql("SELECT max(month_label) AS m FROM kpi_monthly")) == [("2024-03",)]


def test_unused_feeds_leave_the_plan(wh):
    """A revenue query reads neither subscriptions nor spend."""
    plan = wh.kpis("revenue")._jdf.queryExecution().optimizedPlan().toString()
    assert "net_amount" in plan and "mrr" not in plan and "spend" not in plan


@pytest.mark.parametrize(("tiles", "tiers"), [(10, [2, 3, 3, 2]), (5, [1, 1, 2, 1])])
def test_value_tiers_follow_the_tiles(spark, tiles, tiers):
    """Dormant, Occasional, Core, High-Value: 2, 3, 3 and 2 tenths in whole tiles, rounded up for the higher ones."""
    from pyspark.sql import functions as F

    from tidebook.plans.marts import value_tier

    got = spark.range(1, tiles + 1).select(value_tier(F.col("id"), tiles).alias("t")).groupBy("t").count().collect()
    counts = {r["t"]: r["count"] for r in got}
    assert [counts.get(t, 0) for t in ("Dormant", "Occasional", "Core", "High-Value")] == tiers
