from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import d
from tidebook.plans.measures import measure
from tidebook.plans.star import RELATIONSHIPS, Star

DAYS = [(d("2024-01-05"), 2024, 1, False), (d("2024-02-03"), 2024, 2, True), (d("2024-02-04"), 2024, 2, True)]
PEOPLE = [(1, "EMEA", 10), (2, "APAC", 20), (3, "EMEA", 30)]
SEGMENTS = [(1, "High-Value"), (2, "Core"), (3, "Core")]
ORDERS = [  # order 5 has no customer row, order 6 none at all, order 7 no day
    (1, 1, d("2024-01-05"), 10.0, "EMEA"),
    (2, 1, d("2024-02-03"), 20.0, "EMEA"),
    (3, 2, d("2024-02-04"), 40.0, "APAC"),
    (4, 3, d("2024-02-03"), 80.0, "EMEA"),
    (5, 9, d("2024-02-03"), 160.0, None),
    (6, None, d("2024-01-05"), 320.0, None),
    (7, 3, None, 640.0, "EMEA"),
]
SUBSCRIPTIONS = [(1, 1, 5.0, True), (2, 2, 7.0, True), (3, 9, 9.0, True), (4, 3, 11.0, False)]


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "dim_date": make(DAYS, "date_key date, year int, month_num int, is_weekend boolean"),
        "dim_customers": make(PEOPLE, "customer_id int, region string, company_size int"),
        "customer_segments": make(SEGMENTS, "customer_id int, value_tier string"),
        "fct_orders": make(ORDERS, "order_id int, customer_id int, order_date date, recognized_revenue double, region string"),
        "fct_subscriptions": make(SUBSCRIPTIONS, "subscription_id int, customer_id int, mrr double, is_active boolean"),
        "kpi_daily": make([(day[0], 1) for day in DAYS], "date_key date, sessions int"),
        "kpi_monthly": make([(d("2024-01-01"), 3)], "month date, sessions int"),
    }


@pytest.fixture
def star(tables):
    return Star(tables)


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.mark.parametrize(
    ("where", "want"),
    [
        ({}, [1, 2, 3, 4, 5, 6, 7]),
        ({"dim_customers": "region = 'EMEA'"}, [1, 2, 4, 7]),
        ({"dim_customers": "true"}, [1, 2, 3, 4, 7]),  # rows without a dimension row go
        ({"dim_date": "is_weekend"}, [2, 3, 4, 5]),
        ({"dim_date": "is_weekend", "dim_customers": "company_size < 25"}, [2, 3]),
        ({"customer_segments": "value_tier = 'Core'"}, [3, 4, 7]),
        ({"customer_segments": "value_tier = 'Core'", "dim_customers": "region = 'EMEA'"}, [4, 7]),
        ({"fct_orders": "recognized_revenue < 50", "dim_date": "is_weekend"}, [2, 3]),
        ({"fct_subscriptions": "mrr > 100"}, [1, 2, 3, 4, 5, 6, 7]),  # a fact does not filter another
        ({"kpi_monthly": "sessions > 100"}, [1, 2, 3, 4, 5, 6, 7]),  # standalone
        ({"dim_customers": "region = 'none'"}, []),
    ],
)
def test_filters_reach_the_orders(star, where, want):
    assert ids(star.sliced("fct_orders", where)) == want


def test_facts_leave_dimensions_alone_but_one_to_one_goes_both_ways(star):
    assert ids(star.sliced("dim_customers", {"fct_orders": "order_id = 1"}).select("customer_id")) == [1, 2, 3]
    assert ids(star.sliced("dim_customers", {"customer_segments": "value_tier = 'Core'"}).select("customer_id")) == [2, 3]
    assert ids(star.sliced("customer_segments", {"dim_customers": "region = 'EMEA'"}).select("customer_id")) == [1, 3]


def test_every_relationship_passes_a_filter(star, tables):
    for r in RELATIONSHIPS:
        left = star.sliced(r.many, {r.one: F.lit(False)})
        assert left.count() == 0 < tables[r.many].count()


def test_unknown_tables_and_columns(star):
    with pytest.raises(KeyError, match="nowhere"):
        star.sliced("fct_orders", {"nowhere": "true"})
    with pytest.raises(KeyError, match="no dimension"):
        star.aggregate("kpi_monthly", {"n": F.count(F.lit(1))}, ["dim_customers.region"])
    with pytest.raises(KeyError, match="no column"):
        star.aggregate("fct_subscriptions", {"n": F.count(F.lit(1))}, ["region"])
    with pytest.raises(ValueError, match="one name"):
        star.grouped("fct_orders", ["region", "dim_customers.region"])


def test_groups_by_dimension_columns(star, rows):
    total = {"total": F.sum("recognized_revenue")}
    assert rows(star.aggregate("fct_orders", total, ["dim_customers.company_size"])) == [(None, 480.0), (10, 30.0), (20, 40.0), (30, 720.0)]
    assert rows(star.aggregate("fct_orders", total, ["dim_customers.region"])) == [(None, 480.0), ("APAC", 40.0), ("EMEA", 750.0)]
    assert rows(star.aggregate("fct_orders", total, ["dim_date.month_num"], {"dim_customers": "region = 'EMEA'"})) == [(None, 640.0), (1, 10.0), (2, 100.0)]


def test_measures_over_two_facts_agree_under_one_filter(tables, rows):
    got = measure(["recognized_revenue", "active_mrr", "arpa"], tables, ["dim_customers.region"], {"dim_customers": "company_size < 25"})
    assert rows(got) == [("APAC", 40.0, 7.0, 40.0), ("EMEA", 30.0, 5.0, 30.0)]
    assert rows(measure(["recognized_revenue", "active_mrr", "sessions"], tables, (), {"dim_customers": "region = 'EMEA'"})) == [(750.0, 5.0, 3)]
    blank = measure(["recognized_revenue", "active_mrr"], tables, ["dim_customers.region"])
    assert rows(blank)[0] == (None, 480.0, 9.0)  # rows without a customer are one group


def test_calendar_measures_see_the_month_before_the_slice(tables, rows):
    names = ["recognized_revenue", "recognized_revenue_pm", "revenue_ytd"]
    got = measure(names, tables, (), {"dim_date": "is_weekend", "dim_customers": "region = 'EMEA'"})
    assert rows(got) == [(d("2024-02-01"), 100.0, 10.0, 110.0)]


def test_tables_that_no_filter_needs_stay_out_of_the_plan(star):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(star.sliced("fct_orders", {"kpi_monthly": "sessions > 1"}))
    through = plan(star.sliced("fct_orders", {"customer_segments": "value_tier = 'Core'"}))
    assert "LeftSemi" in through and "company_size" not in through


def test_a_large_key_set_becomes_a_bloom_filter(spark, tmp_path):
    """Shuffled by key on both sides, the fact loses its rows at the scan."""
    spark.range(20_000).selectExpr("id AS customer_id", "id % 50 AS region").write.parquet(str(tmp_path / "dim"))
    spark.range(200_000).selectExpr("id AS order_id", "id % 20000 AS customer_id").write.parquet(str(tmp_path / "fact"))
    tables = {"dim_customers": spark.read.parquet(str(tmp_path / "dim")), "fct_orders": spark.read.parquet(str(tmp_path / "fact"))}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = Star(tables).sliced("fct_orders", {"dim_customers": "region = 7"})
        assert "might_contain" in left._jdf.queryExecution().optimizedPlan().toString()
        assert left.count() == 4_000
    finally:
        for k in settings:
            spark.conf.unset(k)
