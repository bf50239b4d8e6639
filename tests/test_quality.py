from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import customer, d, order, staged, subscription
from tidebook.operators import quality as Q
from tidebook.plans.warehouse import mart_suite, source_suite, staging_suite


@pytest.fixture(scope="module")
def broken(spark):
    """One fault of each kind."""
    return staged(
        spark,
        customers=[customer(1, "2024-01-01"), customer(2, "2024-01-01", plan="Gold", email=""), customer(2, "2024-01-01")],
        orders=[
            order(1, 1, "2024-01-02 00:00", 5.0),
            order(1, 1, "2024-01-02 00:00", -5.0),
            order(None, 7, "2024-01-02 00:00", 5.0, "lost"),
            order(4, None, "2024-01-02 00:00", 5.0),
        ],
        subscriptions=[subscription(1, 1, "2024-01-01", mrr=-1.0)],
    )


def test_failing_rows(broken, rows):
    assert rows(Q.unique(broken.orders, "order_id")) == [(1, 2)]
    assert rows(Q.not_null(broken.orders, ["order_id", "customer_id", "status"])) == [
        ("customer_id", 1),
        ("order_id", 1),
        ("status", 0),
    ]
    assert rows(Q.relationships(broken.orders, "customer_id", broken.customers, "customer_id")) == [(7, 1)]
    assert rows(Q.accepted(broken.customers, "plan", ["Pro", "Free"])) == [("Gold", 1)]
    assert rows(Q.bounds(broken.orders, "net_amount", lo=0.0), "net_amount") == [(-5.0,)]
    assert rows(Q.bounds(broken.subscriptions, "mrr", 0.0, 10.0), "mrr") == [(-1.0,)]


def test_suite_counts_each_fault_once(broken, rows):
    suite = staging_suite()
    tables = broken.by_name
    failed = rows(Q.run_checks(tables, suite).where("status = 'fail'"), "check_name", "table_name", "column_name", "failures")
    assert sorted(failed) == [
        ("accepted_values", "stg_customers", "plan", 1),
        ("accepted_values", "stg_orders", "status", 1),
        ("bounds", "stg_orders", "net_amount", 1),
        ("bounds", "stg_subscriptions", "mrr", 1),
        ("not_null", "stg_orders", "customer_id", 1),
        ("not_null", "stg_orders", "order_id", 1),
        ("relationships", "stg_orders", "customer_id", 1),
        ("unique", "stg_customers", "customer_id", 1),
        ("unique", "stg_orders", "order_id", 1),
    ]


def test_the_number_of_declared_tests():
    def size(suite):
        return sum(len(e.unique) + len(e.not_null) + len(e.relationships) + len(e.accepted) + len(e.bounds) for e in suite.values())

    # 12 on sources, 19 + 2 on staging, 22 + 1 on marts; the reconciliation makes 57.
    assert (size(source_suite()), size(staging_suite()), size(mart_suite())) == (12, 21, 23)


def test_reconcile_tolerance(spark, rows):
    a = spark.createDataFrame([(1.5,), (1.0,)], "v double")
    b = spark.createDataFrame([(1.5,)], "v double")
    assert rows(Q.reconcile(a, b, "v", 1.0)) == []
    assert rows(Q.reconcile(a, b, "v", 0.9)) == [(2.5, 1.5)]


@pytest.mark.parametrize("as_of, status", [("2024-01-02 11:00:00", "pass"), ("2024-01-02 13:00:00", "warn"), ("2024-01-04 01:00:00", "error")])
def test_freshness_after_35_37_and_73_hours(spark, as_of, status):
    df = spark.sql("SELECT timestamp '2024-01-01 00:00:00' AS _ingested_at")
    assert Q.freshness(df, as_of).first()["status"] == status


def test_a_table_never_loaded_is_an_error(spark):
    df = spark.sql("SELECT timestamp '2024-01-01 00:00:00' AS _ingested_at").where("1 = 0")
    assert Q.freshness(df, "2024-01-01 00:00:00").first()["status"] == "error"


def test_null_rate(broken, rows):
    assert rows(Q.null_rate(broken.customers, "email", 0.02), "status") == [("fail",)]
    assert rows(Q.null_rate(broken.customers, "email", 0.34), "status") == [("pass",)]


def test_gate_and_refusal(broken, rows, spark):
    checks = Q.run_checks(broken.by_name, {"stg_orders": Q.Expect(unique=["order_id"], not_null=["status"])})
    assert rows(Q.gate(checks)) == [(2, 1, False)]
    with pytest.raises(Q.ChecksFailed, match="unique.stg_orders.order_id"):
        Q.require_passing(checks)
    Q.require_passing(checks.where("status = 'pass'"))
    warned = checks.withColumn("status", F.lit("warn"))
    Q.require_passing(warned)
    assert rows(Q.bounds(spark.createDataFrame([(d("2024-01-01"), 1.2)], "month date, churn_rate double"), "churn_rate", 0.0, 1.0), "churn_rate") == [(1.2,)]


def test_row_tests_of_a_table_are_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(1, "a", 0.5), (None, "z", 2.0), (None, "z", -1.0), (4, "y", None), (5, None, 0.0)], "id int, kind string, x double")
    spec = Q.Expect(not_null=["id", "kind", "x"], bounds={"x": (0.0, 1.0)}, accepted={"kind": ["a", "b"], "id": [1, 4, 5]})
    got = Q.run_checks({"t": df.mapInArrow(tell, df.schema)}, {"t": spec})
    assert sorted((r["check_name"], r["column_name"], r["failures"], r["status"]) for r in got.collect()) == [
        ("accepted_values", "id", 0, "pass"),
        ("accepted_values", "kind", 2, "fail"),
        ("bounds", "x", 2, "fail"),
        ("not_null", "id", 2, "fail"),
        ("not_null", "kind", 1, "fail"),
        ("not_null", "x", 1, "fail"),
    ]
    assert seen.value == 5
