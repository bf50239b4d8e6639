from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fixtures import customer, event, order, session, spend, subscription, raw, d
from tidebook.operators.quality import ChecksFailed
from tidebook.operators.slicing import column_kinds, pivot_explore, slice_orders
from tidebook.plans.daily import run_daily
from tidebook.session import scratch_root, settle_counted
from tidebook.sources import export, flatten, land, read_csv, read_json_array, replace_table, row_floor
from tidebook.sources.schemas import EVENTS_NESTED


@pytest.fixture
def extracts(spark, tmp_path):
    """Five CSV files and one JSON array, as the source systems deliver them."""
    tables = raw(
        spark,
        customers=[customer(i, "2024-01-01", plan=p, region=r) for i, (p, r) in enumerate([("Pro", "EMEA"), ("Free", "APAC"), ("Pro", "LATAM")], 1)],
        orders=[order(1, 1, "2024-01-15 09:00", 10.5), order(2, 2, "2024-02-15 09:00", 20.25), order(3, 3, "2024-02-16 09:00", 5.0, "refunded")],
        subscriptions=[subscription(i, i, "2024-01-10", churn=c) for i, c in ((1, ""), (2, "2024-02-20"), (3, ""))],
        sessions=[session(1, "2024-01-05 10:00", 1, "1"), session(2, "2024-02-05 10:00")],
        spends=[spend("2024-01-01", "Email", 12.0)],
    )
    src = tmp_path / "src"
    for name, df in tables.items():
        if name != "events":
            df.coalesce(1).write.option("header", True).csv(str(src / f"{name}.csv"))
    rows = [event(1, 1, "2024-02-05T10:15:42"), event(2, 2, "2024-02-06T10:00:00", "api_call")]
    src.joinpath("events.json").write_text(
        json.dumps(
            [
                {
                    "event_id": i,
                    "customer_id": c,
                    "event_type": t,
                    "event_ts": str(w),
                    "properties": {"platform": p, "app_version": v, "session_len_sec": n, "feature": f},
                }
                for i, c, t, w, p, v, n, f in rows
            ],
            default=str,
        )
    )
    return str(src)


def test_land_counts_and_flattens(spark, rows, extracts, tmp_path):
    landed = str(tmp_path / "landed")
    counts = land(spark, extracts, landed)
    assert counts == {"customers": 3, "orders": 3, "subscriptions": 3, "web_sessions": 2, "marketing_spend": 1, "events": 2}
    events = spark.read.parquet(f"{landed}/events")
    assert rows(events, "event_id", "platform", "session_len_sec") == [(1, "web", 60), (2, "web", 60)]
    assert events.select(F.countDistinct("_ingested_at")).first()[0] == 1
    assert land(spark, extracts, landed) == counts  # loading again replaces


def test_json_array_and_text_flatten_alike(spark, rows, extracts):
    nested = read_json_array(spark, f"{extracts}/events.json", EVENTS_NESTED)
    as_text = nested.withColumn("properties", F.to_json("properties"))
    assert rows(flatten(nested, "properties")) == rows(flatten(as_text, "properties"))


def test_inferred_types(spark, extracts):
    kinds = dict(read_csv(spark, f"{extracts}/customers.csv").dtypes)
    assert kinds["customer_id"] == "int" and kinds["signup_date"] == "date" and kinds["plan"] == "string"


def test_daily_run_exports_after_passing_tests(spark, rows, extracts, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    manifest = run_daily(spark, extracts, landed, out)
    counts = dict(rows(manifest, "table_name", "rows"))
    assert counts["dim_customers"] == 3 and counts["fct_orders"] == 3 and counts["kpi_monthly"] == 2 and len(counts) == 8
    read = spark.read.parquet(f"{out}/parquet/fct_orders")
    assert read.agg(F.sum("recognized_revenue")).first()[0] == 30.75
    assert read_csv(spark, f"{out}/csv/fct_orders", read.schema).count() == 3
    assert spark.read.json(f"{out}/_manifest").count() == 8
    again = run_daily(spark, None, landed, str(tmp_path / "again"), fmt="parquet")
    assert dict(rows(again, "table_name", "rows")) == counts


def test_daily_run_withholds_exports(spark, extracts, tmp_path):
    landed, out = str(tmp_path / "landed"), tmp_path / "out"
    land(spark, extracts, landed)
    orders = spark.read.parquet(f"{landed}/orders")
    bad = settle_counted(orders.withColumn("customer_id", F.lit(404).cast("bigint")))[0]
    replace_table(bad, f"{landed}/orders")
    with pytest.raises(ChecksFailed, match="relationships"):
        run_daily(spark, None, landed, str(out))
    assert not out.exists()
    with pytest.raises(ChecksFailed, match="freshness"):
        run_daily(spark, extracts, str(tmp_path / "landed2"), str(out), as_of="2999-01-01 00:00:00")


def test_unknown_export_format(spark, tmp_path):
    with pytest.raises(ValueError):
        export({}, str(tmp_path), "xlsx")


def test_row_floor():
    assert row_floor(49_999) == "warn" and row_floor(50_000) == "pass"


def test_settle_counts_while_writing(spark):
    df, n = settle_counted(spark.range(37))
    assert n == 37 == df.count()
    assert scratch_root(spark).removeprefix("file:") in df.inputFiles()[0]


def test_slice_prunes_partitions_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame(
        [(1, "EMEA", d("2024-01-05"), d("2024-01-01")), (2, "APAC", d("2024-02-05"), d("2024-02-01")), (3, "EMEA", d("2024-02-07"), d("2024-02-01"))],
        "order_id int, region string, order_date date, order_month date",
    ).write.partitionBy("order_month").parquet(path)
    df = slice_orders(spark.read.parquet(path), regions=["EMEA"], first_day="2024-02-07", last_day="2024-02-07")
    assert [r.order_id for r in df.collect()] == [3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "EqualTo(region,EMEA)" in plan


def test_pivot_explore(spark, rows):
    df = spark.createDataFrame([("a", 1, 1.5), ("a", 2, 2.5), ("b", 5, 1.0), (None, 9, 9.0)], "g string, i int, x double")
    assert column_kinds(df) == {"numeric": ["i", "x"], "categorical": ["g"]}
    assert [tuple(r) for r in pivot_explore(df, "g", "i", "sum").collect()] == [("b", 5), ("a", 3)]
    assert rows(pivot_explore(df, "g", "x", "mean")) == [("a", 2.0), ("b", 1.0)]
    assert rows(pivot_explore(df, "g", "x", "count")) == [("a", 2), ("b", 1)]
    for bad in (("i", "x", "sum"), ("g", "g", "sum"), ("g", "x", "median")):
        with pytest.raises(ValueError):
            pivot_explore(df, *bad)


def test_two_arrays_in_a_file_fail(spark, tmp_path):
    """The second array must not be lost without a word."""
    (tmp_path / "one.json").write_text('[{"a": 1}, {"a": 2}]\n')
    assert sorted(r["a"] for r in read_json_array(spark, str(tmp_path), "a bigint").collect()) == [1, 2]
    assert sorted(r["a"] for r in read_json_array(spark, str(tmp_path)).collect()) == [1, 2]
    (tmp_path / "two.json").write_text('[{"a": 3}] [{"a": 4}]')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, str(tmp_path), "a bigint").collect()


def test_json_arrays_keep_every_event(spark):
    """At a size where many arrays are written."""
    from tidebook.catalog import QUERIES

    sf = "/root/testdata/sf0.1"
    assert QUERIES["s02_json_array_source"](spark, sf).count() == spark.read.parquet(f"{sf}/events.parquet").count()
