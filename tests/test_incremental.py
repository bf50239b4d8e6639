from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import customer, order, raw, staged
from tidebook.operators.incremental import HIGH_WATER, KEY_DIFF, full_refresh, merge_new, publish
from tidebook.operators.staging import stg_orders
from tidebook.plans.marts import fct_orders
from tidebook.sources.schemas import ORDERS
from tidebook.streaming import order_stream, run_incremental

PEOPLE = [customer(1, "2024-01-01"), customer(2, "2024-01-01")]
LOADED = [
    order(1, 1, "2024-01-05 10:00", 10.0),
    order(2, 1, "2024-02-10 10:00", 20.0),
    order(3, 2, "2024-02-20 10:00", 30.0),
]
BATCH = [
    order(2, 1, "2024-02-10 10:00", 20.0, "refunded"),  # status changed, time kept
    order(1, 1, "2024-03-02 10:00", 11.0),  # same id, later
    order(4, 2, "2024-02-20 10:00", 40.0),  # same time as the newest
    order(5, 2, "2024-01-20 10:00", 50.0),  # late arrival
    order(6, 2, "2024-03-01 00:00", 60.0),  # new
]


def fact(spark, orders):
    s = staged(spark, customers=PEOPLE, orders=orders)
    return fct_orders(s.orders, s.customers)


def state(df, rows):
    return rows(df, "order_id", "net_amount", "status")


HIGH = [(1, 11.0, "completed"), (2, 20.0, "completed"), (3, 30.0, "completed"), (6, 60.0, "completed")]
DIFF = [
    (1, 11.0, "completed"),
    (2, 20.0, "refunded"),
    (3, 30.0, "completed"),
    (4, 40.0, "completed"),
    (5, 50.0, "completed"),
    (6, 60.0, "completed"),
]


@pytest.mark.parametrize("mode, want", [(HIGH_WATER, HIGH), (KEY_DIFF, DIFF)])
def test_merge(spark, rows, mode, want):
    assert state(merge_new(fact(spark, LOADED), fact(spark, BATCH), mode=mode), rows) == want


@pytest.mark.parametrize("mode, want", [(HIGH_WATER, HIGH), (KEY_DIFF, DIFF)])
def test_publish_equals_merge_and_can_be_repeated(spark, rows, tmp_path, mode, want):
    path = str(tmp_path / "fct")
    publish(fact(spark, LOADED), path, mode=mode)
    for _ in range(2):
        publish(fact(spark, BATCH), path, mode=mode)
        assert state(spark.read.parquet(path), rows) == want


def test_publish_rewrites_touched_months_only(spark, tmp_path):
    path = tmp_path / "fct"
    publish(fact(spark, LOADED), str(path))
    files = lambda month: sorted(p.name for p in (path / f"order_month={month}").glob("*.parquet"))
    before = files("2024-01-01"), files("2024-02-01")
    publish(fact(spark, [order(7, 1, "2024-02-25 10:00", 70.0)]), str(path))
    assert files("2024-01-01") == before[0] and files("2024-02-01") != before[1]


def test_an_emptied_month_disappears(spark, rows, tmp_path):
    """The only January order moves to March."""
    path = str(tmp_path / "fct")
    publish(fact(spark, LOADED), path)
    publish(fact(spark, [order(1, 1, "2024-03-02 10:00", 11.0)]), path)
    assert state(spark.read.parquet(path), rows) == [(1, 11.0, "completed"), (2, 20.0, "completed"), (3, 30.0, "completed")]


def test_append_only_loads_equal_a_full_refresh(spark, rows, tmp_path):
    lots = [[order(i, 1, f"2024-0{1 + i % 4}-{10 + lot} 10:00", float(i))] for lot, i in enumerate((4, 8, 5, 1, 2, 3))]
    lots.sort(key=lambda lot: lot[0][2])
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    for lot in lots:
        publish(fact(spark, lot), step)
    full_refresh(fact(spark, [o for lot in lots for o in lot]), whole)
    assert state(spark.read.parquet(step), rows) == state(spark.read.parquet(whole), rows)


def test_columns_follow_the_batch(spark, rows, tmp_path):
    target = fact(spark, LOADED)
    batch = fact(spark, BATCH).withColumn("currency", F.lit("EUR")).drop("discount_pct")
    merged = merge_new(target, batch)
    assert "discount_pct" not in merged.columns
    assert rows(merged, "order_id", "currency") == [(1, "EUR"), (2, None), (3, None), (6, "EUR")]
    path = str(tmp_path / "fct")
    publish(target, path)
    publish(batch, path)
    assert rows(spark.read.parquet(path), "order_id", "currency") == [(1, "EUR"), (2, None), (3, None), (6, "EUR")]


def test_load_into_an_empty_target(spark, rows):
    assert len(state(merge_new(fact(spark, []), fact(spark, LOADED)), rows)) == 3


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        merge_new(fact(spark, LOADED), fact(spark, BATCH), mode="guess")


def test_stream_picks_up_new_files_once(spark, rows, tmp_path):
    inbox, target, log = (str(tmp_path / n) for n in ("inbox", "fct", "log"))
    customers = staged(spark, customers=PEOPLE).customers
    for lot in (LOADED, BATCH, []):
        if lot:
            spark.createDataFrame(lot, ORDERS).coalesce(1).write.mode("append").option("header", True).csv(inbox)
        stream = order_stream(spark, inbox, files_per_batch=1)
        run_incremental(stream, customers, target, log, HIGH_WATER).awaitTermination()
    assert state(spark.read.parquet(target), rows) == HIGH


def test_staged_batch_matches_schema(spark):
    assert stg_orders(raw(spark, orders=LOADED)["orders"]).schema["order_ts"].dataType.simpleString() == "timestamp_ntz"


def test_files_in_any_order_and_batches_lose_nothing(spark, tmp_path):
    """Later files hold the same moment and earlier ones; every file is a batch of its own."""
    customers = staged(spark, customers=PEOPLE).customers
    inbox, target, log = (str(tmp_path / n) for n in ("inbox", "fact", "log"))
    lots = [[order(5, 1, "2024-03-02 10:00", 1.0)], [order(6, 1, "2024-03-02 10:00", 2.0), order(7, 1, "2024-03-02 09:00", 4.0)], [order(8, 1, "2024-01-05 09:00", 8.0)]]
    for lot in lots:
        raw(spark, orders=lot)["orders"].coalesce(1).write.mode("append").parquet(inbox)
    schema = spark.read.parquet(inbox).schema
    for _ in range(2):  # the second run finds nothing new
        run_incremental(order_stream(spark, inbox, schema, "parquet", files_per_batch=1), customers, target, log).awaitTermination()
    got = spark.read.parquet(target)
    assert sorted((r["order_id"], r["net_amount"]) for r in got.collect()) == [(5, 1.0), (6, 2.0), (7, 4.0), (8, 8.0)]


def test_an_emptied_month_costs_its_folder(spark, tmp_path):
    path = str(tmp_path / "fact")
    publish(fact(spark, [order(1, 1, "2024-01-05 09:00", 1.0), order(2, 1, "2024-02-05 09:00", 2.0), order(3, 1, "2024-03-05 09:00", 3.0)]), path)
    untouched = sorted((tmp_path / "fact" / "order_month=2024-03-01").iterdir())
    publish(fact(spark, [order(1, 1, "2024-02-07 09:00", 1.0)]), path, mode=KEY_DIFF)
    got = sorted((r["order_id"], str(r["order_month"])) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2024-02-01"), (2, "2024-02-01"), (3, "2024-03-01")]
    assert sorted((tmp_path / "fact" / "order_month=2024-03-01").iterdir()) == untouched
