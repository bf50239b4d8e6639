from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import customer, d, order, raw, session, staged, subscription
from tidebook.operators.calendar import date_bounds, day_spine, dim_date, month_spine


def test_names_are_trimmed_and_blank_emails_become_null(spark, rows):
    s = staged(spark, customers=[customer(1, "2024-01-01", name="  Acme ", email=" "), customer(2, "2024-01-01")])
    assert rows(s.customers, "customer_id", "customer_name", "email") == [(1, "Acme", None), (2, "c2", "a@b.c")]


def test_segment_band_borders(spark, rows):
    sizes = [99, 100, 499, 500, None]
    s = staged(spark, customers=[customer(i, "2024-01-01", size=n) for i, n in enumerate(sizes)])
    assert [b for _, b in rows(s.customers, "customer_id", "segment_band")] == [
        "SMB",
        "Mid-Market",
        "Mid-Market",
        "Enterprise",
        "SMB",
    ]


def test_unreadable_churn_dates_are_null_not_errors(spark, rows):
    subs = [subscription(i, i, "2024-01-05", churn=c) for i, c in enumerate(["", "n/a", "2024-03-01"])]
    s = staged(spark, subscriptions=subs)
    assert [r[1] for r in rows(s.subscriptions, "subscription_id", "churn_date")] == [None, None, d("2024-03-01")]


def test_only_completed_orders_are_recognized(spark, rows):
    orders = [order(i, 1, "2024-01-05 10:00", 20.0, s) for i, s in enumerate(["completed", "refunded", "pending"])]
    s = staged(spark, orders=orders)
    assert rows(s.orders, "order_id", "recognized_revenue", "is_recognized") == [
        (0, 20.0, True),
        (1, 0.0, False),
        (2, 0.0, False),
    ]


def test_blank_session_customer_is_null(spark, rows):
    s = staged(spark, sessions=[session(1, "2024-01-05 10:00"), session(2, "2024-01-05 10:00", 1, "77")])
    assert rows(s.web_sessions, "session_id", "customer_id") == [("S1", None), ("S2", 77)]


def test_a_bad_number_fails_the_cast(spark):
    bad = raw(spark)["subscriptions"].sparkSession.createDataFrame(
        [("x", "1")], "spend_date string, channel string"
    )
    with pytest.raises(Exception):
        bad.select(F.col("spend_date").cast("bigint")).collect()


def test_calendar_fields(spark, rows):
    s = staged(
        spark,
        orders=[order(1, 1, "2021-01-04 00:00", 1.0), order(2, 1, "2024-02-29 00:00", 1.0)],
        sessions=[session(1, "2021-01-03 10:00")],
    )
    dates = dim_date(s.orders, s.web_sessions)
    picked = dates.where(F.col("date_key").isin(d("2021-01-03"), d("2024-02-29")))
    assert rows(picked, "date_key", "week_num", "day_of_week", "day_name", "is_weekend", "month_start") == [
        (d("2021-01-03"), 53, 0, "Sunday", True, d("2021-01-01")),
        (d("2024-02-29"), 9, 4, "Thursday", False, d("2024-02-01")),
    ]
    assert dates.count() == (d("2024-02-29") - d("2021-01-03")).days + 1


def test_spines_without_input_are_empty(spark):
    s = staged(spark)
    bounds = date_bounds(s.orders, s.web_sessions)
    assert day_spine(bounds).count() == 0
    assert month_spine(bounds).count() == 0


def test_month_spine_stops_at_the_last_order(spark, rows):
    s = staged(spark, orders=[order(1, 1, "2024-02-10 00:00", 1.0)], sessions=[session(1, "2024-01-20 00:00"), session(2, "2024-05-01 00:00")])
    assert rows(month_spine(date_bounds(s.orders, s.web_sessions))) == [(d("2024-01-01"),), (d("2024-02-01"),)]
