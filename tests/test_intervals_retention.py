from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import customer, d, event, staged, subscription
from tidebook.operators.intervals import CLOSED_OPEN, OPEN_CLOSED, active_on_spine
from tidebook.operators.retention import cohort_retention, window_retention


@pytest.fixture(scope="module")
def spine(spark):
    return spark.createDataFrame([(d(f"2024-{m:02d}-01"),) for m in range(1, 7)], "month date")


BORDERS = [
    ("2024-02-01", "2024-04-01"),  # both on a month start
    ("2024-02-10", "2024-02-20"),  # never covers a month start
    ("2024-02-10", None),
    ("2024-03-05", "2024-03-01"),  # ends before it starts: covers nothing
    (None, "2024-03-01"),
    ("2023-06-15", "2024-03-31"),  # opens before the spine
    ("2024-05-01", "2024-05-01"),
]


@pytest.mark.parametrize("bounds", [OPEN_CLOSED, CLOSED_OPEN])
def test_counts_equal_the_comparison_of_every_pair(spark, rows, spine, bounds):
    iv = spark.createDataFrame([(a and d(a), b and d(b), 1.5) for a, b in BORDERS], "s date, e date, w double")
    got = rows(active_on_spine(spine, iv, "s", "e", bounds=bounds))
    weighted = rows(active_on_spine(spine, iv, "s", "e", weight="w", bounds=bounds))
    want = []
    for m in (d(f"2024-{m:02d}-01") for m in range(1, 7)):
        n = 0
        for a, b in BORDERS:
            s, e = a and d(a), b and d(b)
            if s is None:
                continue
            n += (s < m and (e is None or e >= m)) if bounds == OPEN_CLOSED else (s <= m and (e is None or e > m))
        want.append((m, n))
    assert got == want
    assert weighted == [(m, n * 1.5) for m, n in want]


def test_unknown_bounds_are_refused(spark, spine):
    with pytest.raises(ValueError):
        active_on_spine(spine, spine, "month", "month", bounds="[]")


def test_interval_plan_compares_no_pairs(spark, spine):
    iv = spark.createDataFrame([(d("2024-01-05"), None)], "s date, e date")
    plan = active_on_spine(spine, iv, "s", "e")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_retention_window_borders(spark, rows):
    """Signup on 1 January; events on day 29, 30, 59 and 60."""
    people = [customer(i, "2024-01-01") for i in range(1, 6)]
    events = [
        event(1, 1, "2024-01-30 08:00"),
        event(2, 2, "2024-01-31 08:00"),
        event(3, 2, "2024-01-31 09:00"),
        event(4, 3, "2024-02-29 23:59"),
        event(5, 4, "2024-03-01 00:00"),
    ]
    s = staged(spark, customers=people, events=events)
    got = rows(window_retention(s.customers, s.events), "month", "cohort_size", "retained_30d", "cohort_is_mature")
    assert got == [(d("2024-01-01"), 5, 2, True)]


def test_one_late_member_keeps_a_cohort_immature(spark, rows):
    s = staged(
        spark,
        customers=[customer(1, "2024-01-01"), customer(2, "2024-01-31"), customer(3, None)],
        events=[event(1, 1, "2024-03-05 00:00")],
    )
    got = rows(window_retention(s.customers, s.events), "cohort_size", "retained_30d", "cohort_is_mature", "retention_30d")
    assert got == [(2, 0, False, 0.0)]


def test_without_activity_no_cohort_is_mature(spark, rows):
    s = staged(spark, customers=[customer(1, "2024-01-01")])
    assert rows(window_retention(s.customers, s.events), "cohort_is_mature") == [(False,)]


def test_cohort_range(spark, rows):
    """Before signup and month 13 are dropped; month 0 and 12 stay; pairs count once."""
    s = staged(
        spark,
        customers=[customer(1, "2023-03-20"), customer(2, "2023-03-01"), customer(3, "2023-04-01"), customer(4, None)],
        events=[
            event(1, 1, "2023-02-28 00:00"),
            event(2, 1, "2023-03-02 00:00"),
            event(3, 2, "2023-03-30 00:00"),
            event(4, 1, "2024-03-01 00:00"),
            event(5, 1, "2024-03-09 00:00"),
            event(6, 1, "2024-04-01 00:00"),
            event(7, 4, "2024-04-01 00:00"),
        ],
    )
    got = rows(cohort_retention(s.customers, s.events), "cohort_label", "months_since_signup", "cohort_size", "active_customers", "retention_rate")
    assert got == [("2023-03", 0, 2, 2, 1.0), ("2023-03", 12, 2, 1, 0.5)]


def test_subscription_dates_only(spark, rows):
    s = staged(spark, subscriptions=[subscription(1, 1, "2024-01-05", status="paused")])
    spine = s.subscriptions.select(F.lit(d("2024-02-01")).alias("month"))
    assert rows(active_on_spine(spine, s.subscriptions, "start_date", "churn_date")) == [(d("2024-02-01"), 1)]
