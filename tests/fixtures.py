"""Small hand-made inputs with the edge rows the operators have to get right."""

from __future__ import annotations

from datetime import date, datetime

from tidebook.operators.staging import Staged
from tidebook.sources.schemas import CUSTOMERS, MARKETING_SPEND, ORDERS, SUBSCRIPTIONS, WEB_SESSIONS

FLAT_EVENTS = (
    "event_id bigint, customer_id bigint, event_type string, event_ts timestamp_ntz, platform string, "
    "app_version string, session_len_sec bigint, feature string"
)


def d(text: str) -> date:
    return date.fromisoformat(text)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def customer(i, signup, size=50, plan="Pro", region="EMEA", channel="Organic", seed=0, name=None, email="a@b.c"):
    return (i, name or f"c{i}", email, signup and d(signup), region, "DE", channel, plan, size, "Tech", seed)


def order(i, who, when, net, status="completed", channel="web"):
    return (i, who, ts(when), net, 0.0, net, 1, channel, status)


def subscription(i, who, start, churn="", mrr=49.0, plan="Pro", status=None, months=3):
    status = status or ("churned" if churn else "active")
    return (i, who, plan, mrr, start and d(start), status, churn, months, "monthly")


def session(i, when, converted=0, who="", channel="Organic", pages=2):
    return (f"S{i}", ts(when), channel, "mobile", "/", pages, 30, converted, who)


def spend(day, channel, amount, region="EMEA"):
    return (d(day), channel, region, amount, 10, 1)


def event(i, who, when, kind="page_view"):
    return (i, who, kind, ts(when), "web", "3.1", 60, "reports")


def raw(spark, customers=(), orders=(), subscriptions=(), sessions=(), spends=(), events=()):
    make = spark.createDataFrame
    return {
        "customers": make(list(customers), CUSTOMERS),
        "orders": make(list(orders), ORDERS),
        "subscriptions": make(list(subscriptions), SUBSCRIPTIONS),
        "web_sessions": make(list(sessions), WEB_SESSIONS),
        "marketing_spend": make(list(spends), MARKETING_SPEND),
        "events": make(list(events), FLAT_EVENTS),
    }


def staged(spark, **tables) -> Staged:
    return Staged.from_raw(raw(spark, **tables))
