"""M1-M8: the marts as whole tables."""

from __future__ import annotations

from tidebook.catalog.base import add

for number, name in enumerate(
    (
        "dim_date",
        "dim_customers",
        "fct_orders",
        "fct_subscriptions",
        "kpi_daily",
        "kpi_monthly",
        "customer_segments",
        "cohort_retention",
    ),
    start=1,
):
    add(f"m{number}_{name}", lambda b, n=name: getattr(b.wh, n), f"SELECT * FROM {name}")
