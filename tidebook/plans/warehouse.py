"""All marts of one set of staged frames, built when first used."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame

from tidebook.operators.calendar import dim_date
from tidebook.operators.quality import Expect, require_passing, run_checks
from tidebook.operators.retention import cohort_retention
from tidebook.operators.staging import STAGING, Staged
from tidebook.plans import marts
from tidebook.session import settle
from tidebook.sources.sinks import export

MART_NAMES = (
    "dim_customers",
    "dim_date",
    "fct_orders",
    "fct_subscriptions",
    "kpi_daily",
    "kpi_monthly",
    "customer_segments",
    "cohort_retention",
)

# The accepted value lists of the data contract.
PLANS = ["Free", "Starter", "Pro", "Business", "Enterprise"]
REGIONS = ["North America", "EMEA", "APAC", "LATAM"]
BANDS = ["SMB", "Mid-Market", "Enterprise"]
ORDER_STATUSES = ["completed", "refunded", "pending"]
SUBSCRIPTION_STATUSES = ["active", "churned", "paused"]
EVENT_TYPES = [
    "page_view",
    "feature_used",
    "activation",
    "invite_sent",
    "support_ticket",
    "upgrade_clicked",
    "export_data",
    "api_call",
]
TIERS = ["High-Value", "Core", "Occasional", "Dormant"]


def source_suite() -> dict[str, Expect]:
    """Tests on the landed tables (12)."""
    return {
        "customers": Expect(unique=["customer_id"], not_null=["customer_id"]),
        "orders": Expect(
            unique=["order_id"],
            not_null=["order_id", "customer_id"],
            relationships={"customer_id": ("customers", "customer_id")},
        ),
        "subscriptions": Expect(unique=["subscription_id"], not_null=["subscription_id"]),
        "web_sessions": Expect(unique=["session_id"], not_null=["session_id"]),
        "events": Expect(unique=["event_id"], not_null=["event_id"]),
    }


def staging_suite(regions: Iterable[str] = REGIONS, event_types: Iterable[str] = EVENT_TYPES) -> dict[str, Expect]:
    """Tests on the staged frames: 19 declared on columns and 2 on value ranges."""
    return {
        "stg_customers": Expect(
            unique=["customer_id"],
            not_null=["customer_id"],
            accepted={"plan": PLANS, "region": list(regions), "segment_band": BANDS},
        ),
        "stg_orders": Expect(
            unique=["order_id"],
            not_null=["order_id", "customer_id"],
            relationships={"customer_id": ("stg_customers", "customer_id")},
            accepted={"status": ORDER_STATUSES},
            bounds={"net_amount": (0.0, None)},
        ),
        "stg_subscriptions": Expect(
            unique=["subscription_id"],
            not_null=["subscription_id"],
            accepted={"status": SUBSCRIPTION_STATUSES},
            bounds={"mrr": (0.0, None)},
        ),
        "stg_web_sessions": Expect(unique=["session_id"], not_null=["session_id"], accepted={"converted": [0, 1]}),
        "stg_events": Expect(unique=["event_id"], not_null=["event_id"], accepted={"event_type": list(event_types)}),
    }


def mart_suite() -> dict[str, Expect]:
    """Tests on the marts: 22 declared on columns and the churn range."""
    return {
        "dim_date": Expect(unique=["date_key"], not_null=["date_key"]),
        "dim_customers": Expect(unique=["customer_id"], not_null=["customer_id", "lifetime_revenue"]),
        "fct_orders": Expect(
            unique=["order_id"],
            not_null=["order_id", "customer_id"],
            relationships={"customer_id": ("dim_customers", "customer_id")},
        ),
        "fct_subscriptions": Expect(unique=["subscription_id"], not_null=["subscription_id"]),
        "kpi_daily": Expect(unique=["date_key"], not_null=["date_key", "conversion_rate"]),
        "kpi_monthly": Expect(
            unique=["month"],
            not_null=["month", "churn_rate", "retention_30d"],
            bounds={"churn_rate": (0.0, 1.0)},
        ),
        "customer_segments": Expect(
            unique=["customer_id"], not_null=["customer_id", "revenue_share"], accepted={"value_tier": TIERS}
        ),
    }


class Warehouse:
    """Lazy marts. ``settled()`` gives the same marts as written tables."""

    def __init__(self, staged: Staged):
        self.staged = staged

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.staged.orders, self.staged.web_sessions)

    @cached_property
    def dim_customers(self) -> DataFrame:
        s = self.staged
        return marts.dim_customers(s.customers, s.orders, s.subscriptions, s.events)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.staged.orders, self.staged.customers)

    @cached_property
    def fct_subscriptions(self) -> DataFrame:
        return marts.fct_subscriptions(self.staged.subscriptions, self.staged.customers)

    @cached_property
    def kpi_daily(self) -> DataFrame:
        s = self.staged
        return marts.kpi_daily(s.orders, s.customers, s.web_sessions, s.events)

    @cached_property
    def kpi_monthly(self) -> DataFrame:
        return self.kpis()

    def kpis(self, *groups: str) -> DataFrame:
        """The monthly table, or only the given metric groups of it."""
        s, wanted = self.staged, set(groups or marts.KPI_GROUPS)

        def when(needed_by: set[str], name: str) -> DataFrame | None:
            return getattr(s, name) if wanted & needed_by else None

        return marts.kpi_monthly(
            s.orders,
            when({"signups", "retention"}, "customers"),
            when({"subscriptions"}, "subscriptions"),
            when({"spend"}, "marketing_spend"),
            s.web_sessions,
            when({"retention"}, "events"),
            wanted,
        )

    @cached_property
    def customer_segments(self) -> DataFrame:
        return marts.customer_segments(self.dim_customers)

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return cohort_retention(self.staged.customers, self.staged.events)

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MART_NAMES}

    def register_views(self, names: Iterable[str] | None = None) -> None:
        """Make staging and mart frames available to SQL text."""
        for name in (*(f"stg_{n}" for n in STAGING), *MART_NAMES) if names is None else names:
            staged = name.removeprefix("stg_")
            frame = getattr(self.staged, staged) if staged in STAGING else getattr(self, name)
            frame.createOrReplaceTempView(name)

    def prepared(self) -> Warehouse:
        """The same marts, with what several marts and tests read written once: customers and
        subscriptions as staged, which may be made of orders, and the customer dimension. Of
        the large feeds staging is casts over landed tables and is not copied."""
        written = {name: settle(getattr(self.staged, name), f"stg_{name}") for name in ("customers", "subscriptions")}
        done = Warehouse(Staged(lambda name: written[name] if name in written else getattr(self.staged, name)))
        # Assigning shadows the lazy property of the same name.
        done.__dict__["dim_customers"] = settle(done.dim_customers, "dim_customers")
        return done

    def settled(self) -> Warehouse:
        """Marts written once; every later query scans the files."""
        done = self.prepared()
        for name in MART_NAMES:
            if name != "dim_customers":
                done.__dict__[name] = settle(getattr(done, name), name)
        return done

    def check(self) -> DataFrame:
        """Verdicts of the staging and mart suites."""
        tables = {**self.staged.by_name, **self.marts}
        return run_checks(tables, {**staging_suite(), **mart_suite()})

    def export(self, directory: str, fmt: str = "both", checks: DataFrame | None = None) -> DataFrame:
        """Write the marts, but only after every test has passed."""
        require_passing(self.check() if checks is None else checks)
        return export(self.marts, directory, fmt)
