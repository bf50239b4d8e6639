"""C1-C11: data tests, freshness, and the export gate."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.catalog.base import Bound, add
from tidebook.catalog.oracle import money
from tidebook.operators import quality as Q
from tidebook.plans.warehouse import BANDS, ORDER_STATUSES, PLANS, REGIONS, Warehouse, mart_suite, staging_suite
from tidebook.session import scratch_path, settle

# The bound base tables have their own regions and event types.
BOUND_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
BOUND_EVENTS = ["click", "view", "purchase", "signup", "error"]

add(
    "c01_unique",
    lambda b: Q.verdict(Q.unique(b.staged.orders, "order_id"), "unique", "stg_orders", "order_id").unionByName(
        Q.verdict(Q.unique(b.staged.orders, "customer_id"), "unique", "stg_orders", "customer_id")
    ),
    """SELECT 'unique' AS check_name, 'stg_orders' AS table_name, c AS column_name, n AS failures,
    CASE n WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM (
    SELECT 'order_id' AS c, count(*) AS n FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'customer_id', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1))""",
)
add(
    "c01_unique_failing_rows",
    lambda b: Q.unique(b.staged.orders, "customer_id"),
    "SELECT o_custkey AS customer_id, count(*) AS occurrences FROM orders GROUP BY 1 HAVING count(*) > 1",
)
add(
    "c02_not_null",
    lambda b: Q.not_null(b.staged.customers, ["customer_id", "email", "signup_date"]),
    """SELECT 'customer_id' AS column_name, count(*) - count(customer_id) AS failures FROM stg_customers
    UNION ALL SELECT 'email', count(*) - count(email) FROM stg_customers
    UNION ALL SELECT 'signup_date', count(*) - count(signup_date) FROM stg_customers""",
)
add(
    "c03_relationships",
    lambda b: Q.relationships(b.staged.orders, "customer_id", b.staged.events, "customer_id"),
    """SELECT o_custkey AS orphan_key, count(*) AS child_rows FROM orders
    WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""",
)
add(
    "c04_accepted_values",
    lambda b: Q.accepted(b.staged.customers, "region", REGIONS),
    "SELECT region AS value, count(*) AS occurrences FROM stg_customers WHERE region NOT IN ('North America', 'EMEA', 'APAC', 'LATAM') GROUP BY 1",
)


def accepted_verdicts(b: Bound) -> DataFrame:
    suite = {
        "stg_customers": Q.Expect(accepted={"plan": PLANS, "region": REGIONS, "segment_band": BANDS}),
        "stg_orders": Q.Expect(accepted={"status": ORDER_STATUSES}),
    }
    return Q.run_checks(b.staged.by_name, suite)


add(
    "c04_accepted_value_verdicts",
    accepted_verdicts,
    """SELECT 'accepted_values' AS check_name, t AS table_name, c AS column_name, n AS failures,
    CASE n WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM (
    SELECT 'stg_customers' AS t, 'region' AS c, count(DISTINCT region) AS n FROM stg_customers
    UNION ALL SELECT 'stg_customers', 'plan', count(DISTINCT plan) FILTER (WHERE plan NOT IN
        ('Free', 'Starter', 'Pro', 'Business', 'Enterprise')) FROM stg_customers
    UNION ALL SELECT 'stg_customers', 'segment_band', count(DISTINCT segment_band) FILTER (WHERE segment_band NOT IN
        ('SMB', 'Mid-Market', 'Enterprise')) FROM stg_customers
    UNION ALL SELECT 'stg_orders', 'status', count(DISTINCT status) FILTER (WHERE status NOT IN
        ('completed', 'refunded', 'pending')) FROM stg_orders)""",
)
add(
    "c05_churn_bounds",
    lambda b: Q.bounds(b.wh.kpis("subscriptions"), "churn_rate", 0.0, 1.0).select("month", "churn_rate"),
    "SELECT month, churn_rate FROM kpi_monthly WHERE NOT churn_rate BETWEEN 0 AND 1",
)
add(
    "c05_bounds_failing_rows",
    lambda b: Q.bounds(b.wh.kpis("subscriptions"), "churn_rate", 0.01, 0.05).select("month", "churn_rate"),
    "SELECT month, churn_rate FROM kpi_monthly WHERE churn_rate NOT BETWEEN 0.01::DOUBLE AND 0.05::DOUBLE",
)
add(
    "c06_net_amount_non_negative",
    lambda b: Q.bounds(b.staged.orders, "net_amount", lo=0.0).select("order_id", "net_amount"),
    "SELECT o_orderkey AS order_id, o_totalprice AS net_amount FROM orders WHERE o_totalprice < 0",
)
add(
    "c07_mrr_non_negative",
    lambda b: Q.bounds(b.staged.subscriptions, "mrr", lo=0.0).select("subscription_id", "mrr"),
    "SELECT subscription_id, mrr FROM stg_subscriptions WHERE mrr < 0",
)
add(
    "c08_revenue_reconciles",
    lambda b: Q.verdict(
        Q.reconcile(b.wh.kpi_daily, b.staged.orders, "recognized_revenue"), "reconcile", "kpi_daily", "recognized_revenue"
    ),
    f"""SELECT 'reconcile' AS check_name, 'kpi_daily' AS table_name, 'recognized_revenue' AS column_name,
    CAST(abs(a - o) > 1.0 AS BIGINT) AS failures, CASE WHEN abs(a - o) > 1.0 THEN 'fail' ELSE 'pass' END AS status
    FROM (SELECT {money("recognized_revenue")} AS a FROM kpi_daily), (SELECT {money("recognized_revenue")} AS o FROM stg_orders)""",
)
add(
    "c08_reconcile_difference",
    lambda b: Q.reconcile(b.wh.fct_orders.where("is_recognized"), b.wh.fct_orders, "net_amount"),
    f"""SELECT {money("CASE WHEN is_recognized THEN net_amount END")} AS left_total, {money("net_amount")} AS right_total
    FROM stg_orders""",
)


def freshness_lines(b: Bound) -> DataFrame:
    """The same table against three moments: in time, late, and too late."""
    out = None
    for as_of in ("2024-02-01 10:00:00", "2024-02-01 14:00:00", "2024-02-10 00:00:00"):
        line = Q.freshness(b.table("events"), as_of, "ts").select(F.lit(as_of).alias("as_of"), "age_hours", "status")
        out = line if out is None else out.unionByName(line)
    return out


add(
    "c09_freshness",
    freshness_lines,
    """SELECT strftime(moment, '%Y-%m-%d %H:%M:%S') AS as_of, age AS age_hours,
    CASE WHEN age > 72 THEN 'error' WHEN age > 36 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT moment, datesub('second', (SELECT max(ts) FROM events), moment) / 3600.0::DOUBLE AS age
    FROM (VALUES (TIMESTAMP '2024-02-01 10:00:00'), (TIMESTAMP '2024-02-01 14:00:00'), (TIMESTAMP '2024-02-10 00:00:00'))
    v(moment))""",
)
add(
    "c10_null_rate",
    lambda b: Q.null_rate(b.staged.customers, "email", 0.02),
    """SELECT CAST(count(*) FILTER (WHERE c_custkey % 67 = 0) AS DOUBLE) / count(*) AS null_rate,
    CASE WHEN CAST(count(*) FILTER (WHERE c_custkey % 67 = 0) AS DOUBLE) / count(*) > 0.02 THEN 'fail' ELSE 'pass' END AS status
    FROM customer""",
)


def built_checks(b: Bound) -> DataFrame:
    """The staging and mart suites on written tables."""
    wh: Warehouse = b.wh.settled()
    suite = {**staging_suite(BOUND_REGIONS, BOUND_EVENTS), **mart_suite()}
    return Q.run_checks({**wh.staged.by_name, **wh.marts}, suite)


def _failures(table: str, kind: str, column: str, spec: Q.Expect) -> str:
    """A count of failures over the oracle's own tables."""
    if kind == "unique":
        return f"(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"
    if kind == "not_null":
        return f"(SELECT count(*) - count({column}) FROM {table})"
    if kind == "bounds":
        low, high = spec.bounds[column]
        tests = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
        return f"(SELECT count(*) FROM {table} WHERE {' OR '.join(tests)})"
    if kind == "accepted_values":
        values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in spec.accepted[column])
        return f"(SELECT count(DISTINCT {column}) FROM {table} WHERE {column} NOT IN ({values}))"
    parent, key = spec.relationships[column]
    return f"(SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL))"


def _verdicts_sql() -> str:
    """A line for every declared test, its failures counted."""
    lines = []
    for table, spec in {**staging_suite(BOUND_REGIONS, BOUND_EVENTS), **mart_suite()}.items():
        kinds = {"unique": spec.unique, "not_null": spec.not_null, "bounds": spec.bounds, "accepted_values": spec.accepted}
        for kind, columns in (kinds | {"relationships": spec.relationships}).items():
            lines += [f"('{kind}', '{table}', '{c}', {_failures(table, kind, c, spec)})" for c in columns]
    return f"""SELECT *, CASE failures WHEN 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (VALUES {", ".join(lines)}) v(check_name, table_name, column_name, failures)"""


add("c11_all_checks", built_checks, _verdicts_sql())


def refused_export(b: Bound) -> DataFrame:
    """A failing test keeps every mart out of the export folder."""
    failing = settle(Q.run_checks(b.staged.by_name, {"stg_customers": Q.Expect(accepted={"region": REGIONS})}))
    folder, refused = scratch_path(b.spark, "refused"), False
    try:
        b.wh.export(folder, "parquet", failing)
    except Q.ChecksFailed:
        refused = True
    written = 0
    for name in b.wh.marts:
        try:
            written += b.spark.read.parquet(f"{folder}/parquet/{name}").count() >= 0
        except AnalysisException:
            continue
    return failing.groupBy().agg(F.sum("failures").alias("failures")).select(
        "failures", F.lit(refused).alias("refused"), F.lit(written).cast("bigint").alias("marts_written")
    )


add(
    "c11_refused_export",
    refused_export,
    """SELECT CAST(count(DISTINCT region) AS BIGINT) AS failures, count(*) > 0 AS refused, CAST(0 AS BIGINT) AS marts_written
    FROM stg_customers WHERE region NOT IN ('North America', 'EMEA', 'APAC', 'LATAM')""",
)


def export_gate(b: Bound) -> DataFrame:
    """With the published region list the bound regions fail, so exports are withheld."""
    suite = {
        "stg_customers": Q.Expect(unique=["customer_id"], not_null=["customer_id"], accepted={"region": REGIONS, "plan": PLANS}),
        "stg_subscriptions": Q.Expect(unique=["subscription_id"], bounds={"mrr": (0.0, None)}),
    }
    return Q.gate(settle(Q.run_checks(b.staged.by_name, suite)))


add(
    "c11_export_gate",
    export_gate,
    """SELECT CAST(6 AS BIGINT) AS checks, count(*) AS failed, count(*) = 0 AS export_allowed FROM (
    SELECT 1 FROM stg_customers GROUP BY customer_id HAVING count(*) > 1
    UNION ALL SELECT 1 FROM (SELECT count(DISTINCT region) AS n FROM stg_customers
        WHERE region NOT IN ('North America', 'EMEA', 'APAC', 'LATAM')) WHERE n > 0)""",
)
