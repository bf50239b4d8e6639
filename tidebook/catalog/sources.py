"""S1-S15: every source and sink, exercised on a whole table and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.catalog.base import Bound, add
from tidebook.operators.calendar import date_bounds, day_spine
from tidebook.operators.slicing import filter_domain
from tidebook.plans.warehouse import MART_NAMES
from tidebook.session import scratch_path
from tidebook.sources import (
    bindings,
    export,
    flatten,
    manifest_rows,
    read_csv,
    read_json_array,
    read_json_lines,
    replace_table,
    row_floor,
    stamp,
    write_csv,
    write_parquet,
)
from tidebook.sources.schemas import EVENTS_NESTED, ORDERS

RAW_ORDER_COLUMNS = "order_id, customer_id, order_ts, gross_amount, discount_pct, net_amount, num_items, channel, status"
RAW_EVENTS = """SELECT event_id, customer_id, event_type, event_ts, platform, app_version, session_len_sec, feature
FROM stg_events"""

# JSON text keeps milliseconds unless told otherwise.
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def csv_source(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "orders-csv")
    write_csv(b.raw["orders"], path)
    return read_csv(b.spark, path, ORDERS)


def csv_inferred(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "subscriptions-csv")
    write_csv(b.raw["subscriptions"], path)
    return read_csv(b.spark, path)


def json_array_source(b: Bound) -> DataFrame:
    """One JSON array per file, an array for each month's events."""
    path = scratch_path(b.spark, "events-array")
    rows = bindings.raw_events_nested(b.spark, b.sf_dir)
    text = rows.select(F.to_json(F.struct(*rows.columns), MICROS).alias("j"), F.trunc("event_ts", "month").alias("month"), "event_id")
    # Row by row into the month's file: the first opens the array, others follow a comma, the last closes it.
    in_month = Window.partitionBy("month").orderBy("event_id")
    mark = F.when(F.row_number().over(in_month) == 1, "[").otherwise(",")
    last = F.lead("event_id").over(in_month).isNull()
    lines = text.select("month", "event_id", F.concat(mark, "j").alias("line"), last.alias("last"))
    lines = lines.select("month", "event_id", F.posexplode(F.when(F.col("last"), F.array("line", F.lit("]"))).otherwise(F.array("line"))))
    in_order = lines.sortWithinPartitions("month", "event_id", "pos")
    in_order.select("month", F.col("col").alias("value")).write.partitionBy("month").text(path)
    return flatten(read_json_array(b.spark, path, EVENTS_NESTED), "properties")


def json_lines_source(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "events-lines")
    bindings.raw_events_nested(b.spark, b.sf_dir).write.options(**MICROS).json(path)
    return flatten(read_json_lines(b.spark, path, EVENTS_NESTED), "properties")


def json_text_flatten(b: Bound) -> DataFrame:
    """The base table keeps its properties as JSON text."""
    return flatten(b.table("events").select("event_id", "props"), "props", {"k": "bigint"})


def audit_stamp(b: Bound) -> DataFrame:
    stamped = stamp(b.raw["orders"])
    return stamped.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("_ingested_at").alias("load_times"),
        F.count_if(F.col("_ingested_at").isNull()).alias("unstamped"),
    )


def replace_load(b: Bound) -> DataFrame:
    """Loading twice leaves one copy."""
    path = scratch_path(b.spark, "replace")
    for _ in range(2):
        replace_table(b.raw["customers"], path)
    return b.spark.read.parquet(path)


def load_counts(b: Bound) -> DataFrame:
    root = scratch_path(b.spark, "landed")
    counts = [(name, replace_table(df, f"{root}/{name}")) for name, df in b.raw_all().items()]
    counts.append(("total", sum(n for _, n in counts)))
    return b.spark.createDataFrame(counts, "table_name string, row_count bigint")


def row_floor_check(b: Bound) -> DataFrame:
    rows = replace_table(b.raw["orders"], scratch_path(b.spark, "orders"))
    return b.spark.createDataFrame([("orders", rows, row_floor(rows))], "table_name string, row_count bigint, status string")


def csv_sink(b: Bound) -> DataFrame:
    mart = b.wh.fct_subscriptions
    path = scratch_path(b.spark, "fct-subscriptions-csv")
    write_csv(mart, path)
    return read_csv(b.spark, path, mart.schema)


def parquet_sink(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "fct-orders")
    write_parquet(b.wh.fct_orders, path, partition_by="order_month")
    return b.spark.read.parquet(path).select(*b.wh.fct_orders.columns)


def export_formats(b: Bound) -> DataFrame:
    """Rows found in each format's folder after each kind of export."""
    marts = b.wh.settled().marts
    out = None
    for fmt in ("csv", "parquet", "both"):
        root = scratch_path(b.spark, f"export-{fmt}")
        export(marts, root, fmt)
        for kind in ("csv", "parquet") if fmt == "both" else (fmt,):
            for name, df in marts.items():
                path = f"{root}/{kind}/{name}"
                read = read_csv(b.spark, path, df.schema) if kind == "csv" else b.spark.read.parquet(path)
                line = read.agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(fmt).alias("export_format"), F.lit(kind).alias("kind"), F.lit(name).alias("table_name"), "row_count"
                )
                out = line if out is None else out.unionByName(line)
    return out


def export_manifest(b: Bound) -> DataFrame:
    root = scratch_path(b.spark, "export")
    export(b.wh.prepared().marts, root, "parquet")
    return read_json_lines(b.spark, f"{root}/_manifest", "table_name string, rows bigint, generated_at_utc timestamp").select(
        "table_name", F.col("rows").alias("row_count"), F.col("generated_at_utc").isNotNull().alias("dated")
    )


def table_scan(b: Bound) -> DataFrame:
    return b.wh.kpi_daily.orderBy("date_key")


def adhoc_sql(b: Bound) -> DataFrame:
    b.wh.register_views(["customer_segments"])
    return b.spark.sql(
        "SELECT value_tier, count(*) AS customers, CAST(sum(CAST(lifetime_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
        "FROM customer_segments GROUP BY value_tier ORDER BY revenue DESC"
    )


add("s01_csv_source", csv_source, f"SELECT {RAW_ORDER_COLUMNS} FROM stg_orders")
add(
    "s01_csv_inferred_schema",
    csv_inferred,
    """SELECT CAST(subscription_id AS INTEGER) AS subscription_id, CAST(customer_id AS INTEGER) AS customer_id, plan, mrr,
    start_date, status, churn_date, months_active, billing_interval FROM stg_subscriptions""",
)
add("s02_json_array_source", json_array_source, RAW_EVENTS)
add("s02_json_lines_source", json_lines_source, RAW_EVENTS)
add("s03_json_flatten", json_text_flatten, "SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events")
add(
    "s04_audit_stamp",
    audit_stamp,
    "SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS load_times, CAST(0 AS BIGINT) AS unstamped FROM orders",
)
add(
    "s05_replace_load",
    replace_load,
    """SELECT customer_id, customer_name, coalesce(email, '') AS email, signup_date, region, country, acquisition_channel,
    plan, company_size, industry, is_high_value_seed FROM stg_customers""",
)
add(
    "s06_load_counts",
    load_counts,
    """WITH c AS (
    SELECT 'customers' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'subscriptions', count(*) FROM stg_subscriptions
    UNION ALL SELECT 'web_sessions', count(*) FROM events
    UNION ALL SELECT 'marketing_spend', count(*) FROM stg_marketing_spend
    UNION ALL SELECT 'events', count(*) FROM events)
SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT) FROM c""",
)
add(
    "s07_row_floor_check",
    row_floor_check,
    """SELECT 'orders' AS table_name, count(*) AS row_count, CASE WHEN count(*) >= 50000 THEN 'pass' ELSE 'warn' END AS status
FROM orders""",
)
add(
    "s08_calendar_source",
    lambda b: day_spine(date_bounds(b.staged.orders, b.staged.web_sessions)),
    "SELECT date_key FROM dim_date",
)
add("s09_table_scan", table_scan, "SELECT * FROM kpi_daily ORDER BY date_key")
add("s10_parquet_sink", parquet_sink, "SELECT * FROM fct_orders")
add("s11_csv_sink", csv_sink, "SELECT * FROM fct_subscriptions")
_MART_COUNTS = " UNION ALL ".join(f"SELECT '{m}' AS table_name, count(*) AS row_count FROM {m}" for m in MART_NAMES)
add(
    "s12_export_format_switch",
    export_formats,
    f"""WITH c AS ({_MART_COUNTS}),
f(export_format, kind) AS (VALUES ('csv','csv'), ('parquet','parquet'), ('both','csv'), ('both','parquet'))
SELECT export_format, kind, table_name, row_count FROM c, f""",
)
add("s13_export_manifest", export_manifest, f"SELECT *, true AS dated FROM ({_MART_COUNTS})")
add(
    "s13_mart_row_counts",
    lambda b: manifest_rows(b.wh.marts),
    f"SELECT table_name, row_count AS rows FROM ({_MART_COUNTS})",
)
add(
    "s14_filter_domain",
    lambda b: filter_domain(b.staged.customers, b.staged.orders),
    """SELECT DISTINCT 'region' AS facet, region AS value FROM stg_customers
UNION ALL SELECT DISTINCT 'plan', plan FROM stg_customers
UNION ALL SELECT DISTINCT 'channel', acquisition_channel FROM stg_customers
UNION ALL SELECT 'min_date', CAST(min(order_date) AS VARCHAR) FROM stg_orders
UNION ALL SELECT 'max_date', CAST(max(order_date) AS VARCHAR) FROM stg_orders""",
)
add(
    "s15_adhoc_sql",
    adhoc_sql,
    """SELECT value_tier, count(*) AS customers, CAST(sum(CAST(lifetime_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM scored GROUP BY 1""",
)
