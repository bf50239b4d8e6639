"""I1-I4: incremental load, full refresh, schema drift, and reuse of landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.catalog.base import Bound, add
from tidebook.catalog.oracle import money
from tidebook.functions import exact_sum
from tidebook.operators.incremental import HIGH_WATER, KEY_DIFF, full_refresh, merge_new, publish
from tidebook.operators.staging import Staged
from tidebook.operators.versions import VersionedTable, read_table, replace_version
from tidebook.plans.marts import fct_orders
from tidebook.plans.warehouse import Warehouse
from tidebook.session import scratch_path
from tidebook.sources import replace_table
from tidebook.streaming import order_stream, run_incremental


def loaded_so_far(b: Bound) -> DataFrame:
    """The fact as it stood before the month that is still open."""
    facts = b.wh.fct_orders
    latest = b.staged.orders.agg(F.trunc(F.max("order_date"), "month").cast("date").alias("open_month"))
    return facts.crossJoin(F.broadcast(latest)).where("order_month < open_month").drop("open_month")  # one row


def published(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "fct_orders")
    publish(loaded_so_far(b), path)
    publish(b.wh.fct_orders, path)
    return b.spark.read.parquet(path).select(*b.wh.fct_orders.columns)


def changed_rows(b: Bound) -> DataFrame:
    """Stored refunds carry an outdated status: only a key comparison repairs them."""
    stale = b.wh.fct_orders.withColumn(
        "status", F.when(F.col("status") == "refunded", "completed").otherwise(F.col("status"))
    )
    return merge_new(stale, b.wh.fct_orders, mode=KEY_DIFF).select("order_id", "status", "recognized_revenue")


def unseen_changes(b: Bound) -> DataFrame:
    """The same with the high-water mark: nothing is later, so nothing is repaired."""
    stale = b.wh.fct_orders.withColumn(
        "status", F.when(F.col("status") == "refunded", "completed").otherwise(F.col("status"))
    )
    return merge_new(stale, b.wh.fct_orders).select("order_id", "status", "recognized_revenue")


def refreshed(b: Bound) -> DataFrame:
    """A refresh replaces whatever an earlier load left."""
    path = scratch_path(b.spark, "fct_orders")
    full_refresh(loaded_so_far(b), path)
    full_refresh(b.wh.fct_orders, path)
    return b.spark.read.parquet(path).select(*b.wh.fct_orders.columns)


def drifted(b: Bound) -> DataFrame:
    """The batch has a new column and no longer has ``discount_pct``."""
    target = loaded_so_far(b)
    batch = b.wh.fct_orders.withColumn("currency", F.lit("USD")).drop("discount_pct")
    return merge_new(target, batch).select("order_id", "net_amount", "currency")


def reused(b: Bound) -> DataFrame:
    """Marts from tables landed earlier, without the extracts."""
    root = scratch_path(b.spark, "landed")
    for name, df in b.raw_all().items():
        replace_table(df, f"{root}/{name}")
    landed = {name: b.spark.read.parquet(f"{root}/{name}") for name in b.raw}
    return Warehouse(Staged.from_raw(landed)).kpi_monthly


def reused_versions(b: Bound) -> DataFrame:
    """The same from tables landed twice as versions, the first time without their rows."""
    root = scratch_path(b.spark, "landed")
    for name, df in b.raw_all().items():
        replace_version(df.where("false"), f"{root}/{name}")
        replace_version(df, f"{root}/{name}")
    return Warehouse(Staged.from_raw({name: read_table(b.spark, f"{root}/{name}") for name in b.raw})).kpi_monthly


def streamed(b: Bound) -> DataFrame:
    """Order files arrive in two lots; each run picks up what is new."""
    inbox, target, log = (scratch_path(b.spark, n) for n in ("inbox", "fct_orders", "stream-log"))
    raw = b.raw["orders"]
    latest = raw.agg(F.trunc(F.max("order_ts"), "month").alias("open_month"))
    split = raw.crossJoin(F.broadcast(latest))  # one row
    for lot in ("order_ts < open_month", "order_ts >= open_month"):
        split.where(lot).drop("open_month").write.mode("append").parquet(inbox)
        stream = order_stream(b.spark, inbox, raw.schema, "parquet")
        run_incremental(stream, b.staged.customers, target, log).awaitTermination()
    return b.spark.read.parquet(target).select(*fct_orders(b.staged.orders, b.staged.customers).columns)


def out_of_order(b: Bound) -> DataFrame:
    """Three loads that share every day and moment: each brings rows before the last one's newest."""
    inbox, target, log = (scratch_path(b.spark, n) for n in ("inbox", "fct_orders", "stream-log"))
    raw = b.raw["orders"]
    for lot in range(3):
        raw.where(F.pmod(F.xxhash64("order_id"), F.lit(3)) == lot).write.mode("append").parquet(inbox)
        stream = order_stream(b.spark, inbox, raw.schema, "parquet")
        run_incremental(stream, b.staged.customers, target, log).awaitTermination()
    return b.spark.read.parquet(target).select(*fct_orders(b.staged.orders, b.staged.customers).columns)


def fact_table(b: Bound) -> VersionedTable:
    return VersionedTable(b.spark, scratch_path(b.spark, "fct_orders"), "order_id", "order_month")


def streamed_versions(b: Bound) -> DataFrame:
    """Loads that share every day and moment, into a versioned fact: its keys say which months each concerns."""
    inbox, target, log = (scratch_path(b.spark, n) for n in ("inbox", "fct_orders", "stream-log"))
    raw = b.raw["orders"]
    for lot in range(2):
        raw.where(F.pmod(F.xxhash64("order_id"), F.lit(2)) == lot).write.mode("append").parquet(inbox)
        stream = order_stream(b.spark, inbox, raw.schema, "parquet")
        run_incremental(stream, b.staged.customers, target, log, versioned=True).awaitTermination()
    return VersionedTable(b.spark, target).read().select(*fct_orders(b.staged.orders, b.staged.customers).columns)


def repaired(b: Bound) -> DataFrame:
    """Stored refunds of one quarter carry an outdated status; the whole extract comes again."""
    table, facts = fact_table(b), b.wh.fct_orders
    outdated = F.expr("status = 'refunded' AND order_month BETWEEN DATE '1996-01-01' AND DATE '1996-03-01'")
    table.replace(facts.withColumn("status", F.when(outdated, "completed").otherwise(F.col("status"))))
    table.publish(facts)
    return table.read().select(*facts.columns)


def versions_of_a_refresh(b: Bound) -> DataFrame:
    """Rows and revenue by month of the version before a refresh and the one after it."""
    table = fact_table(b)
    table.replace(loaded_so_far(b))
    table.replace(b.wh.fct_orders)
    parts = [
        table.read(v).groupBy("order_month").agg(F.count(F.lit(1)).alias("orders"), exact_sum(F.col("recognized_revenue")).alias("revenue"))
        .withColumn("version", F.lit(v)) for v in table.versions()
    ]
    return parts[0].unionByName(parts[1])


def columns_by_version(b: Bound) -> DataFrame:
    """The open month brings a column and lacks another; older months keep their files."""
    table = fact_table(b)
    table.replace(loaded_so_far(b))
    table.publish(b.wh.fct_orders.withColumn("currency", F.lit("USD")).drop("discount_pct"), mode=HIGH_WATER)
    return table.read().drop("gross_amount")


add("i1_incremental_high_water", lambda b: merge_new(loaded_so_far(b), b.wh.fct_orders), "SELECT * FROM fct_orders")
add("i1_incremental_published", published, "SELECT * FROM fct_orders")
add("i1_incremental_streamed", streamed, "SELECT * FROM fct_orders")
add("i1_incremental_out_of_order", out_of_order, "SELECT * FROM fct_orders")
add("i1_incremental_key_diff", changed_rows, "SELECT order_id, status, recognized_revenue FROM stg_orders")
add(
    "i1_high_water_misses_changes",
    unseen_changes,
    """SELECT order_id, CASE status WHEN 'refunded' THEN 'completed' ELSE status END AS status, recognized_revenue
    FROM stg_orders""",
)
add("i2_full_refresh", refreshed, "SELECT * FROM fct_orders")
add(
    "i3_schema_sync",
    drifted,
    """SELECT order_id, net_amount, CASE WHEN order_month = (SELECT max(order_month) FROM stg_orders) THEN 'USD' END AS currency
    FROM stg_orders""",
)
add("i1_versioned_stream", streamed_versions, "SELECT * FROM fct_orders")
add("i1_versioned_key_diff", repaired, "SELECT * FROM fct_orders")
add(
    "i2_versions_of_a_refresh",
    versions_of_a_refresh,
    f"""SELECT order_month, count(*) AS orders, {money("recognized_revenue")} AS revenue, CAST(v AS INTEGER) AS version
    FROM stg_orders, range(1, 3) t(v)
    WHERE v = 2 OR order_month < (SELECT max(order_month) FROM stg_orders) GROUP BY order_month, v""",
)
add(
    "i3_columns_by_version",
    columns_by_version,
    """SELECT * EXCLUDE (discount_pct, gross_amount),
    CASE WHEN order_month = (SELECT max(order_month) FROM stg_orders) THEN 'USD' END AS currency FROM fct_orders""",
)
add("i4_reuse_landed", reused, "SELECT * FROM kpi_monthly")
add("i4_reuse_landed_versions", reused_versions, "SELECT * FROM kpi_monthly")
