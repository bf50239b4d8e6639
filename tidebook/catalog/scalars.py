"""The scalar functions of the inventory, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebook.catalog.base import add
from tidebook.functions import (
    add_month,
    day_gap,
    month_gap,
    month_label,
    month_start,
    ratio_or_null,
    round_half_away,
    share_label,
)
from tidebook.functions.dates import day_of_week
from tidebook.operators.staging import blank_to_null

def _day():
    return F.to_date("o_orderdate")


def over(table: str, key: str, columns):
    """A query with the key and the columns; they are built once a session exists."""
    return lambda b: b.table(table).select(key, *[c.alias(n) for n, c in columns().items()])


def orders(columns):
    return over("orders", "o_orderkey", columns)


def text(column: str):
    return F.col(column).cast("string")


add(
    "fn01_cast_types",
    orders(lambda: dict(
        as_bigint=text("o_orderkey").cast("bigint"),
        as_int=text("o_custkey").cast("int"),
        as_double=text("o_totalprice").cast("double"),
        as_date=_day().cast("string").cast("date"),
        as_timestamp=_day().cast("string").cast("timestamp_ntz"),
    )),
    """SELECT o_orderkey, CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS as_bigint, CAST(CAST(o_custkey AS VARCHAR) AS INTEGER)
    AS as_int, CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS as_double,
    CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS as_date,
    CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS as_timestamp FROM orders""",
)
def _text_date():
    return F.when(F.col("o_orderstatus") == "F", "n/a").when(F.col("o_orderstatus") == "P", "").otherwise(_day().cast("string"))
add(
    "fn02_try_cast_date",
    orders(lambda: dict(day=_text_date().try_cast("date"))),
    "SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
)
add(
    "fn03_to_double",
    orders(lambda: dict(ratio=F.col("o_custkey").cast("double") / F.col("o_totalprice"))),
    "SELECT o_orderkey, o_custkey::DOUBLE / o_totalprice AS ratio FROM orders",
)
add(
    "fn04_trim",
    over("customer", "c_custkey", lambda: dict(name=F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))))),
    "SELECT c_custkey, c_name AS name FROM customer",
)
add(
    "fn05_nullif",
    orders(lambda: dict(status=F.nullif("o_orderstatus", F.lit("F")), blank=blank_to_null(F.lit("  ")))),
    "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status, CAST(NULL AS VARCHAR) AS blank FROM orders",
)
add(
    "fn06_coalesce",
    orders(lambda: dict(status=F.coalesce(F.nullif("o_orderstatus", F.lit("F")), "o_orderpriority", F.lit("none")))),
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority ELSE o_orderstatus END AS status FROM orders",
)
add(
    "fn07_case_when",
    orders(lambda: dict(size=F.when(F.col("o_totalprice") >= 300000, "large").when(F.col("o_totalprice") >= 100000, "mid").otherwise("small"))),
    """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'large' END
    AS size FROM orders""",
)
add(
    "fn08_date_trunc_month",
    orders(lambda: dict(month=month_start(_day()))),
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
)
add(
    "fn09_extract_parts",
    orders(lambda: dict(y=F.year(_day()), q=F.quarter(_day()), m=F.month(_day()), w=F.weekofyear(_day()))),
    """SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS y, CAST(extract(quarter FROM o_orderdate) AS INTEGER)
    AS q, CAST(extract(month FROM o_orderdate) AS INTEGER) AS m, CAST(extract(week FROM o_orderdate) AS INTEGER) AS w FROM orders""",
)
add(
    "fn10_day_of_week",
    orders(lambda: dict(dow=day_of_week(_day()))),
    "SELECT o_orderkey, CAST(extract(dow FROM o_orderdate) AS INTEGER) AS dow FROM orders",
)
add(
    "fn11_date_labels",
    orders(lambda: dict(label=month_label(_day()), month_name=F.date_format(_day(), "MMMM"), day_name=F.date_format(_day(), "EEEE"))),
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS label, strftime(o_orderdate, '%B') AS month_name,
    strftime(o_orderdate, '%A') AS day_name FROM orders""",
)
add(
    "fn12_date_diff_days",
    orders(lambda: dict(days=day_gap(_day(), F.lit("2002-01-01").cast("date")))),
    "SELECT o_orderkey, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS days FROM orders",
)
add(
    "fn13_date_diff_months",
    orders(lambda: dict(months=month_gap(_day(), F.lit("2002-01-15").cast("date")))),
    "SELECT o_orderkey, CAST(datediff('month', o_orderdate, DATE '2002-01-15') AS INTEGER) AS months FROM orders",
)
add(
    "fn14_date_plus_days",
    orders(lambda: dict(later=F.date_add(_day(), 30))),
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS later FROM orders",
)
add(
    "fn15_date_plus_interval",
    orders(lambda: dict(next_day=(_day() + F.expr("interval 1 day")).cast("date"), next_month=add_month(month_start(_day())))),
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS next_day,
    CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS next_month FROM orders""",
)
def _sometimes():
    """Present on completed orders only."""
    return F.when(F.col("o_orderstatus") == "F", F.lit(200000.0))
add(
    "fn16_least_greatest",
    orders(lambda: dict(low=F.least("o_totalprice", _sometimes()), high=F.greatest("o_totalprice", _sometimes()))),
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 200000.0 ELSE o_totalprice END AS low,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice < 200000 THEN 200000.0 ELSE o_totalprice END AS high FROM orders""",
)
add(
    "fn17_date_range",
    lambda b: b.table("orders").select(
        "o_orderkey", F.explode(F.sequence(month_start(_day()), _day(), F.expr("interval 7 day"))).alias("day")
    ),
    """SELECT o_orderkey, CAST(unnest(generate_series(date_trunc('month', o_orderdate), o_orderdate, INTERVAL 7 DAY)) AS DATE)
    AS day FROM orders""",
)
add(
    "fn18_timestamp_to_date",
    over("events", "event_id", lambda: dict(day=F.to_date("ts"))),
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
)
add(
    "fn19_round",
    orders(lambda: dict(whole=round_half_away(F.col("o_totalprice")), tenth=round_half_away(F.col("o_totalprice") / 7, 1))),
    "SELECT o_orderkey, round(o_totalprice) AS whole, round(o_totalprice / 7, 1) AS tenth FROM orders",
)
add(
    "fn20_ceil_abs",
    orders(lambda: dict(up=F.ceil(F.col("o_totalprice") / 1000), size=F.abs(F.lit(250000.0) - F.col("o_totalprice")))),
    "SELECT o_orderkey, CAST(ceil(o_totalprice / 1000) AS BIGINT) AS up, abs(250000.0::DOUBLE - o_totalprice) AS size FROM orders",
)
add(
    "fn21_concat",
    orders(lambda: dict(tag=F.concat(text("o_custkey"), F.lit("%"), F.col("o_orderstatus")))),
    "SELECT o_orderkey, o_custkey || '%' || o_orderstatus AS tag FROM orders",
)
add(
    "fn22_json_extract",
    over("events", "event_id", lambda: dict(k=F.get_json_object("props", "$.k"), k2=F.get_json_object("props", "$.k").cast("bigint") * 2)),
    "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS k2 FROM events",
)
add(
    "fn23_now_constant",
    lambda b: b.table("orders").select(F.current_timestamp().alias("t")).agg(
        F.count("t").alias("stamped"), F.countDistinct("t").alias("moments")
    ),
    "SELECT count(now()) AS stamped, count(DISTINCT now()) AS moments FROM orders",
)
add(
    "fn24_boolean_in",
    orders(lambda: dict(is_weekend=day_of_week(_day()).isin(0, 6))),
    "SELECT o_orderkey, extract(isodow FROM o_orderdate) > 5 AS is_weekend FROM orders",
)
add(
    "fn25_divide_blank",
    orders(lambda: dict(share=ratio_or_null(F.col("o_totalprice"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(2)))),
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice / 2 END AS share FROM orders",
)
add(
    "fn26_switch_true",
    orders(lambda: dict(band=F.when(F.col("o_totalprice") >= 300000, 3).when(F.col("o_totalprice") >= 200000, 2).otherwise(1))),
    "SELECT o_orderkey, 1 + (o_totalprice >= 200000)::INTEGER + (o_totalprice >= 300000)::INTEGER AS band FROM orders",
)
add(
    "fn27_format_percent",
    over("customer", "c_custkey", lambda: dict(label=share_label((F.col("c_custkey") % 101) / 200 + 0.001))),
    """SELECT c_custkey, CAST(round(((c_custkey % 101) / 200 + 0.001) * 100.0) AS INTEGER) || '%' AS label FROM customer""",
)
add(
    "fn28_fill_and_period",
    orders(lambda: dict(filled=F.coalesce(_sometimes(), F.lit(0.0)), period=month_start(_day()), inside=_day().between("1996-01-01", "1997-12-31"))),
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 200000.0::DOUBLE ELSE 0 END AS filled,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS period, year(o_orderdate) IN (1996, 1997) AS inside FROM orders""",
)
