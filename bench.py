"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose the run. Each
query is built and run in full from the base tables, nothing is shared between
queries, and every result column is computed (the ``noop`` sink takes all rows).
``BENCH_NAIVE=1`` also times the plain formulations the operators replace.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidebook.catalog import QUERIES  # noqa: E402
from tidebook.catalog.base import Bound  # noqa: E402
from tidebook.session import build_session  # noqa: E402

HEADLINE = (
    "m2_dim_customers",
    "m3_fct_orders",
    "m5_kpi_daily",
    "m6_kpi_monthly",
    "m7_customer_segments",
    "m8_cohort_retention",
    "k01_recognized_revenue",
    "k07_churn_rate",
    "k13_retention_30d",
    "j06_interval_overlap_join",
    "q1_revenue_concentration",
    "q2_pareto",
    "q5_channel_efficiency",
    "q8_regional_scorecard",
    "d01_revenue_summary",
    "d07_pareto_curve",
    "i1_incremental_high_water",
    "i1_incremental_published",
)


def naive_intervals(spark, sf_dir):
    b = Bound(spark, sf_dir)
    month, start, end = F.col("month"), F.col("start_date"), F.col("churn_date")
    live = (start <= month) & (end.isNull() | (end > month))
    base = (start < month) & (end.isNull() | (end >= month))
    pairs = b.wh.kpis("sessions").select("month").join(b.staged.subscriptions, live | base)
    return pairs.groupBy("month").agg(F.count_if(base).alias("at_start"), F.count_if(live).alias("active"))


def naive_ntile(spark, sf_dir):
    df = Bound(spark, sf_dir).wh.dim_customers
    by = lambda c: Window.orderBy(c, "customer_id")
    return df.select(
        "*",
        F.ntile(10).over(by("lifetime_revenue")).alias("revenue_decile"),
        F.ntile(5).over(by(F.col("recency_days").desc_nulls_last())).alias("r_score"),
        F.ntile(5).over(by("lifetime_orders")).alias("f_score"),
    )


def timed(build, spark, sf_dir) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = {name: QUERIES[name] for name in HEADLINE}
    if os.environ.get("BENCH_NAIVE"):
        work |= {"naive_interval_join": naive_intervals, "naive_ntile": naive_ntile}
    timed(QUERIES["m6_kpi_monthly"], spark, sf_dir)  # start the JVM's compilers
    queries = {name: timed(build, spark, sf_dir) for name, build in work.items()}
    total = round(sum(t for n, t in queries.items() if not n.startswith("naive")), 3)
    print(
        json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": queries, "sf": Path(sf_dir).name}),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
