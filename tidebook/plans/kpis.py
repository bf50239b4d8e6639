"""The scorecard: headline KPIs against targets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import (
    percent_change,
    progress_to_ceiling,
    progress_to_floor,
    rag_status,
    ratio_or_null,
)
from tidebook.plans.analysis import last_order_month

# The agreed monthly targets.
TARGETS = {
    "gross_revenue_monthly": 500_000.0,
    "churn_rate_monthly_max": 0.055,
    "cac_max": 1_200.0,
    "ltv_min": 2_500.0,
    "ltv_cac_ratio_min": 3.0,
    "conversion_rate_min": 0.045,
    "retention_30d_min": 0.55,
}

SCORECARD_COLUMNS = ("kpi", "month_label", "value", "prior", "delta_pct", "delta_good", "status", "target", "progress")


def ltv_to_cac(ltv: Column, cac: Column) -> Column:
    """LTV per unit of CAC, 0 without acquisition cost."""
    return F.when(cac.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(ratio_or_null(ltv, cac), F.lit(0.0)))


def reporting_months(monthly: DataFrame, orders: DataFrame, as_of_month: str | None = None) -> DataFrame:
    """One row of structs: the reporting month ``cur``, the one before it ``prev``, and
    ``ret``, the newest mature cohort (``cur`` when no cohort is mature yet).

    The reporting month is the last complete one, or the last before ``as_of_month``.
    """
    row = F.struct(
        "month", "month_label", "recognized_revenue", "churn_rate", "cac", "ltv", "conversion_rate", "retention_30d"
    )
    if as_of_month is None:
        limit = last_order_month(orders)
        rows = monthly.crossJoin(F.broadcast(limit))  # one row
    else:
        rows = monthly.withColumn("open_month", F.lit(as_of_month).cast("date"))
    closed = F.when(F.col("month") < F.col("open_month"), row)
    # One struct per month: the list is as short as the reporting history.
    newest_first = F.sort_array(F.collect_list(closed), asc=False)
    return rows.agg(
        F.get(newest_first, F.lit(0)).alias("cur"),
        F.get(newest_first, F.lit(1)).alias("prev"),
        F.max(F.when(F.col("cohort_is_mature"), row)).alias("mature"),
    ).select("cur", "prev", F.coalesce("mature", "cur").alias("ret"))


def scorecard(
    monthly: DataFrame,
    orders: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    as_of_month: str | None = None,
) -> DataFrame:
    """Six KPIs: value, prior month, signed change, status, target, progress."""
    t = {k: F.lit(float(v)) for k, v in targets.items()}
    ratio = ltv_to_cac(F.col("cur.ltv"), F.col("cur.cac"))
    nothing = F.lit(None).cast("double")

    def line(
        kpi: str,
        value: Column,
        status: Column,
        target: Column,
        progress: Column,
        prior: Column = nothing,
        up_is_good: bool = True,
        month: str = "cur",
    ) -> Column:
        delta = percent_change(value, prior)
        base = F.coalesce(delta, F.lit(0.0))
        compared = prior is not nothing
        good = (base >= 0) if up_is_good else (base <= 0)
        return F.struct(
            F.lit(kpi).alias("kpi"),
            F.col(f"{month}.month_label").alias("month_label"),
            value.alias("value"),
            prior.alias("prior"),
            delta.alias("delta_pct"),
            (good if compared else F.lit(None).cast("boolean")).alias("delta_good"),
            status.alias("status"),
            target.alias("target"),
            progress.alias("progress"),
        )

    revenue, churn, cac = F.col("cur.recognized_revenue"), F.col("cur.churn_rate"), F.col("cur.cac")
    conversion, kept = F.col("cur.conversion_rate"), F.col("ret.retention_30d")
    goal = t["gross_revenue_monthly"]
    lines = [
        line(
            "recognized_revenue",
            revenue,
            rag_status(revenue >= goal, revenue >= goal * F.lit(0.9)),
            goal,
            progress_to_floor(revenue, goal),
            F.col("prev.recognized_revenue"),
        ),
        line(
            "churn_rate",
            churn,
            rag_status(churn <= t["churn_rate_monthly_max"]),
            t["churn_rate_monthly_max"],
            progress_to_ceiling(churn, t["churn_rate_monthly_max"]),
            F.col("prev.churn_rate"),
            up_is_good=False,
        ),
        line(
            "cac",
            cac,
            rag_status(cac <= t["cac_max"]),
            t["cac_max"],
            progress_to_ceiling(cac, t["cac_max"]),
            F.col("prev.cac"),
            up_is_good=False,
        ),
        # Judged by its ratio to CAC; the amount is what is shown.
        line(
            "ltv",
            F.col("cur.ltv"),
            rag_status(ratio >= t["ltv_cac_ratio_min"], ratio >= 2),
            t["ltv_min"],
            progress_to_floor(ratio, t["ltv_cac_ratio_min"]),
        ),
        line(
            "conversion_rate",
            conversion,
            rag_status(conversion >= t["conversion_rate_min"]),
            t["conversion_rate_min"],
            progress_to_floor(conversion, t["conversion_rate_min"]),
            F.col("prev.conversion_rate"),
        ),
        line(
            "retention_30d",
            kept,
            rag_status(kept >= t["retention_30d_min"], kept >= 0.5),
            t["retention_30d_min"],
            progress_to_floor(kept, t["retention_30d_min"]),
            month="ret",
        ),
    ]
    months = reporting_months(monthly, orders, as_of_month)
    return months.select(F.explode(F.array(*lines)).alias("k")).select(*[f"k.{c}" for c in SCORECARD_COLUMNS])
