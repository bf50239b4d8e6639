"""Guarded ratios and the scoring rules built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_null(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL when ``whole`` is zero or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``; 0 unless ``whole`` is positive. A NULL part stays NULL."""
    return F.when(whole > 0, ratio_or_null(part, whole)).otherwise(F.lit(0.0))


def percent_change(now: Column, before: Column) -> Column:
    """Signed change in percent of the size of ``before``; NULL without a base."""
    return ratio_or_null(now - before, F.abs(before)) * F.lit(100.0)


def rag_status(good: Column, warn: Column | None = None) -> Column:
    """``on`` / ``watch`` / ``off``."""
    out = F.when(good, F.lit("on"))
    if warn is not None:
        out = out.when(warn, F.lit("watch"))
    return out.otherwise(F.lit("off"))


def _clip01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def progress_to_floor(value: Column, target: Column) -> Column:
    """How far a should-be-high value has come to its target, from 0 to 1."""
    return F.coalesce(_clip01(ratio_or_null(value, target)), F.lit(0.0))


def progress_to_ceiling(value: Column, target: Column) -> Column:
    """The mirror image for a should-be-low value."""
    usable = value.isNotNull() & (target != 0)
    tiny = F.lit(1e-9)
    return F.when(usable, _clip01(ratio_or_null(target, F.greatest(value, tiny)))).otherwise(F.lit(0.0))


def share_label(part: Column) -> Column:
    """0.123 -> ``12%``."""
    return F.format_string("%.0f%%", part * F.lit(100.0))
