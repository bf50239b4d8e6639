"""Order-independent sums and means.

Amounts and rates arrive as DOUBLE. A double sum depends on the order in which
partitions finish, so the same job can print two different totals. Here each value
becomes a decimal, sums are DECIMAL(38, scale), and the result goes back to DOUBLE once.
The default scale of ten decimals leaves cents, and tiny amounts, as they are, and has
room for totals of 1e28; columns of small shares are summed with more decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = 10  # decimals of amounts
RATE = 15  # of values around 0..1
DIGITS = 28  # of one value; a sum has ten more


def exact_units(amount: Column, scale: int = MONEY) -> Column:
    return amount.cast(f"decimal({DIGITS},{scale})")


def no_units(scale: int = MONEY) -> Column:
    return exact_units(F.lit(0), scale)


def from_units(units: Column) -> Column:
    return units.cast("double")


def exact_sum(amount: Column, scale: int = MONEY) -> Column:
    """Sum of a column as DOUBLE; NULL when no row has a value."""
    return from_units(F.sum(exact_units(amount, scale)))


def exact_mean(amount: Column, scale: int = MONEY) -> Column:
    """Mean of a column, NULLs left out; NULL when nothing is left."""
    return F.try_divide(exact_sum(amount, scale), F.count(amount))


def rate_mean(rate: Column) -> Column:
    return exact_mean(rate, RATE)


def share_of(condition: Column) -> Column:
    """Share of rows for which ``condition`` holds (NULL counts as not)."""
    hits = F.sum(F.when(condition, 1).otherwise(0)).cast("double")
    return F.try_divide(hits, F.count(F.lit(1)))


def round_half_away(x: Column, digits: int = 0) -> Column:
    """Round in double arithmetic, ties away from zero.

    ``F.round`` rounds the printed decimal form instead, which differs on values
    such as 1.005 that no double can hold.
    """
    scale = F.lit(float(10**digits))
    scaled = x * scale
    whole = F.signum(scaled) * F.floor(F.abs(scaled) + F.lit(0.5)).cast("double")
    return whole / scale
