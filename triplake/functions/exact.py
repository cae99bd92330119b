"""Sums that do not depend on the order in which tasks finish.

Money, miles and minutes sit on a grid: cents, hundredths of a mile, whole
seconds. Each value is counted in grid steps as a decimal, and what is left over
is summed beside it as a double. For values on the grid the rest is exactly
zero, so the sum is exact and every run gives the same bits, whatever the size
of the values or their number. Values off the grid, NaN, infinities and values
beyond 28 digits pass through the rest, as in a plain sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Steps per unit.
MONEY_STEPS = 10_000
MINUTE_STEPS = 60
COUNT_STEPS = 1

# Ten digits are left for the number of values in a sum.
_STEPS = "decimal(28,0)"


def steps(value: Column, per_unit: int) -> Column:
    return F.round(value * F.lit(float(per_unit))).try_cast(_STEPS)


def step_sum(value: Column, per_unit: int) -> Column:
    return F.sum(steps(value, per_unit))


def rest_sum(value: Column, per_unit: int) -> Column:
    on_grid = F.coalesce(steps(value, per_unit).cast("double"), F.lit(0.0))
    return F.sum(value - on_grid / F.lit(float(per_unit)))


def joined_sum(step_total: Column, rest_total: Column, per_unit: int) -> Column:
    """Put the two sums together; NULL when the group held no value."""
    grid = F.coalesce(step_total, F.lit(0)).cast("double") / F.lit(float(per_unit))
    return grid + rest_total


def exact_sum(value: Column, per_unit: int) -> Column:
    return joined_sum(step_sum(value, per_unit), rest_sum(value, per_unit), per_unit)


def exact_avg(value: Column, per_unit: int) -> Column:
    return exact_sum(value, per_unit) / F.nullif(F.count(value), F.lit(0))
