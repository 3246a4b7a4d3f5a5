"""Aggregate builders. All decompose into partial sums, so grouping shuffles one row per group and task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles depend on the order in which tasks finish; decimal sums do not.
WEIGHT_TYPE = "decimal(28,8)"
RATE_TYPE = "decimal(18,2)"


def row_count() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; 0, not NULL, when there are none."""
    return F.count_if(condition)


def flag_total(flag: Column) -> Column:
    """Sum of a 0/1 flag."""
    return F.sum(flag)


def weighted_sum(weight: Column) -> Column:
    """Exact sum of weights as a decimal; a missing weight counts as 0."""
    zero = F.lit(0).cast(WEIGHT_TYPE)
    return F.sum(F.coalesce(weight.try_cast(WEIGHT_TYPE), zero))


def weighted_total(weight: Column) -> Column:
    """Estimated population: the sum of weights as a double."""
    return weighted_sum(weight).cast("double")


def group_mean(value: Column) -> Column:
    """Mean of the known values."""
    return F.avg(value)


def mean_of_rates(rate: Column) -> Column:
    """Unweighted mean of already rounded rates; not a ratio of sums."""
    return F.try_divide(F.sum(rate.cast(RATE_TYPE)).cast("double"), F.count(rate))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """`part` of `whole` in percent, rounded half up on decimals; NULL when `whole` is 0."""
    hundred = F.lit(100).cast("decimal(4,1)")
    return F.round(F.try_divide(part * hundred, whole), digits).cast("double")


def pct_of_group(condition: Column, digits: int = 2) -> Column:
    """Percent of the group's rows where the condition holds."""
    return percent(count_where(condition), row_count(), digits)


def safe_ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percent of a conditional count, 0 when that count is 0."""
    return F.when(whole > 0, percent(part, whole, digits)).otherwise(F.lit(0.0))


def ratio_of_sums(part: Column, whole: Column) -> Column:
    """Unrounded percent of two totals; not a mean of rates."""
    return F.try_divide(part, whole) * 100
