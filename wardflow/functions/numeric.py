"""Rounding, ratios and order-independent sums.

Measures are rounded through a decimal, never straight from a double: a binary double a hair
below a tie rounds differently from engine to engine and from one merge order to the next.
Sums of fractional columns run on decimals for the same reason, so a retried or re-planned
stage cannot change the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for every value the quality rules accept; a cast that could still fail gives NULL,
# so that no single value stops a stage.
RATIO = "decimal(38,6)"
MONEY = "decimal(18,4)"
FRACTION = "decimal(28,3)"
REVENUE = "decimal(28,2)"


def rounded(value: Column, scale: int) -> Column:
    """Half-up rounding of a ratio-sized number, returned as double."""
    return F.round(value.try_cast(RATIO), scale).cast("double")


def rounded_total(total: Column, scale: int = 2) -> Column:
    """Half-up rounding of a decimal sum of any size, returned as double."""
    return F.round(total, scale).cast("double")


def exact_sum(column: str) -> Column:
    return F.sum(F.col(column).try_cast(FRACTION))


def revenue_sum(column: str) -> Column:
    """Sum of already rounded revenue figures, wide enough for any number of them."""
    return F.sum(F.col(column).try_cast(REVENUE))


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean(column: str, scale: int) -> Column:
    """Average of an integer or decimal column over its non-null rows."""
    return rounded(ratio(F.sum(column), F.count(column)), scale)


def mean_of_doubles(column: str, scale: int) -> Column:
    """Average of a double column, summed exactly."""
    return rounded(ratio(exact_sum(column), F.count(column)), scale)


def stddev_of_integers(column: str, scale: int) -> Column:
    """Sample standard deviation from whole-number sums, the same for every merge order.

    NULL for a single row. Meant for small magnitudes such as days, where the subtraction below
    loses no visible digit.
    """
    n = F.count(column).cast("double")
    total = F.sum(F.col(column).cast("bigint")).cast("double")
    squares = F.sum(F.col(column).cast("bigint") * F.col(column)).cast("double")
    spread = F.greatest(squares - total * F.try_divide(total, n), F.lit(0.0))
    return rounded(F.sqrt(F.try_divide(spread, n - 1)), scale)


def share_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    return rounded(F.lit(100.0) * ratio(part, whole), scale)


def millions(total: Column, scale: int = 2) -> Column:
    return rounded(total.cast("double") / F.lit(1e6), scale)


def count_true(column: str | Column) -> Column:
    return F.count_if(F.col(column) if isinstance(column, str) else column)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("SECOND", F.col(start) if isinstance(start, str) else start,
                            F.col(end) if isinstance(end, str) else end)


def finite_or_null(column: str | Column) -> Column:
    """NaN and infinities as NULL, the only form JSON consumers accept."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def whole_number(column: str) -> Column:
    """An integer from text such as ``45`` or ``45.0``; NULL for anything else."""
    value = F.col(column).try_cast(RATIO)
    return F.when(value == F.floor(value), value.try_cast("int"))
