"""Aggregates whose result does not depend on the order in which rows arrive.

Sums of doubles change in the last digit with the order of the partial sums, so a mean that is rounded
afterwards can differ between two runs. Money is summed in whole millionths, other values as decimals.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


UNITS = 10**6


def micros(col) -> Column:
    """Money as whole millionths of the currency unit: prices keep the digits that a currency conversion adds."""
    value = F.col(col) if isinstance(col, str) else col
    return F.round(value.cast("double") * UNITS).cast("bigint")


def sum_micros(col) -> Column:
    """Sum of a money column in millionths; the decimal total has room for every row of a large table."""
    return F.sum(micros(col).cast("decimal(19,0)"))


def money(total: Column) -> Column:
    """A total in millionths as the nearest double in currency units."""
    return (total.cast("decimal(28,0)") * F.lit(Decimal("0.000001"))).cast("double")


def half_up(numerator: Column, denominator: Column) -> Column:
    """Quotient of two integers rounded to the nearest integer, halves away from zero; null for denominator 0."""
    doubled = F.abs(numerator) * 2 + denominator
    quotient = F.call_function("div", doubled, F.nullif(denominator * 2, F.lit(0)))
    return F.when(numerator < 0, -quotient).otherwise(quotient)


def ratio_money(total: Column, count: Column) -> Column:
    """Mean in currency units of a total in millionths and a count; only this result is rounded, half up to two digits."""
    return (half_up(total.cast("decimal(28,0)"), count * (UNITS // 100)) / F.lit(100.0)).cast("double")


def mean_money(col) -> Column:
    """Mean of a money column, rounded half up to two digits."""
    return ratio_money(sum_micros(col), F.count(col))


def sum_money(col) -> Column:
    """Sum of a money column as a double, added up in millionths."""
    return money(sum_micros(col))


def sum_exact(col, scale: int = 12) -> Column:
    """Sum added up as decimals of ``scale`` digits, returned as a double."""
    return F.sum((F.col(col) if isinstance(col, str) else col).cast(f"decimal(38,{scale})")).cast("double")


def mean_exact(col, scale: int = 12) -> Column:
    """Mean of the non-null values, added up as decimals."""
    return F.try_divide(sum_exact(col, scale), F.count(col))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """100 * numerator / denominator of two integer aggregates, rounded half up; null for a zero denominator."""
    shift = 10**digits
    return (half_up(numerator * (100 * shift), denominator) / F.lit(float(shift))).cast("double")


def stddev_money(col) -> Column:
    """Sample standard deviation of a money column in whole cents, from integer moments; null below two values."""
    value = F.col(col) if isinstance(col, str) else col
    cents = F.round(value.cast("double") * 100).cast("decimal(19,0)")
    n = F.count(value).cast("decimal(38,0)")
    s1 = F.sum(cents).cast("decimal(38,0)")
    s2 = F.sum((cents * cents).cast("decimal(38,0)")).cast("decimal(38,0)")
    spread = (n * s2 - s1 * s1).cast("double")
    return F.when(F.count(value) > 1, F.sqrt(spread / (n * (n - 1)).cast("double")) / F.lit(100.0))
