"""Exact money and ratio arithmetic on integers.

Amounts are summed as integer cents (a long, so partial aggregation stays in
generated code) and averages round half away from zero, without ever going
through floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """DECIMAL(12,2) amount as whole cents."""
    return (amount * 100).cast("bigint")


def sum_cents(amount: str) -> Column:
    return F.sum(cents(F.col(amount)))


def divide_half_up(total: Column, count: Column) -> Column:
    """Integer quotient rounded half away from zero; NULL when the count is 0."""
    count = F.nullif(count, F.lit(0))
    size = F.call_function("div", F.abs(total) * 2 + count, count * 2)
    return F.when(total < 0, -size).otherwise(size)


def scaled_ratio(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded half up to ``digits`` places, as an integer."""
    return divide_half_up(total * (10**digits), count)


def from_units(units: Column, digits: int = 2) -> Column:
    """Integer units of 10^-digits as an exact decimal."""
    return F.try_divide(units.cast("decimal(20,0)"), F.lit(10**digits).cast("decimal(6,0)")).cast(
        f"decimal(20,{digits})"
    )


def as_money(cent_column: Column) -> Column:
    return from_units(cent_column, 2)


def avg_money(sum_of_cents: Column, count: Column) -> Column:
    return as_money(divide_half_up(sum_of_cents, count))


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 when the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
