"""Exact arithmetic on decimal amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"


def cents(amount: Column) -> Column:
    """Whole cents of an amount with two places.

    A 64-bit sum is much cheaper than a decimal one, is as exact, and fails loudly
    on overflow under ANSI.
    """
    return (amount * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(AMOUNT)


def rounded_mean(total: Column, count: Column) -> Column:
    """total / count in decimal, half away from zero at two places."""
    return F.round(F.try_divide(total.cast("decimal(20,2)"), count), 2).cast(AMOUNT)


def rounded_mean_of_cents(total: Column, count: Column) -> Column:
    return rounded_mean(total.cast("decimal(20,0)") * F.lit(Decimal("0.01")), count)


def mean(total: Column, count: Column) -> Column:
    """Unrounded mean. Spark's avg over decimals keeps only four extra digits."""
    return F.try_divide(total.cast("double"), count)


def order_amount(price: str = "price", freight: str = "freight_value") -> Column:
    return F.col(price) + F.col(freight)
