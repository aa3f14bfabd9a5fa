"""Exact money and averages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"
MONEY_OUT = "decimal(38,2)"


def money(column: Column | str) -> Column:
    """A binary price as a decimal, so that sums do not depend on row order."""
    return _col(column).try_cast(MONEY)


def money_total(column: Column | str) -> Column:
    """Sum of a price column, rounded to cents once at the end."""
    return F.round(F.sum(money(column)), 2).cast(MONEY_OUT)


def hundredths(column: Column | str) -> Column:
    """A ``decimal(p,2)`` value as a whole number of hundredths."""
    return (_col(column) * F.lit(100)).cast("bigint")


def mean_to_cents(total_hundredths: Column, count: Column) -> Column:
    """Mean with two decimals, half away from zero, from whole-number totals.

    Dividing decimals first and rounding afterwards rounds twice; whole-number
    division decides on the exact quotient. NULL where nothing was counted.
    """
    n = F.nullif(count, F.lit(0))
    size = F.call_function("div", F.abs(total_hundredths) * F.lit(2) + n, n * F.lit(2))
    cents = F.when(total_hundredths < 0, -size).otherwise(size)
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
