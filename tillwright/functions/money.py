"""Exact decimal money arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
TOTAL = "decimal(20,2)"


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Amount of one sale line, rounded to cents."""
    return F.round(quantity * unit_price, 2).cast(MONEY)


def total(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def exact_average(amount: Column, n: Column) -> Column:
    """``amount / n`` rounded half away from zero to cents; NULL when ``n`` is 0 or NULL.

    Works on whole cents, since ``avg`` and decimal division keep only a few digits and
    would round a second time.
    """
    n = F.nullif(n, F.lit(0).cast("bigint")).cast("decimal(18,0)")
    doubled = F.abs(amount) * F.lit(Decimal(200)) + n
    cents = F.call_function("div", doubled.cast("decimal(38,0)"), (n * F.lit(Decimal(2))).cast("decimal(38,0)"))
    signed = cents * F.when(amount < 0, F.lit(-1)).otherwise(F.lit(1))
    return (signed.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def or_zero(value: Column, as_type: str) -> Column:
    return F.coalesce(value, F.lit(0)).cast(as_type)


def display_amount(value: Column, suffix: str = " €") -> Column:
    return F.concat(F.format_number(value, 2), F.lit(suffix))


def display_count(value: Column) -> Column:
    return F.format_number(value, 0)
