"""Exact money arithmetic on whole cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A DECIMAL(p,2) amount as BIGINT cents; long buffers keep hash aggregation fast."""
    return (amount * F.lit(100)).cast("bigint")


def money(cents_value: Column) -> Column:
    """BIGINT cents as DECIMAL(20,2)."""
    return (cents_value.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def average_cents(total: Column, count: Column) -> Column:
    """Mean of positive amounts in whole cents, ties rounded up.

    Twice the total stays far below the BIGINT limit for a group's total, and
    the DECIMAL division of large integers is avoided.
    """
    whole = F.call_function("div", total, count)
    rest = total - whole * count
    return whole + F.when(rest * 2 >= count, 1).otherwise(0)
