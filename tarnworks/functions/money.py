"""Amount casts, range rules and tolerant comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import AMOUNT_HIGH, AMOUNT_LOW, TOLERANCE


def to_money(amount: Column) -> Column:
    """DECIMAL(12,2), rounding half up; NaN and values that do not fit become NULL."""
    return amount.try_cast("decimal(12,2)")


def to_mart_money(amount: Column) -> Column:
    return amount.try_cast("decimal(18,2)")


def valid_flag(id_: Column, amount: Column, low=AMOUNT_LOW, high=AMOUNT_HIGH) -> Column:
    """Three-valued on purpose: NULL for a known id with an unknown amount."""
    return id_.isNotNull() & (amount > low) & (amount <= high)


def out_of_range(amount: Column, low=AMOUNT_LOW, high=AMOUNT_HIGH) -> Column:
    """Range test on the raw amount, so 1000.004 is out here though it rounds to a valid sale."""
    return amount.isNotNull() & ((amount <= low) | (amount > high))


def money_total(amount: Column) -> Column:
    """Sum rounded to cents; 0 over no rows, so that comparisons never meet NULL."""
    return F.coalesce(F.round(F.sum(amount), 2), F.lit(0))


def agrees(left: Column, right: Column, tolerance: str = TOLERANCE) -> Column:
    return F.abs(left - right) < F.lit(tolerance).cast("decimal(12,4)")


def at_most(left: Column, right: Column, tolerance: str = TOLERANCE) -> Column:
    return left <= right + F.lit(tolerance).cast("decimal(12,4)")
