"""Exact numeric expressions: decimals for ratios, whole numbers for truncating division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Operands of a ratio: wide enough for sums over very large tables.
OPERAND = "decimal(22,2)"


def cents(amount: Column) -> Column:
    """Amount with two digits, stored as double, as whole cents: exact and cheap to sum."""
    return F.rint(amount * 100).cast("bigint")


def int_div(a: Column, b: Column) -> Column:
    """Whole-number division that drops the fraction; NULL where b is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def truncated_avg(value: Column) -> Column:
    """Average of whole numbers as a whole number."""
    return int_div(F.sum(value), F.count(value)).cast("bigint")


def ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """num * times / den rounded half up to `digits`; NULL where den is 0.

    Both sides are whole numbers or have at most two digits after the point.
    """
    base = den.cast(OPERAND)
    exact = num.cast(OPERAND) * F.lit(times) / F.when(base != 0, base)
    return F.round(exact, digits).cast(f"decimal(18,{digits})")


def cut_ratio(num: Column, den: Column) -> Column:
    """num / den with six digits, the rest dropped; `den` is a whole number."""
    millionths = int_div((num * F.lit(1_000_000)).cast("bigint"), F.when(den != 0, den))
    unit = F.lit("0.000001").cast("decimal(7,6)")
    return (millionths.cast("decimal(19,0)") * unit).cast("decimal(18,6)")


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """num as a percentage of den."""
    return ratio(num, den, digits, times=100)


def decimal_avg(value: Column, digits: int) -> Column:
    """Average rounded half up to `digits`."""
    return ratio(F.sum(value), F.count(value), digits)
