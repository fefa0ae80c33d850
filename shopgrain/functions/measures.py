"""Measures: aggregate columns over sales lines, for use in `agg`.

Ratios are ratios of sums, as doubles with six decimals, and null where the
divisor is null or zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as words
from .clean import mentions

RATIO_DECIMALS = 6


def ratio(part: Column, whole: Column) -> Column:
    divisor = whole.cast("double")
    return F.round(part.cast("double") / F.when(divisor != 0, divisor), RATIO_DECIMALS)


def percent(part: Column, whole: Column) -> Column:
    divisor = whole.cast("double")
    return F.round(part.cast("double") * 100.0 / F.when(divisor != 0, divisor), RATIO_DECIMALS)


def revenue() -> Column:
    """Net revenue of completed lines; zero when there are none."""
    return F.coalesce(F.sum(F.when(F.col("IsSuccess"), F.col("NetRevenue"))), F.lit(0).cast("decimal(38,4)"))


def units() -> Column:
    return F.sum("Quantity")


def lines() -> Column:
    return F.count(F.lit(1))


def success_lines() -> Column:
    return F.count(F.when(F.col("IsSuccess"), 1))


def gross_value() -> Column:
    return F.sum("GMV")


def platform_fee() -> Column:
    """Fees as a positive amount; one feed stores them negative."""
    return F.sum(F.abs("PlatformFee"))


def discount() -> Column:
    return F.sum("DiscountAmount")


def list_value() -> Column:
    """Value at list price."""
    return F.sum(F.col("ListPrice") * F.col("Quantity"))


def is_returned() -> Column:
    return mentions(F.col("StatusRaw"), words.RETURNED)
