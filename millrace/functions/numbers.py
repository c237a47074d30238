"""Numeric expressions whose result does not depend on task order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(col: Column | str) -> Column:
    """Fixed-point view of an amount: decimal sums are exact in any order."""
    return F.col(col).cast(MONEY) if isinstance(col, str) else col.cast(MONEY)


def money_sum(col: Column | str) -> Column:
    return F.sum(money(col)).cast("double")


def money_avg(col: Column | str) -> Column:
    fixed = money(col)
    return F.try_divide(F.sum(fixed).cast("double"), F.count(fixed).cast("double"))


def exact_avg(col: Column | str, kind: str = "decimal(28,10)") -> Column:
    """Mean of measurements such as scores, of which ten decimals count, in any task order."""
    fixed = (F.col(col) if isinstance(col, str) else col).cast(kind)
    return F.try_divide(F.sum(fixed).cast("double"), F.count(fixed).cast("double"))


def safe_ratio(part: Column, whole: Column) -> Column:
    """Division that yields null instead of failing on a zero or null denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded_ratio(part: Column, whole: Column, factor: int = 1, places: int = 2) -> Column:
    """``round(part * factor / whole, places)`` for whole numbers, rounded half up in integers.

    Binary doubles put many ties on the wrong side; integer arithmetic does not.
    """
    scale = factor * 10**places
    bottom = whole.cast("bigint") * 2
    top = part.cast("bigint") * F.lit(2 * scale).cast("bigint") + whole.cast("bigint")
    return F.when(whole != 0, F.call_function("div", top, bottom) / F.lit(float(10**places)))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return rounded_ratio(part, whole, factor=100, places=places)
