"""Decimal arithmetic with one rounding rule: half away from zero.

A quotient is first brought to six decimals and only then rounded to what is
shown, so that the result does not hang on how wide a division happens to be.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FRACTION, RAW_FRACTION

SIX = "decimal(28,6)"


def _six(c: Column) -> Column:
    return c.cast(SIX)


def rounded_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` rounded; null where the denominator is zero."""
    return F.round(_six(F.try_divide(num, den)), digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den * 100`` rounded; null where the denominator is zero."""
    return F.round(_six(F.try_divide(num, den) * 100), digits)


def average(c: Column, digits: int = 2, scale: int = 1) -> Column:
    """Mean of a decimal column times ``scale``, rounded."""
    return F.round(_six(F.avg(c)) * scale, digits)


def clip_fraction(c: Column) -> Column:
    """Missing becomes 0; the rest is held inside [0, 1]."""
    zero, one = (F.lit(Decimal(n)).cast(RAW_FRACTION) for n in (0, 1))
    return F.least(one, F.greatest(zero, F.coalesce(c.cast(RAW_FRACTION), zero))).cast(FRACTION)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, also where it is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def in_lakhs(c: Column) -> Column:
    """Amounts in units of 100,000, as charts show them; exact for two decimals."""
    return (c / F.lit(Decimal(100000))).cast("decimal(28,7)")
