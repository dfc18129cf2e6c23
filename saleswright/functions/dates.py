"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_name(d: Column) -> Column:
    """English day name; a lookup, so it needs neither formatter nor locale."""
    return F.element_at(F.array(*[F.lit(n) for n in _DAYS]), F.weekday(d) + 1)


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.trunc(d, "week")


def period_label(year: Column, month: Column) -> Column:
    """``2024-03``."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
