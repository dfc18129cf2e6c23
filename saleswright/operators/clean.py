"""Cleaning and row-level enrichment of raw sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clip_fraction, day_name, flag, normalize, percent, rounded_ratio
from ..schema import LABELS, MARGIN, MONEY, SEQUENCE
from .dedupe import keep_first
from .quality import Checks


def clean(raw: DataFrame, keys: Sequence[str] = ("order_id",), checks: Checks | None = None) -> DataFrame:
    """One valid row per order, with date parts, ratios and flags.

    Duplicates go before invalid rows do, so an invalid first row also removes
    a later valid one with its key. ``keys`` may name extra columns that
    ``order_id`` determines: a source already partitioned on them then needs
    no further shuffle. Such helper columns are dropped from the result.
    ``checks`` count issues on the way.
    """
    helpers = [k for k in keys if k != "order_id"]
    first = keep_first(checks.seen(raw) if checks else raw, keys)
    return clean_unique((checks.kept(first) if checks else first).drop(SEQUENCE, *helpers))


def clean_unique(unique: DataFrame) -> DataFrame:
    """``clean`` for rows that are the first of their order already."""
    d = F.col("order_date")
    valid = (
        unique.filter((F.col("sales") > 0) & (F.col("quantity") > 0))
        .withColumns(
            {
                "discount": clip_fraction(F.col("discount")),
                "profit": F.coalesce(F.col("profit"), F.lit(0).cast(MONEY)),
                **{c: normalize(F.col(c)) for c in LABELS if c in unique.columns},
            }
        )
    )
    return valid.withColumns(
        {
            "order_year": F.year(d),
            "order_month": F.month(d),
            "order_quarter": F.quarter(d),
            "order_week": F.weekofyear(d),
            "order_dow": day_name(d),
            MARGIN: percent(F.col("profit"), F.col("sales")).cast("decimal(18,2)"),
            "revenue_per_unit": rounded_ratio(F.col("sales"), F.col("quantity")).cast("decimal(18,2)"),
            "is_discounted": flag(F.col("discount") > 0),
            "is_profitable": flag(F.col("profit") > 0),
        }
    )
