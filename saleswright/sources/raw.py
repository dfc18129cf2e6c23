"""Bring any sales-shaped DataFrame to the raw schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW

# Texts that stand for a missing value in CSV files.
MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# An ISO date, with or without a time after it.
DATES = "yyyy-MM-dd[ HH:mm[:ss]]['T'HH:mm[:ss]]"


def _known(c: Column, source: T.DataType) -> Column:
    """Missing-value texts and NaN become null before any comparison sees them."""
    if isinstance(source, T.StringType):
        return F.when(~c.isin(*MISSING), c)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    return c


def _decimal(c: Column, source: T.DataType, target: T.DecimalType) -> Column:
    """``c`` in the target's decimals; raises if that would turn a value into 0."""
    typed = c.cast(target)
    if not isinstance(source, (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)):
        return typed
    lost = (typed == 0) & (c.cast("double") != 0)
    message = F.concat(F.lit("CAST_INVALID_INPUT: more decimals than are kept: "), c.cast("string"))
    return F.when(lost, F.raise_error(message).cast(target)).otherwise(typed)


def _typed(c: Column, source: T.DataType, target: T.DataType, date_format: str) -> Column:
    c = _known(c, source)
    if source == target:
        return c
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        return F.to_date(c, date_format)
    if isinstance(target, T.DecimalType):
        return _decimal(c, source, target)
    return c.cast(target)


def conform(df: DataFrame, date_format: str = DATES) -> DataFrame:
    """Known columns in their types, all others untouched.

    Numbers keep ten decimals (discounts six); a smaller one raises rather than
    count as 0. Text that is no number or date raises, as ``configure`` puts
    the session in ANSI mode.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {f.name: _typed(F.col(f.name), kinds[f.name], f.dataType, date_format) for f in RAW.fields if f.name in kinds}
    )
