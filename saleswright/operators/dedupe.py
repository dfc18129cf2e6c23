"""Keep the first row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SEQUENCE


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """First row per key in input order; null keys count as equal.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle: each task sends at most one row per key, so a key that fills a
    third of the input costs its reducer one row per map task.

    Without ``order`` the input position decides, or all columns if the source
    recorded none.
    """
    if order is None:
        order = [SEQUENCE] if SEQUENCE in df.columns else df.columns
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
