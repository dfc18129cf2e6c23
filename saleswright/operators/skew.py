"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of all rows, so fewer than 1,000 keys can be.
HOT_SHARE = 1000


def lookup_by_key(
    rows: DataFrame, per_key: DataFrame, key: str, weight: str, spread_on: str, total: Column | None = None
) -> DataFrame:
    """Left join of ``rows`` to ``per_key``, which is unique on ``key``.

    ``weight`` has to be the number of rows per key, already known from building
    ``per_key``: the bound on what is broadcast rests on it. ``total`` is the
    number of rows with a key, counted here unless given. Hot keys, at most ``HOT_SHARE`` of them by construction, are
    looked up by broadcast. All other keys go through a shuffle join in which
    rows that are done, and rows without a key, are spread by ``spread_on``
    instead of landing on one reducer.
    """
    values = [c for c in per_key.columns if c != key]
    if total is None:
        total = rows.select(F.count(key)).scalar()
    is_hot = F.col(weight) * HOT_SHARE > total

    packed = per_key.select(key, F.struct(*values).alias("_v"), is_hot.alias("_is_hot"))
    hot = packed.filter("_is_hot").select(key, F.col("_v").alias("_hot"))
    rest = packed.filter("NOT _is_hot").select(
        F.col(key).alias("_key"), F.xxhash64(key).alias("_key_lane"), F.col("_v").alias("_rest")
    )

    # The route is null once a row needs no partner; the lane, second join key,
    # is what such rows are then shuffled by.
    route = F.when(F.col("_hot").isNull(), F.col(key))
    lane = F.when(route.isNull(), F.xxhash64(spread_on)).otherwise(F.xxhash64(key))
    routed = rows.join(F.broadcast(hot), key, "left").withColumns({"_route": route, "_lane": lane})
    joined = routed.join(
        rest, (F.col("_route") == F.col("_key")) & (F.col("_lane") == F.col("_key_lane")), "left"
    )
    found = F.coalesce("_hot", "_rest")
    return joined.select(*rows.columns, *[found[v].alias(v) for v in values])
