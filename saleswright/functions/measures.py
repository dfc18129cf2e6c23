"""Aggregate measures over cleaned sales, each defined once, as SQL.

DataFrame queries take them as expressions, view statements as text.
``order_id`` is unique in cleaned sales, so counting it counts orders and leaves
at most one DISTINCT per query. Means are brought to six decimals before they
are rounded, like all quotients.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MARGIN

_SIX = "decimal(28,6)"
_DISCOUNTED = "sum(CASE WHEN is_discounted = 1 THEN sales ELSE 0 END)"

MEASURES = {
    "orders": "count(order_id)",
    "customers": "count(DISTINCT customer_id)",
    "units": "sum(quantity)",
    "revenue": "round(sum(sales), 2)",
    "profit": "round(sum(profit), 2)",
    "margin": f"round(cast(avg({{margin}}) AS {_SIX}), 2)",
    "discount": f"round(cast(avg(discount) AS {_SIX}) * 100, 1)",
    "per_order": f"round(cast(try_divide(sum(sales), count(order_id)) AS {_SIX}), 2)",
    "discounted_share": f"round(cast(try_divide({_DISCOUNTED}, sum(sales)) * 100 AS {_SIX}), 2)",
}


def measure_sql(name: str, margin: str = MARGIN) -> str:
    """The text of a measure; ``margin`` is what the margin column is called."""
    return MEASURES[name].format(margin=f"`{margin}`")


def measures(**named: str) -> list[Column]:
    """Columns by the measure each one shows."""
    return [F.expr(measure_sql(name)).alias(column) for column, name in named.items()]


_SUM = "decimal(38,10)"
#: What partial results are made of: SQL over sales and type. States of two
#: parts add up to those of the whole; a mean is a sum and a count.
STATES = {
    "orders": ("count(order_id)", "long"),
    "units": ("sum(quantity)", _SUM),
    "revenue": ("sum(sales)", _SUM),
    "profit": ("sum(profit)", _SUM),
    "discounted": (_DISCOUNTED, _SUM),
    "margin_sum": ("sum({margin})", "decimal(38,2)"),
    "margin_n": ("count({margin})", "long"),
    "discount_sum": ("sum(discount)", "decimal(38,6)"),
    "discount_n": ("count(discount)", "long"),
}
#: Measures from states; ``customers`` is counted from bitmaps.
_FROM_STATES = {
    "orders": "coalesce(orders, 0)",
    "customers": "customers",
    "units": "units",
    "revenue": "round(revenue, 2)",
    "profit": "round(profit, 2)",
    "margin": f"round(cast(cast(try_divide(margin_sum, margin_n) AS decimal(22,6)) AS {_SIX}), 2)",
    "discount": f"round(cast(cast(try_divide(discount_sum, discount_n) AS decimal(11,10)) AS {_SIX}) * 100, 1)",
    "per_order": f"round(cast(try_divide(revenue, orders) AS {_SIX}), 2)",
    "discounted_share": f"round(cast(try_divide(discounted, revenue) * 100 AS {_SIX}), 2)",
}


def state_sql(margin: str = MARGIN) -> dict[str, str]:
    """The text of each state over sales."""
    return {name: sql.format(margin=f"`{margin}`") for name, (sql, _) in STATES.items()}


def state_measures(**named: str) -> list[Column]:
    """Columns by the measure each one shows, over added-up states."""
    return [F.expr(_FROM_STATES[name]).alias(column) for column, name in named.items()]
