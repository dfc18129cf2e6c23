"""Recency, frequency and monetary value per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import lookup_by_key


# A noncharacter set aside for internal use.
NOBODY = "\ufdd1"


def _totals(sales: DataFrame, *keys: str) -> DataFrame:
    """Last date, orders and money per key, rows without a customer included.

    ``order_id`` is unique in cleaned sales, so counting it is counting orders.
    """
    return sales.groupBy(*keys).agg(
        F.max("order_date").alias("_last"), F.count("order_id").alias("_orders"), F.sum("sales").alias("_money")
    )


def _whole(totals: DataFrame) -> tuple[Column, Column]:
    """Last date over all rows and number of orders that have a customer.

    Taken from totals per key, not from sales. Both subqueries use every total,
    so that Spark prunes none and reads the one shuffle it has.
    """
    everything = F.struct("_last", "_orders", "_money", F.col("customer_id").isNotNull().alias("_known"))
    latest = totals.select(F.max(everything)["_last"]).scalar()
    counted = F.sum(F.when(F.col("customer_id").isNotNull(), everything["_orders"])) + F.min(everything)["_orders"] * 0
    return latest, totals.select(counted).scalar()


def _values(latest: Column, last: Column, orders: Column, money: Column) -> list[Column]:
    return [
        F.date_diff(latest, last).alias("recency_days"),
        orders.alias("frequency"),
        money.cast("decimal(28,2)").alias("monetary"),
    ]


def customer_value(sales: DataFrame) -> DataFrame:
    """R, F and M per ``customer_id``; rows without one are left out."""
    totals = _totals(sales, "customer_id")
    latest, _ = _whole(totals)
    known = totals.filter(F.col("customer_id").isNotNull())
    return known.select("customer_id", *_values(latest, F.col("_last"), F.col("_orders"), F.col("_money")))


def with_rfm(sales: DataFrame) -> DataFrame:
    """Every sales row with its customer's R, F and M."""
    totals = _totals(sales, "customer_id")
    latest, orders = _whole(totals)
    # The totals of rows without a customer stay, under a key that no row has: a
    # filter would make these another aggregation than the one behind _whole.
    key = F.coalesce("customer_id", F.lit(NOBODY)).alias("customer_id")
    values = totals.select(key, *_values(latest, F.col("_last"), F.col("_orders"), F.col("_money")))
    return lookup_by_key(sales, values, "customer_id", weight="frequency", spread_on="order_id", total=orders)


def rfm_segment(recency: Column, frequency: Column) -> Column:
    """First rule that holds wins; unknown recency is Lost."""
    return (
        F.when((recency <= 30) & (frequency >= 10), "Champions")
        .when((recency <= 60) & (frequency >= 5), "Loyal")
        .when(recency <= 90, "At Risk")
        .otherwise("Lost")
    )


def rank_customers(sales: DataFrame, limit: int | None = 30) -> DataFrame:
    """Customers by money spent, with their segment; all of them without ``limit``.

    Values belong to the id, rows to the (id, name) pair: an id with two names
    shows twice. Sales are grouped once, by pair; the values of an id are added
    up over its pairs.
    """
    pairs = _totals(sales, "customer_id", "customer_name")
    latest, _ = _whole(pairs)
    of_id = Window.partitionBy("customer_id")

    def if_known(c: Column) -> Column:
        return F.when(F.col("customer_id").isNotNull(), c)

    values = _values(
        latest,
        if_known(F.max("_last").over(of_id)),
        if_known(F.sum("_orders").over(of_id)),
        if_known(F.sum("_money").over(of_id)),
    )
    ranked = (
        pairs.select("customer_id", "customer_name", *values)
        .withColumn("rfm_segment", rfm_segment(F.col("recency_days"), F.col("frequency")))
        .orderBy(F.col("monetary").desc_nulls_last(), "customer_id", "customer_name")
    )
    return ranked if limit is None else ranked.limit(limit)
