"""Weekly series and the feature panel for forecasting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import week_start
from ..schema import MARGIN

# The model inputs, in this order.
FEATURES = (
    "orders",
    "avg_order_value",
    "unique_customers",
    "avg_margin",
    "discounted_orders",
    "revenue_lag1",
    "revenue_lag2",
    "revenue_lag3",
    "revenue_lag4",
    "orders_lag1",
    "orders_lag2",
    "orders_lag3",
    "orders_lag4",
    "revenue_ma4",
    "revenue_ma8",
    "revenue_std4",
    "week_of_year",
    "month",
    "quarter",
    "is_q4",
)
LAGS = (1, 2, 3, 4)
TEST_SHARE = 0.2


def weekly(sales: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One row per observed week, and per series if columns are named.

    Rows without a date belong to no week. The distinct customers of a week
    are first reduced by (week, customer), so a busy week is no hot spot.
    """
    return (
        sales.filter(F.col("order_date").isNotNull())
        .groupBy(*series, week_start(F.col("order_date")).alias("week"))
        .agg(
            F.sum("sales").cast("decimal(28,2)").alias("revenue"),
            F.count("order_id").alias("orders"),
            F.avg("sales").cast("decimal(28,6)").alias("avg_order_value"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.avg(MARGIN).cast("decimal(28,6)").alias("avg_margin"),
            F.sum("is_discounted").alias("discounted_orders"),
        )
    )


def calendar(week) -> dict:
    """Calendar features of a week, by its Monday."""
    return {
        "week_of_year": F.weekofyear(week),
        "month": F.month(week),
        "quarter": F.quarter(week),
        "is_q4": (F.quarter(week) == 4).cast("int"),
    }


def build_features(sales: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """The weekly panel with lags and moving figures; incomplete rows dropped.

    Lags go by observed row, so a week without sales is not a zero. Moving
    figures look at earlier rows only and need their whole window. Without
    series columns the window holds one row per calendar week, the only case
    in which it is not partitioned.
    """
    in_order = Window.partitionBy(*series).orderBy("week")
    past4, past8 = in_order.rowsBetween(-4, -1), in_order.rowsBetween(-8, -1)

    def whole(window, size, value):
        return F.when(F.count("revenue").over(window) == size, value.over(window)).cast("decimal(28,6)")

    lags = {f"{c}_lag{k}": F.lag(c, k).over(in_order) for c in ("revenue", "orders") for k in LAGS}
    panel = weekly(sales, series).withColumns(
        {
            **lags,
            "revenue_ma4": whole(past4, 4, F.avg("revenue")),
            "revenue_ma8": whole(past8, 8, F.avg("revenue")),
            "revenue_std4": whole(past4, 4, F.stddev_samp(F.col("revenue").cast("double"))),
            **calendar(F.col("week")),
        }
    )
    return panel.select(*series, "week", "revenue", *FEATURES).na.drop(subset=["week", "revenue", *FEATURES])


def split_by_time(panel: DataFrame, series: Sequence[str] = (), test_share: float = TEST_SHARE) -> DataFrame:
    """Flag the first part of each series as training data."""
    all_rows = Window.partitionBy(*series)
    position = F.row_number().over(all_rows.orderBy("week"))
    train_rows = F.floor(F.count(F.lit(1)).over(all_rows) * F.lit(1 - test_share))
    return panel.withColumn("is_train", (position <= train_rows).cast("int"))
