"""KPI queries.

All take cleaned sales. Orders with ties get the key columns as tie-break, so
results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import measures

MAX_PRODUCTS = 50

# What each query shows, by measure.
OVERALL = {
    "total_orders": "orders",
    "unique_customers": "customers",
    "total_revenue": "revenue",
    "total_profit": "profit",
    "avg_margin_pct": "margin",
    "avg_order_value": "per_order",
    "discounted_revenue_pct": "discounted_share",
}
MONTHLY = {
    "total_orders": "orders",
    "revenue": "revenue",
    "profit": "profit",
    "avg_margin_pct": "margin",
    "unique_customers": "customers",
    "avg_order_value": "per_order",
}
PRODUCTS = {
    "units_sold": "units",
    "order_count": "orders",
    "total_revenue": "revenue",
    "total_profit": "profit",
    "avg_margin_pct": "margin",
    "avg_discount_pct": "discount",
}
MATRIX = {"orders": "orders", "customers": "customers", "revenue": "revenue", "profit": "profit", "avg_margin_pct": "margin"}
REPS = {
    "orders_closed": "orders",
    "customers_served": "customers",
    "total_revenue": "revenue",
    "total_profit": "profit",
    "avg_margin_pct": "margin",
    "avg_deal_size": "per_order",
}
DISCOUNTS = {
    "avg_discount_pct": "discount",
    "order_count": "orders",
    "total_revenue": "revenue",
    "total_profit": "profit",
    "avg_margin_pct": "margin",
}
ALERTS = {"order_count": "orders", "avg_margin_pct": "margin", "total_revenue": "revenue"}


def overall_kpis(sales: DataFrame) -> DataFrame:
    """One row of headline figures."""
    return sales.agg(*measures(**OVERALL))


def revenue_trend_monthly(sales: DataFrame, year: int | None = None) -> DataFrame:
    """Figures per month; of one year only if given (0 means all years)."""
    if year:
        sales = sales.filter(F.col("order_year") == year)
    return sales.groupBy("order_year", "order_month").agg(*measures(**MONTHLY)).orderBy("order_year", "order_month")


def product_totals(sales: DataFrame) -> DataFrame:
    """Figures per product, unordered."""
    return sales.groupBy("product_name", "product_category").agg(*measures(**PRODUCTS))


def most_revenue(products: DataFrame, limit: int) -> DataFrame:
    """Those with most revenue. Planned as a top-k: no full sort."""
    return products.orderBy(F.desc("total_revenue"), "product_name", "product_category").limit(limit)


def top_products(sales: DataFrame, limit: int = 10) -> DataFrame:
    """Products with most revenue."""
    return most_revenue(product_totals(sales), limit)


def clamp_limit(limit: int | None) -> int:
    """The number of products a request may ask for: 10 unless given, 1 to 50."""
    return max(1, min(10 if limit is None else limit, MAX_PRODUCTS))


def requested_products(sales: DataFrame, limit: int | None = None) -> DataFrame:
    """Top products for a client, who may ask for 1 to 50."""
    return top_products(sales, clamp_limit(limit))


def region_segment_matrix(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region", "segment").agg(*measures(**MATRIX)).orderBy(F.desc("revenue"), "region", "segment")


def sales_rep_leaderboard(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sales_rep").agg(*measures(**REPS)).orderBy(F.desc("total_revenue"), "sales_rep")


def pricing_labels(figures: DataFrame) -> DataFrame:
    """Figures per ``is_discounted`` with its label in front."""
    label = F.when(F.col("is_discounted") == 1, "Discounted").otherwise("Full Price")
    return figures.select(label.alias("pricing_type"), "*").drop("is_discounted")


def discount_impact(sales: DataFrame) -> DataFrame:
    """Discounted against full-price orders."""
    return pricing_labels(sales.groupBy("is_discounted").agg(*measures(**DISCOUNTS)))


def below_margin(products: DataFrame, threshold: float) -> DataFrame:
    """Products whose average margin, as shown, is below the threshold."""
    low = products.filter(F.col("avg_margin_pct") < threshold)
    return low.orderBy("avg_margin_pct", "product_name", "product_category")


def low_margin_alerts(sales: DataFrame, threshold: float = 20) -> DataFrame:
    """Products to look at, lowest margin first."""
    products = sales.groupBy("product_name", "product_category").agg(*measures(**ALERTS))
    return below_margin(products, threshold)
