"""The three stored KPI views: keys and named measures over the sales table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import measure_sql, measures
from ..schema import PUBLISHED_MARGIN
from ..sources.tables import publish


@dataclass(frozen=True)
class View:
    """What a view groups by and shows; ``top`` names the column it is sorted by, largest first."""

    keys: tuple[str, ...]
    shown: dict[str, str]
    top: str | None = None

    def sql(self, table: str) -> str:
        """The view as a statement over a table under its published column names."""
        columns = [*self.keys, *(f"{measure_sql(m, PUBLISHED_MARGIN)} AS {name}" for name, m in self.shown.items())]
        statement = f"SELECT {', '.join(columns)} FROM {table} GROUP BY {', '.join(self.keys)}"
        return f"{statement} ORDER BY {self.top} DESC, {', '.join(self.keys)}" if self.top else statement

    def over(self, sales: DataFrame) -> DataFrame:
        """The same over a DataFrame."""
        return self.sorted(sales.groupBy(*self.keys).agg(*measures(**self.shown)))

    def sorted(self, rows: DataFrame) -> DataFrame:
        """Figures in the view's order."""
        return rows.orderBy(F.desc(self.top), *self.keys) if self.top else rows


_SUMS = {"total_revenue": "revenue", "total_profit": "profit", "avg_margin_pct": "margin"}

VIEWS = {
    "monthly_kpi": View(
        ("order_year", "order_month"), {"total_orders": "orders", **_SUMS, "unique_customers": "customers"}
    ),
    "category_kpi": View(
        ("product_category",), {"total_orders": "orders", "units_sold": "units", **_SUMS}, "total_revenue"
    ),
    "rep_performance": View(
        ("sales_rep",), {"orders_closed": "orders", "customers_served": "customers", **_SUMS}, "total_revenue"
    ),
}

monthly_kpi, category_kpi, rep_performance = (view.over for view in VIEWS.values())


def create_views(spark: SparkSession, table: str = "sales", temporary: bool = True) -> list[str]:
    """(Re)create the views over a named table or view; bound by name, not data."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    for name, view in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS {view.sql(table)}")
    return list(VIEWS)


def register_sales(sales: DataFrame, name: str = "sales") -> list[str]:
    """Make sales and its views visible to SQL in this session."""
    publish(sales).createOrReplaceTempView(name)
    return create_views(sales.sparkSession, name)
