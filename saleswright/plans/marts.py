"""Report tables derived from the KPI queries, and records for clients."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import average, in_lakhs, percent, period_label
from ..session import ensure_checkpoint_dir
from ..sources.versions import swapped
from . import kpi

REPORT_PRODUCTS = 20


def trend_period(sales: DataFrame) -> DataFrame:
    """Monthly trend with a period label and revenue in lakhs."""
    trend = kpi.revenue_trend_monthly(sales)
    return trend.select(
        period_label(F.col("order_year"), F.col("order_month")).alias("period"),
        "revenue",
        in_lakhs(F.col("revenue")).alias("revenue_lakh"),
        "avg_margin_pct",
    )


def rep_in_lakhs(sales: DataFrame) -> DataFrame:
    """Revenue and profit per sales rep in lakhs."""
    return kpi.sales_rep_leaderboard(sales).select(
        "sales_rep",
        in_lakhs(F.col("total_revenue")).alias("revenue_lakh"),
        in_lakhs(F.col("total_profit")).alias("profit_lakh"),
    )


def category_breakdown(sales: DataFrame, products: int = REPORT_PRODUCTS) -> DataFrame:
    """Revenue, profit and revenue share per category of the top products.

    The input of the unpartitioned window is at most ``products`` rows.
    """
    everything = Window.partitionBy()
    return (
        kpi.top_products(sales, products)
        .groupBy("product_category")
        .agg(F.sum("total_revenue").alias("total_revenue"), F.sum("total_profit").alias("total_profit"))
        .withColumn("share_pct", percent(F.col("total_revenue"), F.sum("total_revenue").over(everything), 1))
        .orderBy("product_category")
    )


def category_margin_rank(sales: DataFrame, products: int = REPORT_PRODUCTS) -> DataFrame:
    """Mean of the top products' shown margins per category, best first."""
    return (
        kpi.top_products(sales, products)
        .groupBy("product_category")
        .agg(average(F.col("avg_margin_pct"), digits=6).alias("avg_margin_pct"))
        .orderBy(F.desc("avg_margin_pct"), "product_category")
    )


def region_segment_pivot(sales: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """Revenue by region (rows) and segment (columns), 0 where there is none.

    The pivot runs over the aggregated matrix. With ``segments`` nothing runs
    before the result is read, and only those are shown. Without, the matrix, a few rows, is computed at
    once and kept, since its segments make up the schema.
    """
    cells = sales.groupBy("region", "segment").agg(F.sum("sales").alias("revenue"))
    if segments is None:
        ensure_checkpoint_dir(sales.sparkSession)
        cells = cells.checkpoint()
    table = cells.groupBy("region").pivot("segment", segments).agg(F.sum("revenue"))
    return table.na.fill(0).orderBy("region")


def report_marts(sales: DataFrame, forecast: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of the business report; the forecast only if there is one."""
    marts = {
        "overall_kpis": kpi.overall_kpis(sales),
        "monthly_trend": kpi.revenue_trend_monthly(sales),
        "top_products": kpi.top_products(sales, REPORT_PRODUCTS),
        "region_analysis": kpi.region_segment_matrix(sales),
        "sales_rep_kpis": kpi.sales_rep_leaderboard(sales),
        "discount_analysis": kpi.discount_impact(sales),
    }
    if forecast is not None:
        marts["forecast"] = forecast
    return marts


def write_marts(marts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """One folder per table under ``path``; the report is replaced as a whole."""
    spark = next(iter(marts.values())).sparkSession
    with swapped(spark, path) as folder:
        for name, table in marts.items():
            table.write.format(fmt).option("header", True).save(f"{folder}/{name}")
    return list(marts)


def json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object: nulls shown, NaN as null, dates in ISO form."""

    def shown(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c).alias(field.name)
        return c

    row = F.struct(*[shown(f) for f in df.schema.fields])
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("record"))


@dataclass(frozen=True)
class Records:
    """A result for a client: columns known at once, rows when asked for."""

    columns: list[str]
    records: DataFrame

    def count(self) -> int:
        return self.records.count()


def records(df: DataFrame) -> Records:
    return Records(df.columns, json_records(df))
