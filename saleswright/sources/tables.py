"""The stored ``sales`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schema import MARGIN, PUBLISHED_MARGIN
from .versions import current_folder, new_version

YEAR = "order_year"


def publish(sales: DataFrame) -> DataFrame:
    """Sales under the column names that tables, files and SQL show."""
    return sales.withColumnRenamed(MARGIN, PUBLISHED_MARGIN)


def by_year(sales: DataFrame) -> DataFrame:
    """Published sales with a year's rows in few tasks, each of a fair size.

    Rows arrive by order, so each task would leave a file per year; at 200,000
    tasks, over a million files. Rebalancing splits what is too large for one.
    """
    return publish(sales).hint("rebalance", YEAR)


def write_sales(sales: DataFrame, path: str, gather: bool = True) -> None:
    """Replace the stored table; readers stay on the old version until the new one is whole.

    A folder per year lets a year filter skip the others; with one folder per
    month, each write task would leave twelve times as many small files. Without
    ``gather`` rows stay in their tasks, each of which leaves a file per year:
    for rows that a shuffle has just brought to tasks of a fair size, where one
    more would move every wide row again.
    """
    with new_version(sales.sparkSession, path) as version:
        (by_year(sales) if gather else publish(sales)).write.partitionBy(YEAR).parquet(version.folder)


def save_sales_table(sales: DataFrame, name: str = "sales") -> None:
    """Replace the catalog table, laid out like the stored one."""
    by_year(sales).write.mode("overwrite").format("parquet").partitionBy(YEAR).saveAsTable(name)


def read_sales(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest version of the stored table; a known schema saves looking it up in the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current_folder(spark, path)).withColumnRenamed(PUBLISHED_MARGIN, MARGIN)
