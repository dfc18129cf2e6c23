"""Raw sales from a star schema of orders, line items and their dimensions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_unique
from ..operators.dedupe import keep_first
from ..schema import MONEY, QUANTITY, RAW, RAW_FRACTION, SEQUENCE

# Determines, with the line number, the order id; the join on it leaves the
# rows partitioned for the duplicate check.
ORDER_KEY = "order_key"
STAR_KEYS = (ORDER_KEY, "order_id")

# Columns read from each table. Naming the types spares a job per table that
# would only look them up in the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": """l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz, l_partkey bigint,
                   l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double,
                   l_tax double, l_returnflag string, l_linestatus string""",
}
# Tell apart line items with the same order and line number.
TIE_BREAK = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)
# Of these, the columns nothing but the duplicate check needs.
NOT_CARRIED = ("l_shipdate", "l_tax", "l_returnflag", "l_linestatus")


def star_files(folder: str) -> list[str]:
    """Where the tables of the star schema lie."""
    return [f"{folder.rstrip('/')}/{name}.parquet" for name in TABLES]


def star_sales(
    spark: SparkSession, folder: str, amounts: Decimal = Decimal(1), quantities: Decimal = Decimal(1), first_only: bool = False
) -> DataFrame:
    """The raw sales columns plus ``order_key`` and the input position.

    No side is marked for broadcast: Spark broadcasts the dimensions while
    their size allows and shuffles them otherwise. Orders meet customers
    before they meet line items. With ``first_only``, line items with a key
    seen before go first of all, and the columns that tell them apart with
    them; this takes for granted that every foreign key has its row, since a
    first line item without an order would otherwise not hide a second one.
    The duplicate check and the join to orders share one shuffle by order, and
    nothing is sorted before it.
    ``amounts`` and ``quantities`` scale those columns.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")

    places = table("nation").join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    items = table("lineitem")
    if first_only:
        # Moved once, by order: duplicates meet there, and then their order.
        items = keep_first(items.repartition("l_orderkey"), ("l_orderkey", "l_linenumber"), TIE_BREAK).drop(*NOT_CARRIED)
        lines = (
            items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        )
    else:
        lines = (
            items.join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        )

    discount = F.col("l_discount").cast("decimal(4,2)")
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - discount)
    cost_ratio = ((F.col("p_partkey") % 76 + 30).cast("decimal(3,0)") * F.lit(Decimal("0.01"))).cast("decimal(4,2)")
    price = F.round(F.try_divide("l_extendedprice", "l_quantity").cast("decimal(18,6)"), 2)
    sales = (F.round(net, 2).cast("decimal(18,2)") * F.lit(amounts)).cast(MONEY)
    cost = (F.round(net * cost_ratio, 2).cast("decimal(18,2)") * F.lit(amounts)).cast(MONEY)
    columns = {
        "order_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "order_date": F.col("o_orderdate").cast("date"),
        "customer_id": F.col("c_custkey").cast("string"),
        "customer_name": F.col("c_name"),
        "region": F.col("r_name"),
        "segment": F.col("c_mktsegment"),
        "sales_rep": F.col("s_name"),
        "product_name": F.concat_ws(" ", "p_name", "p_partkey"),
        "product_category": F.col("p_type"),
        "quantity": (F.col("l_quantity").cast("decimal(10,0)") * F.lit(quantities)).cast(QUANTITY),
        "unit_price": (price.cast("decimal(18,2)") * F.lit(amounts)).cast(MONEY),
        "discount": discount.cast(RAW_FRACTION),
        "sales": sales,
        "cost": cost,
        "profit": (sales - cost).cast(MONEY),
    }
    position = [] if first_only else [F.struct(*TIE_BREAK).alias(SEQUENCE)]
    return lines.select(
        *[columns[f.name].alias(f.name) for f in RAW.fields], F.col("l_orderkey").alias(ORDER_KEY), *position
    )


def clean_star_sales(spark: SparkSession, folder: str, **scales: Decimal) -> DataFrame:
    """Cleaned sales of the star schema; duplicates leave before anything is joined."""
    return clean_unique(star_sales(spark, folder, first_only=True, **scales).drop(ORDER_KEY))
