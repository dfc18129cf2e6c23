"""The data model: one flat sales fact."""

from __future__ import annotations

from pyspark.sql import types as T

# Amounts and quantities keep ten decimals from the scan on; rules and filters
# see them unrounded, and only measures round, when they are shown.
MONEY = T.DecimalType(28, 10)
QUANTITY = T.DecimalType(28, 10)
# Wide enough in the raw data for values that cleaning then clips to [0, 1].
RAW_FRACTION = T.DecimalType(18, 6)
FRACTION = T.DecimalType(7, 6)

# The columns of the published schema, and those it requires.
RAW = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("sales_rep", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("quantity", QUANTITY),
        T.StructField("unit_price", MONEY),
        T.StructField("discount", RAW_FRACTION),
        T.StructField("sales", MONEY),
        T.StructField("cost", MONEY),
        T.StructField("profit", MONEY),
    ]
)

REQUIRED = (
    "order_id",
    "order_date",
    "customer_id",
    "product_name",
    "quantity",
    "unit_price",
    "discount",
    "sales",
    "profit",
)

# Text columns cleaning normalises, each only where present.
LABELS = ("region", "segment", "product_category", "sales_rep")

# Position of a row in its input; decides which of several equal keys came first.
SEQUENCE = "ingest_seq"

# The margin column is ``profit_margin_pct`` in plans; tables, CSV and SQL show
# it under its published name, which needs backticks in Spark SQL.
MARGIN = "profit_margin_pct"
PUBLISHED_MARGIN = "profit_margin_%"
