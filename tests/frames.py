"""Small sales frames for tests."""

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import types as T

from saleswright.schema import RAW, SEQUENCE

WITH_SEQUENCE = T.StructType([*RAW.fields, T.StructField(SEQUENCE, T.IntegerType())])

BASE = {
    "order_id": "ORD-0",
    "order_date": date(2024, 1, 1),
    "customer_id": "C000",
    "customer_name": "Mira Holt",
    "region": "Harbour",
    "segment": "Corporate",
    "sales_rep": "Jonas Weir",
    "product_name": "Standing desk",
    "product_category": "Furniture",
    "quantity": 2,
    "unit_price": Decimal("50.00"),
    "discount": Decimal("0.05"),
    "sales": Decimal("95.00"),
    "cost": Decimal("60.00"),
    "profit": Decimal("35.00"),
}


def _fitting(value, kind):
    return Decimal(value) if isinstance(kind, T.DecimalType) and isinstance(value, int) else value


def frame(spark, *changes):
    """One row per dict of changes to the base row, numbered in input order."""
    rows = [{"order_id": f"ORD-{i}", **change} for i, change in enumerate(changes)]
    data = [
        tuple(_fitting({**BASE, **row, SEQUENCE: i}[f.name], f.dataType) for f in WITH_SEQUENCE.fields)
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, WITH_SEQUENCE)


def twenty_orders(spark):
    """Twenty clean orders, one a day, of ten customers."""
    return frame(
        spark,
        *[
            {
                "order_date": date(2024, 1, 1) + timedelta(days=i),
                "customer_id": f"C{i % 10:03d}",
                "region": ("Harbour", "Hills")[i % 3 % 2],
                "segment": ("Corporate", "Consumer")[i % 2],
                "quantity": 1 + i % 4,
                "discount": Decimal("0.05") * (i % 3),
                "sales": Decimal(40000 + 7919 * i % 160000),
                "profit": Decimal(5000 + 3571 * i % 45000),
            }
            for i in range(20)
        ],
    )


def money(amount):
    return Decimal(str(amount)).quantize(Decimal("0.01"))
