import json
import math

import pytest
from frames import frame, money

from saleswright.operators import clean
from saleswright.plans import kpi, marts


@pytest.fixture(scope="module")
def mixed(spark):
    return clean(
        frame(
            spark,
            {"region": "South", "segment": "Consumer", "sales": money(150000), "product_category": "Food"},
            {"region": "North", "segment": "Consumer", "sales": money(50000), "product_category": "Toys"},
            {"region": "South", "segment": "Corporate", "sales": money(100000), "product_category": "Food"},
        )
    )


def test_pivot_fills_gaps_with_zero(mixed):
    got = [r.asDict() for r in marts.region_segment_pivot(mixed).collect()]
    assert got == [
        {"region": "North", "Consumer": 50000, "Corporate": 0},
        {"region": "South", "Consumer": 150000, "Corporate": 100000},
    ]
    assert marts.region_segment_pivot(mixed, ["Corporate"]).columns == ["region", "Corporate"]


def test_pivot_with_names_runs_nothing_until_read(spark, sales):
    spark.sparkContext.setJobGroup("pivot", "defining a pivot")
    try:
        df = marts.region_segment_pivot(sales, ["Building"])
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("pivot") == []
        assert df.columns == ["region", "Building"] and df.count() == 5
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_category_shares_are_of_the_top_products_only(mixed):
    assert {r.product_category: float(r.share_pct) for r in marts.category_breakdown(mixed).collect()} == {
        "Food": 83.3,
        "Toys": 16.7,
    }
    assert [r.share_pct for r in marts.category_breakdown(mixed, products=1).collect()] == [100]


def test_trend_in_lakhs(mixed):
    row = marts.trend_period(mixed).first()
    assert (row.period, row.revenue_lakh) == ("2024-01", 3)


def test_report_tables(spark, mixed, tmp_path):
    names = marts.write_marts(marts.report_marts(mixed), str(tmp_path))
    assert len(names) == 6 and "forecast" not in names
    again = marts.write_marts(marts.report_marts(mixed, forecast=spark.range(8)), str(tmp_path))
    assert len(again) == 7
    assert spark.read.parquet(f"{tmp_path}/overall_kpis").collect() == kpi.overall_kpis(mixed).collect()
    assert spark.read.parquet(f"{tmp_path}/forecast").count() == 8


def test_records(spark):
    df = spark.sql(
        "SELECT DATE'2024-03-01' AS day, CAST('NaN' AS DOUBLE) AS nan, CAST(NULL AS INT) AS none,"
        " CAST(1.50 AS DECIMAL(9,2)) AS `profit_margin_%`, 'x' AS label"
    )
    shown = marts.records(df)
    assert shown.columns == df.columns and shown.count() == 1
    assert json.loads(shown.records.first().record) == {
        "day": "2024-03-01",
        "nan": None,
        "none": None,
        "profit_margin_%": 1.5,
        "label": "x",
    }
    assert math.isnan(df.first()["nan"])
