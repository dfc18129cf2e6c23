from datetime import date
from decimal import Decimal

import pytest
from frames import frame, money

from saleswright.operators import clean
from saleswright.plans import kpi, views
from saleswright.schema import MARGIN


@pytest.fixture(scope="module")
def three(spark):
    return clean(
        frame(
            spark,
            {"sales": money(100), "profit": money(10), "discount": Decimal("0.00"), "product_name": "Desk"},
            {"sales": money(300), "profit": money(90), "customer_id": "C1", "product_name": "Lamp"},
            {"sales": money(200), "profit": money(50), "product_name": "Lamp", "order_date": date(2023, 12, 31)},
        )
    )


def test_overall(three):
    row = kpi.overall_kpis(three).first()
    assert row.asDict() == {
        "total_orders": 3,
        "unique_customers": 2,
        "total_revenue": 600,
        "total_profit": 150,
        "avg_margin_pct": Decimal("21.67"),  # mean of 10, 30, 25: not 150 / 600
        "avg_order_value": 200,
        "discounted_revenue_pct": Decimal("83.33"),
    }


def test_no_sales_gives_nulls_not_errors(three):
    row = kpi.overall_kpis(three.filter("sales < 0")).first()
    assert (row.total_orders, row.total_revenue, row.avg_order_value, row.discounted_revenue_pct) == (0, None, None, None)


@pytest.mark.parametrize("year, months", [(None, 2), (0, 2), (2023, 1), (1999, 0)])
def test_trend_of_a_year(three, year, months):
    assert kpi.revenue_trend_monthly(three, year).count() == months


def test_top_products(three):
    rows = kpi.top_products(three).collect()
    assert [(r.product_name, r.order_count, r.units_sold, r.avg_discount_pct) for r in rows] == [
        ("Lamp", 2, 4, 5),
        ("Desk", 1, 2, 0),
    ]
    assert kpi.top_products(three, 1).count() == 1


@pytest.mark.parametrize("asked, given", [(None, 10), (-3, 1), (0, 1), (7, 7), (999, 50)])
def test_limit_is_clamped(asked, given):
    assert kpi.clamp_limit(asked) == given


def test_discount_labels(three):
    assert {r.pricing_type: r.order_count for r in kpi.discount_impact(three).collect()} == {
        "Discounted": 2,
        "Full Price": 1,
    }


def test_alert_compares_the_rounded_margin(spark):
    margins = [Decimal("19.99")] * 2 + [Decimal("20.00")] * 3  # mean 19.996
    df = clean(frame(spark, *[{"sales": money(100), "profit": m} for m in margins]))
    assert df.agg({MARGIN: "avg"}).first()[0] == Decimal("19.996")
    assert kpi.low_margin_alerts(df).count() == 0
    assert kpi.low_margin_alerts(df, threshold=21).count() == 1


def test_alerts_worst_first(three):
    rows = kpi.low_margin_alerts(three, threshold=100).collect()
    assert [r.product_name for r in rows] == ["Desk", "Lamp"]


def test_views_follow_the_table_they_name(spark, three):
    assert views.register_sales(three) == ["monthly_kpi", "category_kpi", "rep_performance"]
    assert spark.table("monthly_kpi").collect() == views.monthly_kpi(three).collect()
    assert spark.table("category_kpi").first().units_sold == 6
    views.publish(three.filter("product_name = 'Desk'")).createOrReplaceTempView("sales")
    assert spark.table("rep_performance").first().orders_closed == 1


PLAIN = [
    kpi.overall_kpis,
    kpi.revenue_trend_monthly,
    kpi.top_products,
    kpi.region_segment_matrix,
    kpi.sales_rep_leaderboard,
    kpi.discount_impact,
    kpi.low_margin_alerts,
    views.monthly_kpi,
    views.category_kpi,
    views.rep_performance,
]


@pytest.mark.parametrize("query", PLAIN, ids=lambda q: q.__name__)
def test_no_row_is_copied_per_distinct_and_aggregation_starts_before_the_shuffle(sales, plan, query):
    text = plan(query(sales))
    assert "Expand" not in text
    assert "partial_" in text[text.rindex("Exchange") :]


def test_year_filter_skips_folders_and_columns(sales, plan):
    text = plan(kpi.revenue_trend_monthly(sales, 1997))
    scan = text[text.rindex("FileScan") :]
    assert "order_year#" in scan[scan.index("PartitionFilters") :] and "= 1997" in scan
    assert "product_name" not in scan


def test_top_products_needs_no_full_sort(sales, plan):
    assert "TakeOrderedAndProject(limit=10" in plan(kpi.top_products(sales))
