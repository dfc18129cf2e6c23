from datetime import date, timedelta

import pytest
from frames import frame, money
from pyspark.sql import functions as F

from saleswright.operators import clean
from saleswright.plans import features

MONDAY = date(2024, 1, 1)


def weeks(spark, amounts, **change):
    return frame(
        spark,
        *[
            {"order_date": MONDAY + timedelta(weeks=i), "sales": money(a), **change}
            for i, a in enumerate(amounts)
            if a is not None
        ],
    )


def test_weekly_figures(spark):
    df = clean(
        frame(
            spark,
            {"order_date": MONDAY, "sales": money(10), "customer_id": "A"},
            {"order_date": MONDAY + timedelta(days=6), "sales": money(20), "customer_id": "A"},
            {"order_date": MONDAY + timedelta(days=7), "sales": money(5), "customer_id": "B"},
            {"order_date": None},
        )
    )
    rows = [(r.week, r.revenue, r.orders, r.avg_order_value, r.unique_customers) for r in features.weekly(df).orderBy("week").collect()]
    assert rows == [(MONDAY, 30, 2, 15, 1), (MONDAY + timedelta(days=7), 5, 1, 5, 1)]


def test_moving_figures_need_the_whole_window(spark):
    amounts = [1, 2, 4, 8, 16, 32, 64, 128, 256, 512]
    rows = features.build_features(clean(weeks(spark, amounts))).orderBy("week").collect()
    assert [r.revenue for r in rows] == [256, 512]  # the first eight lack a window of eight
    assert [float(r.revenue_ma8) for r in rows] == [31.875, 63.75]
    assert [float(r.revenue_ma4) for r in rows] == [60, 120]
    assert [float(r.revenue_std4) for r in rows] == [49.531135, 99.06227]
    assert [(r.revenue_lag1, r.revenue_lag4) for r in rows] == [(128, 16), (256, 32)]


def test_lags_go_by_observed_week(spark):
    amounts = [1, 2, 4, None, None, 8, 16, 32, 64, 128, 256]
    row = features.build_features(clean(weeks(spark, amounts))).first()
    assert (row.revenue, row.revenue_lag1, row.revenue_lag4) == (256, 128, 16)


def test_series_do_not_mix(spark):
    df = weeks(spark, range(1, 12), region="North").union(weeks(spark, range(101, 112), region="South"))
    panel = features.build_features(clean(df.withColumn("order_id", F.concat("region", "order_id"))), ["region"])
    got = {(r.region, float(r.revenue_ma8)) for r in panel.collect()}
    assert got == {("North", x) for x in (4.5, 5.5, 6.5)} | {("South", x) for x in (104.5, 105.5, 106.5)}


@pytest.mark.parametrize("n, train", [(1, 0), (5, 4), (9, 7), (10, 8), (337, 269)])
def test_split(spark, n, train):
    panel = spark.range(n).select(F.col("id").alias("week"))
    rows = features.split_by_time(panel).orderBy("week").collect()
    assert [r.is_train for r in rows] == [1] * train + [0] * (n - train)


def test_calendar(spark):
    row = spark.range(1).select(*[c.alias(n) for n, c in features.calendar(F.lit(date(2024, 12, 30))).items()]).first()
    assert row.asDict() == {"week_of_year": 1, "month": 12, "quarter": 4, "is_q4": 1}


def test_feature_count():
    assert len(features.FEATURES) == 20
