from datetime import date
from decimal import Decimal

import pytest
from frames import frame, money, twenty_orders
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswright.functions import day_name, normalize, period_label, week_start
from saleswright.operators import clean, keep_first, with_rfm
from saleswright.schema import MARGIN
from saleswright.sources.star import STAR_KEYS


@pytest.fixture(scope="module")
def enriched(spark):
    return with_rfm(clean(twenty_orders(spark)))


def test_date_columns(enriched):
    assert {"order_year", "order_month", "order_quarter", "order_week", "order_dow"} <= set(enriched.columns)


def test_sales_positive(enriched):
    assert enriched.filter("NOT sales > 0").count() == 0


def test_order_id_unique(enriched):
    assert enriched.count() == enriched.select("order_id").distinct().count() == 20


def test_derived_columns(enriched):
    assert {MARGIN, "revenue_per_unit", "is_discounted", "is_profitable"} <= set(enriched.columns)


def test_discount_in_range(enriched):
    assert enriched.filter("discount NOT BETWEEN 0 AND 1").count() == 0


def test_rfm_columns(enriched):
    assert {"recency_days", "frequency", "monetary"} <= set(enriched.columns)
    assert len(enriched.columns) == 27


def test_first_row_of_a_key_wins(spark):
    rows = clean(frame(spark, {"order_id": "A", "sales": money(10)}, {"order_id": "A", "sales": money(20)})).collect()
    assert [r.sales for r in rows] == [money(10)]


def test_invalid_first_row_takes_its_key_along(spark):
    df = frame(spark, {"order_id": "B", "sales": money(-5)}, {"order_id": "B", "sales": money(20)})
    assert clean(df).count() == 0


def test_null_keys_are_one_key(spark):
    rows = clean(frame(spark, {"order_id": None, "sales": money(3)}, {"order_id": None, "sales": money(4)})).collect()
    assert [(r.order_id, r.sales) for r in rows] == [(None, money(3))]


def test_invalid_rows_go(spark):
    bad = [{"sales": None}, {"sales": money(0)}, {"sales": money(-1)}, {"quantity": 0}, {"quantity": None}]
    assert clean(frame(spark, *bad)).count() == 0


def test_discount_fill_and_clip(spark):
    df = clean(frame(spark, {"discount": Decimal("-0.10")}, {"discount": Decimal("1.50")}, {"discount": None}, {"discount": Decimal("150"), "quantity": 1}, {"discount": Decimal("0.125")}))
    got = {r.order_id: (r.discount, r.is_discounted) for r in df.collect()}
    assert got == {"ORD-0": (0, 0), "ORD-1": (1, 1), "ORD-2": (0, 0), "ORD-3": (1, 1), "ORD-4": (Decimal("0.125"), 1)}


def test_missing_profit_is_zero(spark):
    row = clean(frame(spark, {"profit": None})).first()
    assert (row.profit, row.is_profitable, row[MARGIN]) == (0, 0, 0)


def test_ratios_round_half_away_from_zero(spark):
    row = clean(frame(spark, {"sales": money(800), "profit": money("-1.00"), "quantity": 3})).first()
    assert row[MARGIN] == Decimal("-0.13")  # -0.125
    assert row.revenue_per_unit == Decimal("266.67")


@pytest.mark.parametrize(
    "day, week, monday, name",
    [
        (date(2024, 12, 30), 1, date(2024, 12, 30), "Monday"),
        (date(2023, 1, 1), 52, date(2022, 12, 26), "Sunday"),
        (date(2021, 1, 3), 53, date(2020, 12, 28), "Sunday"),
    ],
)
def test_calendar_at_year_edges(spark, day, week, monday, name):
    row = clean(frame(spark, {"order_date": day})).select("*", week_start(F.col("order_date")).alias("monday")).first()
    assert (row.order_week, row.monday, row.order_dow, row.order_year) == (week, monday, name, day.year)


def test_day_names(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-07')) AS d")
    got = [r.n for r in days.orderBy("d").select(day_name(F.col("d")).alias("n")).collect()]
    assert got == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_period_label_pads_the_month(spark):
    assert spark.range(1).select(period_label(F.lit(2024), F.lit(3))).first()[0] == "2024-03"


def test_labels_that_exist_are_normalised(spark):
    df = frame(spark, {"sales_rep": " anitha r\t", "segment": "o'neil home-office", "region": "ABC1def"})
    row = clean(df.drop("product_category")).first()
    assert (row.sales_rep, row.segment, row.region) == ("Anitha R", "O'Neil Home-Office", "Abc1Def")
    assert "product_category" not in row


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("abXYZ éÉßñ中文'-_1.2\t\n ǆﬁ"), max_size=12), min_size=50, max_size=50))
def test_normalize_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize(F.col("t")).alias("n"))
    assert [(r.t, r.n) for r in df.collect()] == [(t, t.strip().title()) for t in texts]


def test_normalize_single_words_and_their_neighbours(spark):
    texts = ["AUTOMOBILE", "supplier#00042", "supplier#0a1b", "abc\n", "x", "", "MIDDLE EAST", "o'neil", "Économie", "-abc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize(F.col("t")).alias("n"))
    assert [(r.t, r.n) for r in df.collect()] == [(t, t.strip().title()) for t in texts]


def test_normalize_keeps_null(spark):
    assert spark.sql("SELECT CAST(NULL AS STRING) AS t").select(normalize(F.col("t"))).first()[0] is None


def test_keep_first_without_sequence_is_stable(spark):
    df = frame(spark, {"order_id": "A", "sales": money(9)}, {"order_id": "A", "sales": money(7)}).drop("ingest_seq")
    assert keep_first(df, ["order_id"]).first().sales == money(7)


def test_hot_key_is_cut_down_before_the_shuffle(spark, plan):
    text = plan(clean(twenty_orders(spark)))
    assert text.count("WindowGroupLimit") == 2
    below = text[text.index("Exchange hashpartitioning(order_id") :]
    assert "WindowGroupLimit" in below


def test_star_join_leaves_rows_partitioned_for_the_duplicate_check(raw, plan, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(clean(raw, STAR_KEYS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_join = text[: text.index("SortMergeJoin")]
    assert "Window" in above_join and "Exchange" not in above_join
    assert "Broadcast" not in text and "Cartesian" not in text


def test_cleaning_stays_in_generated_code(raw, plan):
    text = plan(clean(raw, STAR_KEYS))
    assert "Python" not in text and "lambda" not in text


def test_star_row_counts(raw, sales):
    assert (raw.count(), sales.count()) == (6000, 4599)
