"""The rollup against the queries over sales, in batches and after failures."""

from datetime import date, timedelta

import pytest
from frames import frame, money
from pyspark.sql import functions as F

from saleswright.operators import clean
from saleswright.plans import kpi, rollup, views
from saleswright.plans.rollup import Rollup, numbered
from saleswright.sources import versions

TWINS = [
    (rollup.overall_kpis, kpi.overall_kpis),
    (rollup.revenue_trend_monthly, kpi.revenue_trend_monthly),
    (lambda r: rollup.revenue_trend_monthly(r, 2024), lambda s: kpi.revenue_trend_monthly(s, 2024)),
    (rollup.requested_products, kpi.requested_products),
    (rollup.region_segment_matrix, kpi.region_segment_matrix),
    (rollup.sales_rep_leaderboard, kpi.sales_rep_leaderboard),
    (rollup.discount_impact, kpi.discount_impact),
    (rollup.low_margin_alerts, kpi.low_margin_alerts),
    (rollup.monthly_kpi, views.monthly_kpi),
    (rollup.category_kpi, views.category_kpi),
    (rollup.rep_performance, views.rep_performance),
]


UNORDERED = (rollup.monthly_kpi, rollup.discount_impact)


def same(stored, sales, twins=TWINS):
    for ours, direct in twins:
        got, want = ours(stored), direct(sales)
        assert got.columns == want.columns
        got, want = got.collect(), want.collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert ours in UNORDERED or got == want


@pytest.fixture(scope="module")
def orders(spark):
    """Cleaned sales with missing keys and customers, in three batches."""
    rows = []
    for i in range(240):
        row = {
            "order_date": date(2023, 11, 1) + timedelta(days=i),
            "customer_id": None if i % 17 == 0 else f"C{i * i % 41}",
            "region": None if i % 13 == 0 else ("Hills", "Harbour")[i % 2],
            "segment": None if i % 19 == 0 else ("Home", "Corporate", "Other")[i % 3],
            "sales_rep": None if i % 23 == 0 else f"Rep {i % 7}",
            "product_name": f"Thing {i % 11}",
            "product_category": None if i % 11 == 0 else f"Kind {i % 4}",
            "quantity": 1 + i % 5,
            "sales": money(10 + i * 37 % 900),
            "profit": money(i * 53 % 300 - 40),
        }
        rows.append(row)
    return clean(frame(spark, *rows)).withColumn("_batch", F.dayofyear("order_date") % 3)


def test_batches_give_the_whole(spark, orders, tmp_path):
    stored = Rollup(spark, str(tmp_path))
    for batch in range(3):
        stored.add(orders.filter(F.col("_batch") == batch).drop("_batch"))
        same(stored, orders.filter(F.col("_batch") <= batch).drop("_batch"), TWINS[: 11 if batch == 2 else 2])
    numbers = [r.number for n in range(1, 4) for r in spark.read.parquet(f"{tmp_path}/customers/{n:09d}").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_empty_batches(spark, orders, tmp_path):
    stored, sales = Rollup(spark, str(tmp_path)), orders.drop("_batch")
    with pytest.raises(FileNotFoundError):
        rollup.overall_kpis(stored)
    stored.add(sales.limit(0))
    same(stored, sales.limit(0), TWINS[:2])
    stored.add(sales)
    stored.add(sales.limit(0))
    same(stored, sales, TWINS[:5])


def test_a_failed_batch_changes_nothing(spark, orders, tmp_path):
    stored, sales = Rollup(spark, str(tmp_path)), orders.drop("_batch")
    stored.add(sales.filter("order_year = 2023"))
    late = sales.filter("order_year = 2024")
    broken = late.withColumn("sales", F.when(F.col("order_month") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("sales")))
    with pytest.raises(Exception, match="lost"):
        stored.add(broken)
    same(stored, sales.filter("order_year = 2023"), TWINS[:2])
    stored.add(late)
    same(stored, sales, TWINS[:5])


def test_queries_read_the_rollup_alone(spark, sales, tmp_path):
    stored = Rollup(spark, str(tmp_path))
    stored.add(sales)
    for ours, _ in TWINS:
        assert all(str(tmp_path) in f for f in ours(stored).inputFiles())


def test_one_scan_gives_all_states(sales, plan):
    assert plan(rollup.states(sales)).count("FileScan") == 1


def test_numbers_have_no_gaps(spark):
    ids = spark.range(0, 10_000, 1, 13).select(F.col("id").cast("string").alias("customer_id")).filter("id % 7 > 2 AND id < 9000")
    found = [r.number for r in numbered(ids, 500).collect()]
    assert sorted(found) == list(range(500, 500 + len(found)))


def test_many_buckets_of_customers(spark, orders, tmp_path):
    """More customers than one bitmap holds, most of them twice."""
    base = orders.drop("_batch").limit(1)
    many = base.drop("customer_id", "order_id").crossJoin(
        spark.range(120_000).select((F.col("id") % 70_001).cast("string").alias("customer_id"), F.col("id").cast("string").alias("order_id"))
    )
    stored = Rollup(spark, str(tmp_path))
    stored.add(many.filter("cast(order_id AS long) % 2 = 0"))
    stored.add(many.filter("cast(order_id AS long) % 2 = 1"))
    assert rollup.overall_kpis(stored).first().unique_customers == 70_001
    assert rollup.sales_rep_leaderboard(stored).first().customers_served == 70_001


def test_versions(spark, tmp_path):
    """Readers stay on the old version until the new one is whole; old ones go."""
    path = str(tmp_path / "out")
    assert versions.current(spark, path) is None and versions.current_folder(spark, path) == path
    for n in range(1, 5):
        with versions.new_version(spark, path) as v:
            assert v.number == n
            spark.range(n).write.parquet(f"{v.folder}/x")
        assert spark.read.parquet(f"{versions.current_folder(spark, path)}/x").count() == n
    assert len(list((tmp_path / "out").glob("v-*"))) == versions.KEPT
    with pytest.raises(ZeroDivisionError), versions.new_version(spark, path) as v:
        spark.range(9).write.parquet(f"{v.folder}/x")
        1 / 0
    assert spark.read.parquet(f"{versions.current_folder(spark, path)}/x").count() == 4
    # A manifest that its writer has not finished counts for nothing.
    (tmp_path / "out/_versions/000000005").write_text("v-half")
    assert versions.current(spark, path).number == 4
    with pytest.raises(FileExistsError), versions.new_version(spark, path) as v:
        (tmp_path / f"out/_versions/{v.number:09d}").write_text("v-other\n")
    assert len(list((tmp_path / "out").glob("v-*"))) == versions.KEPT


def test_bitmaps_hold_no_more_than_their_customers(spark, orders):
    """Many reps with three customers each, whose numbers lie far apart."""
    base = orders.drop("_batch", "customer_id", "order_id", "sales_rep").limit(1)
    ids = spark.range(3_000).selectExpr(
        "cast(id AS string) AS order_id", "concat('Rep ', id % 1000) AS sales_rep", "cast(id * 7 AS string) AS customer_id"
    )
    numbers = spark.range(21_000).selectExpr("cast(id AS string) AS customer_id", "id * 1000 AS number")
    rows = rollup.bitmaps(base.crossJoin(ids), numbers).filter("facet = 'rep'")
    found = rows.selectExpr("count(*) AS n", "sum(bit_count(bits)) AS customers", "max(length(cast(struct(word, bits) AS string))) AS wide").first()
    assert (found.n, found.customers) == (3_000, 3_000) and found.wide < 64
