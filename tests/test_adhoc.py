from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import SF_SMALL
from pyspark.errors import AnalysisException

from saleswright.plans.adhoc import AdHoc


@pytest.fixture(scope="module")
def desk(spark, sales):
    desk = AdHoc(spark)
    desk.register(sales)
    return desk


def test_select(desk):
    assert desk.select("  select count(*) AS n from sales ").first().n == 4599
    df = desk.select("SELECT max(`profit_margin_%`) AS m FROM sales")
    assert df.columns == ["m"] and df.first().m == 70
    assert desk.select("SELECT sum(total_orders) AS n FROM category_kpi").first().n == 4599


def test_sales_can_be_replaced(spark, sales, desk):
    other = AdHoc(spark)
    other.register(sales)
    other.register(sales.limit(3))
    assert other.select("SELECT count(*) AS n FROM sales").first().n == 3
    assert desk.select("SELECT count(*) AS n FROM sales").first().n == 4599


def test_higher_order_transform_is_fine(desk):
    assert desk.select("SELECT transform(array(1, 2), x -> x + 1) AS a").first().a == [2, 3]


def test_words_in_text_are_fine(desk):
    assert desk.select("SELECT count(*) AS n FROM sales WHERE product_name = 'reflect'").first().n == 0


@pytest.mark.parametrize(
    "sql",
    [
        "",
        "WITH t AS (SELECT 1) SELECT * FROM t",
        "DROP VIEW sales",
        "INSERT INTO sales SELECT * FROM sales",
        "/* hello */ SELECT 1",
        "SELECT TRANSFORM(region) USING 'cat' AS (r STRING) FROM sales",
        "SELECT * FROM sales WHERE region IN (SELECT TRANSFORM(region) USING 'cat' AS (r STRING) FROM sales)",
    ],
)
def test_refused(desk, sql):
    with pytest.raises(PermissionError):
        desk.select(sql)


ARGUMENTS = "('java.lang.System', 'getProperty', 'user.home')"


@pytest.mark.parametrize(
    "call",
    [
        "reflect",
        "`java_method`",
        "TRY_REFLECT",
        "system.builtin.reflect",
        "IDENTIFIER('java_' || 'method')",
        "IDENTIFIER(concat('ref', 'lect'))",
    ],
)
@pytest.mark.parametrize("place", ["SELECT {}", "SELECT * FROM sales WHERE region IN (SELECT {})"])
def test_jvm_calls_do_not_resolve(spark, desk, call, place):
    with pytest.raises(AnalysisException):
        desk.select(place.format(call + ARGUMENTS))
    assert spark.sql(f"SELECT reflect{ARGUMENTS}").first()[0]


def test_requests_side_by_side(spark, desk):
    before = spark.conf.get("spark.sql.runSQLOnFiles")

    def ask(i):
        if i % 2:
            return desk.select(f"SELECT count(*) + {i} AS n FROM sales").first().n - i
        with pytest.raises(AnalysisException):
            desk.select(f"SELECT * FROM parquet.`{SF_SMALL}/region.parquet`")
        return 4599

    with ThreadPoolExecutor(4) as pool:
        assert set(pool.map(ask, range(12))) == {4599}
    assert spark.conf.get("spark.sql.runSQLOnFiles") == before
    assert spark.sql(f"SELECT * FROM parquet.`{SF_SMALL}/region.parquet`").count() == 5


@pytest.mark.parametrize("body", [None, {}, {"query": "SELECT 1"}])
def test_request_without_sql(desk, body):
    with pytest.raises(ValueError):
        desk.request(body)


def test_request(desk):
    assert desk.request({"sql": "SELECT 1 AS one"}).first().one == 1


def test_engine_errors_are_shown(desk):
    with pytest.raises(AnalysisException):
        desk.select("SELECT nothing FROM sales")
