"""One execution behind count and pages, and requests that can be stopped."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from saleswright.plans import serving


def ids(df):
    return [json.loads(r.record)["id"] for r in df.collect()]


def test_count_and_pages_come_from_one_execution(spark, tmp_path):
    """The input is gone before the first page is read, and chance columns agree between pages."""
    source = str(tmp_path / "source")
    spark.range(0, 1000, 1, 7).withColumn("chance", F.rand()).repartition(5).write.parquet(source)
    df = spark.read.parquet(source).withColumn("again", F.rand()).orderBy(F.desc("id"))
    served = serving.serve(df)
    for file in (tmp_path / "source").glob("*.parquet"):
        file.write_bytes(b"")
    assert served.count == 1000 and served.columns == ["id", "chance", "again"]
    assert ids(served.page(0, 10)) == list(range(999, 989, -1))
    assert ids(served.page(395, 250)) == list(range(604, 354, -1))
    assert ids(served.page(990, 50)) == list(range(9, -1, -1))
    assert ids(served.page(1000, 5)) == [] and ids(served.page(3, 0)) == []
    assert served.page(7, 3).collect() == served.page(5, 5).collect()[2:]
    whole = [r.record for first in range(0, 1000, 130) for r in served.page(first, 130).collect()]
    assert len(set(whole)) == 1000
    with pytest.raises(ValueError):
        served.page(-1, 2)
    served.close()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        served.page(0, 1)


def test_a_page_reads_only_its_places(spark, plan):
    served = serving.serve(spark.range(0, 1000, 1, 7).orderBy("id"))
    assert "PushedFilters: [IsNotNull(_at), GreaterThanOrEqual(_at," in plan(served.page(10, 5))


def test_empty_result(spark):
    served = serving.serve(spark.range(0))
    assert served.count == 0 and ids(served.page(0, 10)) == []


def test_a_request_can_be_cancelled(spark):
    slow = spark.range(0, 64, 1, 8).select(F.expr("reflect('java.lang.Thread', 'sleep', 3000L)").alias("x"), "id")
    errors = []

    def run():
        try:
            serving.serve(slow, tag="request-7")
        except Exception as e:
            errors.append(str(e))

    request = threading.Thread(target=run)
    began = time.time()
    request.start()
    while request.is_alive() and time.time() - began < 60:
        time.sleep(1)
        serving.cancel(spark, "request-7")
    request.join()
    assert errors and time.time() - began < 20
    assert serving.serve(spark.range(3)).count == 3
