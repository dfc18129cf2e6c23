"""A third of all rows under one key, at every place where rows meet by key."""

import shutil

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from saleswright.operators import clean, issues, with_rfm
from saleswright.plans import features, kpi
from saleswright.sources import star_sales
from saleswright.sources.star import STAR_KEYS

SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


@pytest.fixture(scope="module")
def hot_folder(spark, tmp_path_factory):
    """The small tables with every third line item under one order, part and supplier."""
    folder = tmp_path_factory.mktemp("hot")
    for name in ("region", "nation", "customer", "supplier", "part", "orders"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", folder)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey") % 3 == 0
    keys = {"l_orderkey": 7, "l_partkey": 7, "l_suppkey": 7}
    lines = lines.withColumns({"_hot": hot}).withColumns(
        {k: F.when(F.col("_hot"), v).otherwise(F.col(k)).cast("bigint") for k, v in keys.items()}
    )
    lines.drop("_hot").repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.fixture
def split_early(spark):
    for key, value in SPLIT_EARLY.items():
        spark.conf.set(key, value)
    yield
    for key in SPLIT_EARLY:
        spark.conf.unset(key)


def rows(df):
    return sorted(map(repr, df.collect()))


def results(spark, folder):
    raw = star_sales(spark, folder)
    sales = clean(raw, STAR_KEYS)
    return {
        "clean": rows(sales),
        "issues": rows(issues(raw)),
        "rfm": rows(with_rfm(sales)),
        "kpis": rows(kpi.overall_kpis(sales)),
        "top": rows(kpi.top_products(sales, 500)),
        "weekly": rows(features.weekly(sales)),
    }


def test_results_do_not_change_when_joins_are_split(spark, hot_folder, split_early):
    split = results(spark, hot_folder)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "10m")
    assert results(spark, hot_folder) == split


def test_a_hot_order_is_split_although_the_duplicate_check_follows(spark, hot_folder, split_early, plan):
    df = clean(star_sales(spark, hot_folder), STAR_KEYS)
    df.collect()
    final = plan(df)
    assert "SortMergeJoin(skew=true) [l_orderkey" in final[: final.index("Initial Plan")]
