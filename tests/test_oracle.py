"""Every query with an oracle against DuckDB on the same tables."""

import os
import re

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF_SMALL}/{f}'")
    return con


def test_every_oracle_has_its_query():
    assert set(ORACLES) < set(QUERIES)
    learned = {"model_metrics", "model_info", "feature_importance", "forecast_8w", "forecast_lakhs", "forecast_summary"}
    assert {q for q in set(QUERIES) - set(ORACLES) if not re.match(r"op\d+_|pipeline$", q)} == learned


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, SF_SMALL)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(ours.columns) == sorted(columns)
    got = sorted(repr(tuple(r)) for r in ours.select(*columns).collect())
    assert got == sorted(repr(r) for r in result.fetchall())


def test_entry_runs(spark):
    row = contract.entry(spark).first()
    assert row.total_orders == 4599
