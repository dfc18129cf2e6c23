"""Batches one after another against one run over all rows."""

import pytest
from conftest import SF_SMALL
from frames import frame, money
from pyspark.sql import functions as F

import __spark_entry__ as contract
from saleswright.operators import clean
from saleswright.schema import SEQUENCE
from saleswright.sources import batches, staging
from saleswright.sources.batches import BatchStore


@pytest.fixture(scope="module")
def raw(spark):
    """Repeated keys within and across batches, some first rows invalid, some without an id."""
    rows = []
    for i in range(120):
        key = None if i % 29 == 7 else f"K{i // 2 * 7 % 50}"
        rows.append({"order_id": key, "sales": money(-1 if i % 11 == 3 else i + 1), "customer_id": f"C{i}"})
    return frame(spark, *rows)


def shown(df):
    return sorted(repr((r.order_id, r.customer_id, r.sales)) for r in df.collect())


def test_batches_give_the_one_run_table(spark, raw, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    with pytest.raises(FileNotFoundError):
        store.sales()
    for low, high in ((0, 30), (30, 30), (30, 75), (75, 120)):
        store.add(raw.filter(F.col(SEQUENCE).between(low, high - 1)))
        assert shown(store.sales()) == shown(clean(raw.filter(F.col(SEQUENCE) < high)))
    again = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    again.add(raw)  # all known
    assert shown(again.sales()) == shown(clean(raw))
    assert again.sales().columns == store.sales().columns


def test_a_new_session_finds_the_keys(spark, raw, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    store.add(raw.filter(F.col(SEQUENCE) < 60))
    spark.sql(f"DROP TABLE {store.table}")
    store.add(raw)
    assert shown(store.sales()) == shown(clean(raw))


def test_a_failed_batch_counts_for_nothing(spark, raw, tmp_path, monkeypatch):
    """Its keys are in the table, but a repeated or another batch does not see them."""
    store = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    early, late = raw.filter(F.col(SEQUENCE) < 60), raw.filter(F.col(SEQUENCE) >= 60)
    store.add(early)
    with monkeypatch.context() as m:
        m.setattr(batches, "clean_unique", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.add(late)
    spark.catalog.refreshTable(store.table)
    assert spark.table(store.table).select("run").distinct().count() == 2
    assert shown(store.sales()) == shown(clean(early))
    store.add(late)
    assert shown(store.sales()) == shown(clean(raw))


def test_only_the_batch_moves(spark, raw, tmp_path, plan):
    """The stored keys are read bucket by bucket, without an exchange."""
    store = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    store.add(raw.filter(F.col(SEQUENCE) < 60))
    text = plan(store.first_rows(raw.filter(F.col(SEQUENCE) >= 60)))
    assert "SortMergeJoin" in text and "Bucketed: true" in text and "BroadcastExchange" not in text
    lines = text.splitlines()
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    batch = max(i for i, x in enumerate(lines[:scan]) if "Scan ExistingRDD" in x)
    assert not any("Exchange" in x for x in lines[batch:scan])


def test_a_key_that_fills_the_batch(spark, tmp_path, plan):
    rows = frame(spark, *[{"order_id": "HOT"}] * 200, {"order_id": "B"})
    store = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    assert "WindowGroupLimit" in plan(store.first_rows(rows))
    store.add(rows)
    assert store.sales().count() == 2


def test_cleaned_rows_of_a_batch_do_not_move_again(spark, raw, tmp_path, monkeypatch):
    texts = []
    published = batches.publish
    monkeypatch.setattr(batches, "publish", lambda df: (texts.append(published(df)._jdf.queryExecution().toString()), published(df))[1])
    BatchStore(spark, str(tmp_path / "s"), buckets=4).add(raw)
    assert len(texts) == 1 and "Exchange" not in texts[0]


def test_the_cut_into_batches_gathers_no_keys(spark, monkeypatch, plan):
    """Three parts near a third each, every row in one of them, from a sketch instead of all distinct keys."""
    seen = []
    thirds = contract._thirds
    monkeypatch.setattr(staging, "_made", set())
    monkeypatch.setattr(contract, "_thirds", lambda df, column: (seen.append((df, thirds(df, column))), seen[-1][1])[1])
    contract.queries()["sales_in_batches"](spark, SF_SMALL)
    ((orders, cut),) = seen
    text = plan(cut)
    assert "approx_percentile" in text or "percentile_approx" in text
    assert " percentile(" not in text
    keys = orders.select("o_orderkey")
    low, high = cut.first()[0]
    n = keys.count()
    parts = [keys.filter(x).count() for x in (f"o_orderkey <= {low}", f"o_orderkey > {low} AND o_orderkey <= {high}", f"o_orderkey > {high}")]
    assert sum(parts) == n and all(abs(p - n / 3) <= 0.01 * n for p in parts)


def test_places_of_rows_move_once(spark, raw, tmp_path):
    """The place of a row decides which is first; neither the way to the buckets nor the written copy has it."""
    store = BatchStore(spark, str(tmp_path / "s"), buckets=4)
    assert SEQUENCE not in store.first_rows(raw).columns
