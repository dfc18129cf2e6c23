import pytest
from frames import frame, money, twenty_orders

from saleswright.operators import Checks, clean, issues, null_counts, validate
from saleswright.operators import quality
from saleswright.sources import written_once


def found(df):
    return {(r.check, r.column_name): r.n for r in issues(df).collect()}


def test_clean_data_passes_unchanged(spark):
    df = twenty_orders(spark)
    assert validate(df) is df
    assert found(df) == {}


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="sales"):
        validate(twenty_orders(spark).drop("sales"))


def test_optional_columns_may_be_missing(spark):
    assert found(twenty_orders(spark).drop("region", "cost")) == {}


def test_counts_every_kind_of_issue(spark):
    df = frame(
        spark,
        {"order_id": "A"},
        {"order_id": "A"},
        {"order_id": None},
        {"order_id": None},
        {"order_id": "B", "sales": money(-5)},
        {"order_id": "C", "sales": None},
        {"order_id": "D", "sales": money(0), "discount": None},
    )
    assert found(df) == {
        ("null", "order_id"): 2,
        ("null", "sales"): 1,
        ("null", "discount"): 1,
        ("negative", "sales"): 1,
        ("duplicate", "order_id"): 2,
    }


def test_null_counts_lists_all_required_columns(spark):
    counts = {r.column_name: r.n for r in null_counts(frame(spark, {"profit": None}, {})).collect()}
    assert counts["profit"] == 1
    assert sum(counts.values()) == 1 and len(counts) == 9


def test_all_checks_take_one_scan(spark, raw, plan):
    assert plan(issues(raw)).count("lineitem.parquet") == 1


def dirty(spark):
    return frame(
        spark,
        {"order_id": "A"},
        {"order_id": "A"},
        {"order_id": None},
        {"order_id": None},
        {"order_id": "B", "sales": money(-5)},
        {"order_id": "C", "sales": None},
        {"order_id": "D", "sales": money(0), "discount": None},
        {"order_id": "E", "profit": None, "quantity": 0},
    )


def test_counts_of_a_write_equal_a_scan(spark, monkeypatch):
    empty = Checks()
    with written_once(clean(dirty(spark).limit(0), checks=empty)):
        assert empty.found() == []
    for df in (dirty(spark).repartition(5), twenty_orders(spark), dirty(spark).coalesce(1)):
        expected = found(df)
        checks = Checks()
        with monkeypatch.context() as m, written_once(clean(df, checks=checks)) as cleaned:
            m.setattr(quality, "issues", None)  # no scan of its own
            assert {(c, column): n for c, column, n in checks.found()} == expected
            assert cleaned.count() == clean(df).count()


def test_checks_take_no_scan_or_shuffle(spark, raw, plan):
    from saleswright.sources.star import STAR_KEYS

    bare, watched = plan(clean(raw, STAR_KEYS)), plan(clean(raw, STAR_KEYS, Checks()))
    assert watched.count("FileScan") == bare.count("FileScan") and watched.count("Exchange") == bare.count("Exchange")


def test_tasks_run_again_are_noticed(spark):
    """Rows of a task that is counted twice are not believed."""
    checks, df = Checks(), dirty(spark)
    with written_once(clean(df, checks=checks)):
        counts = dict(checks._seen.get)

    class Twice:
        get = counts | {"_rows": 2 * counts["_rows"], "_tasks": counts["_tasks"] + 1}

    checks._seen = Twice()
    assert {(c, column): n for c, column, n in checks.found()} == found(df)


def test_checks_need_the_required_columns(spark):
    with pytest.raises(ValueError, match="sales"):
        clean(twenty_orders(spark).drop("sales"), checks=Checks())


def test_a_run_reads_raw_once(spark, tmp_path, caplog, monkeypatch):
    """The whole run reports the issues without a scan for them."""
    from saleswright.plans import pipeline

    monkeypatch.setattr(quality, "issues", None)
    with caplog.at_level("INFO", logger="saleswright"):
        assert pipeline.run_etl(dirty(spark), str(tmp_path), export_csv=False).count() == 2
    said = [r.message for r in caplog.records]
    assert "2 rows: duplicate in order_id" in said and "validation complete, 6 issues" in said
