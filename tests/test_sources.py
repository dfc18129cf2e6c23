import time
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import SF_SMALL
from frames import frame, money
from pyspark.sql import functions as F

import __spark_entry__ as contract
from saleswright import session
from saleswright.operators import clean, issues, with_rfm
from saleswright.plans import pipeline, views
from saleswright.plans.forecast import Settings, run_forecaster
from saleswright.schema import MARGIN, RAW
from saleswright.session import shuffle_partitions
from saleswright.sources import conform, publish, read_sales, read_sales_csv, save_sales_table, write_csv, write_sales, written_once
from saleswright.sources import staging
from saleswright.sources.csv_files import files_by_header
from saleswright.sources.staging import staging_path
from saleswright.sources.star import STAR_KEYS
from saleswright.sources.versions import current_folder

HEADER = ",".join(RAW.fieldNames()) + ",profit_margin_%\n"


def write(path, *lines, header=HEADER):
    path.write_text(header + "".join(line + "\n" for line in lines))
    return str(path)


def line(order="A", day="2024-01-05", quantity="2", sales="10.00", profit="3.00", discount="0.05"):
    return f'{order},{day},C1,"Raj, A",South,Consumer,Rep,Desk,Furniture,{quantity},5.25,{discount},{sales},7.00,{profit},30'


def test_csv_types_and_missing_values(spark, tmp_path):
    path = write(tmp_path / "s.csv", line(), line("B", sales="NaN", profit="", discount="NA", quantity="3.0"))
    df = read_sales_csv(spark, path)
    assert df.drop("ingest_seq").schema.fields == RAW.fields
    a, b = df.orderBy("order_id").collect()
    assert (a.order_date, a.customer_name, a.unit_price, a.sales) == (date(2024, 1, 5), "Raj, A", Decimal("5.25"), 10)
    assert (b.sales, b.profit, b.discount, b.quantity) == (None, None, None, 3)
    assert {(r.check, r.column_name): r.n for r in issues(df).collect()} == {
        ("null", "sales"): 1,
        ("null", "profit"): 1,
        ("null", "discount"): 1,
    }


def test_csv_first_row_in_file_order_wins(spark, tmp_path):
    lines = [line(f"K{i % 50}", sales=f"{i + 1}.00") for i in range(2000)]
    path = write(tmp_path / "s.csv", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_sales_csv(spark, path)
        assert df.rdd.getNumPartitions() > 8
        kept = clean(df)
        assert {r.order_id: int(r.sales) for r in kept.collect()} == {f"K{i}": i + 1 for i in range(50)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = write(tmp_path / "s.csv", line().replace("Raj, A", "Raj\nA"), line("B"))
    got = {r.order_id: r.customer_name for r in read_sales_csv(spark, path, multiline=True).collect()}
    assert got == {"A": "Raj\nA", "B": "Raj, A"}


def fields(text, *names, header=HEADER):
    """Some fields of a line, in the order asked for."""
    import csv

    row = dict(zip(header.strip().split(","), next(csv.reader([text]))))
    return ",".join(f'"{row[n]}"' for n in names)


def test_csv_files_of_different_headers(spark, tmp_path):
    """Missing, reordered and extra columns; the first row in file order wins across groups."""
    import gzip

    names = RAW.fieldNames()
    fewer = [n for n in reversed(names) if n not in ("segment", "cost")]
    write(tmp_path / "1 full.csv", line("A"), line("B", sales="20.00"))
    write(tmp_path / "2{few}.csv", fields(line("B", sales="99.00"), *fewer), fields(line("C"), *fewer), header=",".join(fewer) + "\r\n")
    with gzip.open(tmp_path / "3.csv.gz", "wt") as f:
        f.write(",".join([*names, '"a ""note"", of it"']) + "\n" + fields(line("D"), *names) + ",said\n")
    write(tmp_path / "4.csv", line("C", sales="77.00"), line("E"))
    write(tmp_path / "5 empty.csv", header="")
    write(tmp_path / "6 no rows.csv", header=",".join(names) + "\n")
    df = read_sales_csv(spark, str(tmp_path))
    assert df.count() == 7
    assert {r.order_id: (int(r.sales), r.segment, r.cost) for r in clean(df).collect()} == {
        "A": (10, "Consumer", 7),
        "B": (20, "Consumer", 7),
        "C": (10, None, None),
        "D": (10, "Consumer", 7),
        "E": (10, "Consumer", 7),
    }
    assert [r[0] for r in df.select('`a "note", of it`').dropna().collect()] == ["said"]
    assert {len(files) for files in files_by_header(spark, str(tmp_path)).values()} == {2, 1}


def test_csv_where_some_files_lack_a_required_column(spark, tmp_path):
    names = [n for n in RAW.fieldNames() if n != "profit"]
    write(tmp_path / "a.csv", line("A"))
    write(tmp_path / "b.csv", fields(line("B"), *names), header=",".join(names) + "\n")
    with pytest.raises(ValueError, match=r"b\.csv lacks \['profit'\]"):
        read_sales_csv(spark, str(tmp_path))


def test_one_header_takes_one_scan(spark, tmp_path, plan):
    for name in "abc":
        write(tmp_path / f"{name}.csv", line(name))
    assert plan(read_sales_csv(spark, str(tmp_path))).count("FileScan") == 1


def test_csv_without_a_required_column(spark, tmp_path):
    path = write(tmp_path / "s.csv", "A,2024-01-01", header="order_id,order_date\n")
    with pytest.raises(ValueError, match="customer_id"):
        issues(read_sales_csv(spark, path))


@pytest.mark.parametrize("bad", [{"day": "soon"}, {"sales": "many"}])
def test_csv_with_unreadable_values_raises(spark, tmp_path, bad):
    df = read_sales_csv(spark, write(tmp_path / "s.csv", line(**bad)))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP|CANNOT_PARSE"):
        df.collect()


def test_conform_takes_nan_for_missing(spark):
    df = spark.sql("SELECT 'A' AS order_id, CAST('NaN' AS DOUBLE) AS sales, 1.005D AS profit, TIMESTAMP'2024-01-02 03:04:05' AS order_date")
    row = conform(df).first()
    assert (row.sales, row.order_date) == (None, date(2024, 1, 2))


def test_table_round_trip(spark, tmp_path):
    df = with_rfm(clean(frame(spark, {}, {"order_date": date(2023, 5, 6)})))
    path = str(tmp_path / "sales")
    for _ in range(2):
        write_sales(df, path)
    back = read_sales(spark, path)
    assert set(back.columns) == set(df.columns)
    assert back.select(*df.columns).orderBy("order_id").collect() == df.orderBy("order_id").collect()
    assert "profit_margin_%" in spark.read.parquet(current_folder(spark, path)).columns


def test_catalog_table_and_views(spark):
    for name in views.VIEWS:
        spark.catalog.dropTempView(name)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    try:
        df = clean(frame(spark, {}, {}))
        for _ in range(2):
            save_sales_table(df, "shop.sales")
        assert spark.table("shop.sales").select("`profit_margin_%`").count() == 2
        views.create_views(spark, "shop.sales", temporary=False)
        assert spark.table("monthly_kpi").first().total_orders == 2
        save_sales_table(df.limit(1), "shop.sales")
        assert spark.table("category_kpi").first().total_orders == 1
    finally:
        for name in views.VIEWS:
            spark.sql(f"DROP VIEW IF EXISTS {name}")
        spark.sql("DROP DATABASE shop CASCADE")


def test_csv_round_trip(spark, tmp_path):
    df = publish(clean(frame(spark, {}, {})))
    write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == df.columns and back.first().order_date == "2024-01-01"


def test_written_copy_goes_after_use(spark):
    with written_once(spark.range(5)) as df:
        path = df.inputFiles()[0]
        assert df.agg(F.sum("id")).first()[0] == 10
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path.rsplit("/", 1)[0])


def test_partition_count_follows_the_input():
    assert shuffle_partitions(100 << 40) == 204800
    assert shuffle_partitions(1 << 20, cores=8) == 8


def test_full_run_twice_gives_the_same_tables(spark, raw, tmp_path):
    def snapshot():
        sales, trained, predicted = pipeline.run_all(
            raw, str(tmp_path), STAR_KEYS, settings=Settings(trees=3, rounds=2, bins=16)
        )
        figures = sales.agg(F.count("*"), F.sum("sales"), F.sum(F.xxhash64(*sales.columns) % 1000003)).first()
        return figures, trained.best, predicted.orderBy("week").collect(), spark.table("monthly_kpi").count()

    first, second = snapshot(), snapshot()
    assert first == second
    assert first[0][0] == 4599
    written = {p.name for p in (tmp_path / "report").iterdir()}
    assert len(written) == 7 and "forecast" in written
    exported = spark.read.option("header", True).csv(str(tmp_path / "sales_csv"))
    assert exported.count() == 4599 and "monetary" in exported.columns and MARGIN not in exported.columns


def test_csv_to_table(spark, tmp_path):
    raw_path = write(tmp_path / "s.csv", line(), line(), line("B", sales="-1"), line("C", quantity="0"), line("D"))
    sales = pipeline.run_etl(read_sales_csv(spark, raw_path), str(tmp_path / "out"))
    assert sorted(r.order_id for r in sales.collect()) == ["A", "D"]
    assert [r.frequency for r in sales.collect()] == [2, 2]


def test_command_line(spark, sales, tmp_path, monkeypatch):
    from saleswright import __main__ as command
    from saleswright.plans import forecast

    raw_path, root = str(tmp_path / "raw"), str(tmp_path / "out")
    write_csv(sales.select(*RAW.fieldNames()), raw_path)
    quick = lambda *a, **kw: pipeline.run_all(*a, **kw, settings=Settings(trees=3, rounds=2, bins=16))
    monkeypatch.setattr(command, "run_all", quick)
    command.main(["all", raw_path, root, "--series", "region", "--weeks", "2"])
    assert read_sales(spark, f"{root}/sales").count() == 4599
    assert forecast.load_forecast(spark, f"{root}/models/forecast").count() == 10


def test_stages_by_themselves(spark, tmp_path, monkeypatch):
    from saleswright import __main__ as command

    days = [f"{i % 28 + 1:02d}/{i // 28 % 12 + 1:02d}/{2022 + i // 336}" for i in range(0, 900, 3)]
    raw_path = write(tmp_path / "raw.csv", *[line(f"K{i}", day=day, sales=f"{i + 1}.00") for i, day in enumerate(days)])
    root = str(tmp_path / "out")
    command.main(["etl", raw_path, root, "--dates", "dd/MM/yyyy"])
    assert read_sales(spark, f"{root}/sales").count() == 300
    command.main(["report", root])
    assert not (tmp_path / "out/report/forecast").exists()
    quick = lambda *a, **kw: run_forecaster(*a, **kw, settings=Settings(trees=2, rounds=2, bins=16))
    monkeypatch.setattr(command, "run_forecaster", quick)
    command.main(["forecast", root, "--weeks", "2"])
    command.main(["report", root])
    assert spark.read.parquet(f"{root}/report/forecast").count() == 2


@pytest.mark.parametrize("day", ["2024-01-02", "2024-01-02 10:00:00", "2024-01-02 10:00", "2024-01-02T10:00:00"])
def test_dates_with_and_without_time(spark, tmp_path, day):
    assert read_sales_csv(spark, write(tmp_path / "s.csv", line(day=day))).first().order_date == date(2024, 1, 2)


def test_small_amounts_survive(spark, tmp_path):
    path = write(tmp_path / "s.csv", line("A", sales="0.004"), line("B", quantity="0.5"), line("C", quantity="2.5"))
    kept = {r.order_id: (r.sales, r.quantity) for r in clean(read_sales_csv(spark, path)).collect()}
    assert kept == {"A": (Decimal("0.004"), 2), "B": (10, Decimal("0.5")), "C": (10, Decimal("2.5"))}


def test_too_small_an_amount_raises(spark, tmp_path):
    df = read_sales_csv(spark, write(tmp_path / "s.csv", line(sales="1e-12")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


@pytest.mark.parametrize("sales", ["1,200.00", "12 EUR"])
def test_bad_numbers_raise_whatever_the_session_says(spark, tmp_path, sales):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = read_sales_csv(spark, write(tmp_path / "s.csv", line(sales=f'"{sales}"')))
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            clean(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_few_files_per_year(spark, sales, tmp_path):
    write_sales(sales.repartition(40), str(tmp_path / "sales"))
    years = list((tmp_path / "sales").glob("v-*/order_year=*"))
    assert len(years) == 7
    for year in years:
        assert len(list(year.glob("part-*"))) <= 2


def test_stored_table_follows_its_source(spark, tmp_path):
    source = tmp_path / "source"
    spark.range(3).write.parquet(str(source))
    first = staging_path(spark, str(source), "x")
    assert staging_path(spark, str(source), "x") == first
    spark.range(4).write.mode("overwrite").parquet(str(source))
    assert staging_path(spark, str(source), "x") != first


def broken(df, column):
    """The same rows, but reading them fails late."""
    return df.withColumn(column, F.when(F.rand(3) < 0.5, F.raise_error(F.lit("lost")).cast(df.schema[column].dataType)).otherwise(F.col(column)))


def test_a_write_that_fails_leaves_the_old_outputs(spark, tmp_path):
    """Table, export and report, each replaced by a write that breaks off half-way, then by a whole one."""
    from saleswright.plans import marts

    df = clean(frame(spark, *[{} for _ in range(40)]))
    table, export, report = (str(tmp_path / name) for name in ("sales", "csv", "report"))

    def read():
        return (
            read_sales(spark, table).count(),
            spark.read.option("header", True).csv(export).count(),
            spark.read.parquet(f"{report}/monthly_trend").first().total_orders,
        )

    def write_all(rows):
        for sink in (lambda: write_sales(rows, table), lambda: write_csv(rows, export), lambda: marts.write_marts(marts.report_marts(rows), report)):
            yield sink

    for sink in write_all(df):
        sink()
    assert read() == (40, 40, 40)
    opened = read_sales(spark, table)
    for sink in write_all(broken(df.limit(30), "sales")):
        with pytest.raises(Exception, match="lost"):
            sink()
    assert read() == (40, 40, 40)
    assert {p.name for p in tmp_path.iterdir()} == {"sales", "csv", "report"}
    for sink in write_all(df.limit(7)):
        sink()
    assert read() == (7, 7, 7)
    assert opened.count() == 40  # a reader of the version before


def test_a_model_is_replaced_with_its_metrics(spark, sales, tmp_path, monkeypatch):
    from saleswright.plans import forecast as fc
    from saleswright.plans.features import build_features

    path = str(tmp_path / "models")
    panel = build_features(sales)
    trained = fc.train(panel, settings=Settings(trees=2, rounds=2, bins=16))
    fc.save_trained(trained, path)
    before = fc.load_trained(spark, path).metrics.collect()
    other = fc.Trained("none", trained.model, trained.metrics.withColumn("mae", F.lit(0.0)), broken(trained.importances, "feature"))
    with pytest.raises(Exception, match="lost"):
        fc.save_trained(other, path)
    loaded = fc.load_trained(spark, path)
    assert loaded.best == trained.best and sorted(loaded.metrics.collect()) == sorted(before)


def test_an_export_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "x")
    write_csv(spark.range(9), path)
    write_csv(spark.read.option("header", True).csv(path).filter("id < 4"), path)
    assert spark.read.option("header", True).csv(path).count() == 4


def test_star_sales_move_once_by_order(spark, plan, tmp_path):
    """One shuffle of line items for duplicates and orders, none for the stored table, and no sort before either."""
    from saleswright.sources import clean_star_sales

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(clean_star_sales(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("hashpartitioning(l_orderkey") == 1
    below = text[text.index("hashpartitioning(l_orderkey") :].splitlines()
    scan = next(i for i, x in enumerate(below) if "FileScan" in x)
    assert not any("Sort" in x or "Window" in x for x in below[:scan])
    write_sales(spark.range(8).selectExpr("id", "cast(1990 + id % 2 AS int) AS order_year").repartition(3, "id"), str(tmp_path / "t"), gather=False)
    assert read_sales(spark, str(tmp_path / "t")).count() == 8


def test_orders_lie_whole_in_csv_files(spark, raw, plan, tmp_path):
    """Rows of an order in one compressed file, in input order, without a sort of the whole table."""
    import __spark_entry__ as entry
    from saleswright.schema import SEQUENCE
    from saleswright.sources.star import ORDER_KEY

    rows = entry._by_order(raw)
    assert "rangepartitioning" not in plan(rows)
    write_csv(rows.select("*", F.to_json(SEQUENCE).alias("at")).drop(SEQUENCE).repartition(1, ORDER_KEY), str(tmp_path / "c"), "gzip")
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "c").glob("part-*"))
    assert read_sales_csv(spark, str(tmp_path / "c")).count() == raw.count()
    keys = [(t, r[0], r[1], tuple(r[2])) for t, r in rows.select(ORDER_KEY, "order_id", SEQUENCE).rdd.mapPartitionsWithIndex(
        lambda t, part: ((t, tuple(r)) for r in part)).collect()]
    assert len(keys) == raw.count() and keys == sorted(keys)
    assert len({(t, key) for t, key, *_ in keys}) == len({key for _, key, *_ in keys})


def test_shuffle_partitions_fit_the_files(spark, tmp_path):
    key, read = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before, read_before = spark.conf.get(key), spark.conf.get(read)
    (tmp_path / "part").mkdir()
    (tmp_path / "part" / "a").write_bytes(b"x" * 700)
    (tmp_path / "b").write_bytes(b"x" * 300)
    paths = [str(tmp_path / "part"), str(tmp_path / "b")]
    try:
        session.sized(spark, paths, 1000)
        assert spark.conf.get(key) == before
        assert session.sized(spark, paths, 10) is spark and spark.conf.get(key) == "100"
        session.sized(spark, paths, 100)
        assert spark.conf.get(key) == "100"
        for was, now in (("134217728b", str(32 << 20)), ("1g", str(32 << 20)), ("16m", "16m"), ("4096", "4096")):
            spark.conf.set(read, was)
            session.sized(spark, paths, 1000)
            assert spark.conf.get(read) == now
    finally:
        spark.conf.set(key, before)
        spark.conf.set(read, read_before)


@pytest.mark.parametrize("name", ["csv_round_trip", "csv_mixed_headers", "sales_in_batches"])
def test_wide_joins_get_partitions_by_input(spark, monkeypatch, name):
    """Before the first shuffle of the query, the session is fitted to the files of the star schema."""
    asked = []
    monkeypatch.setattr(staging, "_made", set())
    monkeypatch.setattr(contract, "sized", lambda spark, paths: (asked.append(list(paths)), spark)[1])
    contract.queries()[name](spark, SF_SMALL)
    assert asked and f"{SF_SMALL}/lineitem.parquet" in asked[0] and len(asked[0]) == 7


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.name for d in folders for f in Path(d).rglob("shuffle_*.data")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(2000).withColumn("k", F.col("id") % 7)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting, None), shuffle_files(spark)
    rows.repartition(5, "k").write.parquet(str(tmp_path / "plain"))
    assert shuffle_files(spark) - before
    before = shuffle_files(spark)
    write_csv(rows.repartition(5, "k"), str(tmp_path / "out"))
    with written_once(rows.repartition(5, "k")) as copy:
        assert len(copy.columns) == 2
    for _ in range(50):  # files are deleted beside the job
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(setting, None) == was
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2000
