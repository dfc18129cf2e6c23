
from __future__ import annotations

import importlib
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle_queries import ORACLES
from saleswright.functions import normalize
from saleswright.operators import Checks, clean, issues, null_counts, rank_customers, with_rfm
from saleswright.plans import adhoc, features, forecast, kpi, marts, rollup, serving, views
from saleswright.schema import MONEY, QUANTITY, RAW_FRACTION, SEQUENCE
from saleswright.session import configure, sized
from saleswright.sources import clean_star_sales, read_sales_csv, staged, star_sales, write_csv, written_once
from saleswright.sources.batches import BatchStore
from saleswright.sources.staging import made_once, staging_path
from saleswright.sources.star import ORDER_KEY, star_files

ADHOC = """
    SELECT sales_rep, COUNT(*) AS orders, ROUND(SUM(sales), 2) AS revenue,
           ROUND(AVG(`profit_margin_%`), 2) AS avg_margin_pct
    FROM sales
    WHERE region = 'Asia' AND is_discounted = 1
    GROUP BY sales_rep
    ORDER BY revenue DESC, sales_rep
"""

VIEW_ROWS = """
    SELECT 'monthly_kpi' AS view, concat_ws('-', order_year, order_month) AS key, total_orders AS orders,
           total_revenue AS revenue FROM monthly_kpi
    UNION ALL SELECT 'category_kpi', product_category, total_orders, total_revenue FROM category_kpi
    UNION ALL SELECT 'rep_performance', sales_rep, orders_closed, total_revenue FROM rep_performance
"""
#: The revenue column of each report table.
MART_REVENUE = {
    "overall_kpis": "total_revenue",
    "monthly_trend": "revenue",
    "top_products": "total_revenue",
    "region_analysis": "revenue",
    "sales_rep_kpis": "total_revenue",
    "discount_analysis": "total_revenue",
}
FIXED_WEIGHTS = {"revenue_lag1": 0.5, "revenue_lag2": 0.2, "revenue_ma4": 0.2, "revenue_ma8": 0.1, "is_q4": 1000.0}
#: Small factors: most sales fall below half a cent, quantities below one.
FINE = {"amounts": Decimal("0.000001"), "quantities": Decimal("0.01")}


def _optional(name: str):
    """A module of the document pipeline, or None where that part is not installed.

    Only its own absence counts; an error inside it is raised.
    """
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name in (name, "saleswright.llm", "corpus_pipeline"):
            return None
        raise


_llm = _optional("saleswright.llm.queries")
_pipeline = _optional("corpus_pipeline") if _llm else None


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_llm.queries()) if _llm else {}
    if _pipeline:
        found["pipeline"] = _pipeline.run
    return found


def _llm_oracles() -> dict[str, str]:
    found = dict(_llm.oracle_sql()) if _llm else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        found["pipeline"] = _pipeline.ORACLE_SQL
    return found


def _shown(df: DataFrame) -> DataFrame:
    """Amounts as doubles and dates as ISO text, the form clients see."""

    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_sales(configure(spark), sf_dir)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_star_sales(configure(spark), sf_dir)


def _fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_star_sales(configure(spark), sf_dir, **FINE)


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales with one kind of damage in every twentieth order each.

    One optional column is left out. Rows whose id is lost keep their place.
    """
    kind = F.col(ORDER_KEY) % 20

    def damaged(at: int, column: str, value):
        return F.when(kind == at, value).otherwise(F.col(column))

    none, number = F.lit(None), lambda x: F.lit(Decimal(x))
    sales = F.when(kind == 0, none).when(kind == 1, -F.col("sales")).when(kind == 2, number("0")).otherwise(F.col("sales"))
    quantity = F.when(kind == 3, none).when(kind == 4, number("0")).when(kind == 5, number("-1")).otherwise(F.col("quantity"))
    discount = (
        F.when(kind == 6, number("-0.1")).when(kind == 7, number("1.5")).when(kind == 8, none).otherwise(F.col("discount"))
    )
    columns = {
        "sales": sales.cast(MONEY),
        "quantity": quantity.cast(QUANTITY),
        "discount": discount.cast(RAW_FRACTION),
        "profit": damaged(9, "profit", none),
        "region": damaged(10, "region", F.concat(F.lit(" \t"), F.upper("region"), F.lit("\n "))),
        "segment": damaged(11, "segment", F.lit("  ")),
        "order_id": damaged(12, "order_id", none),
        "customer_id": damaged(13, "customer_id", none),
        SEQUENCE: F.struct(ORDER_KEY, "order_id", SEQUENCE),
    }
    return _raw(spark, sf_dir).withColumns(columns).drop("sales_rep", ORDER_KEY)


def _checked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of the damaged rows, counted by the write of the cleaned ones."""
    checks = Checks()
    with written_once(clean(_dirty(spark, sf_dir), checks=checks)):
        return spark.createDataFrame(checks.found(), "check string, column_name string, n long")


def _thirds(df: DataFrame, column: str) -> DataFrame:
    """Two values that cut ``df`` into thirds of near equal size, from a sketch of bounded size.

    An exact percentile would gather every distinct value in one task.
    """
    return df.select(F.percentile_approx(column, [1 / 3, 2 / 3]))


def _in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged rows in three batches, one after another."""
    path = _own_path(spark, sf_dir, "batches")
    store = BatchStore(spark, path, buckets=8)

    def build() -> None:
        dirty = _dirty(sized(spark, star_files(sf_dir)), sf_dir)
        # The order keys of each batch follow those of the one before.
        low, high = _thirds(spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet"), "o_orderkey").first()[0]
        at = F.col(f"{SEQUENCE}.{ORDER_KEY}")
        for part in (at <= low, (at > low) & (at <= high), at > high):
            store.add(dirty.filter(part))

    made_once(path, build)
    return store.sales()


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table that queries read, built on first use."""
    return staged(configure(spark), sf_dir, "sales", lambda: _cleaned(spark, sf_dir))


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(_sales(spark, sf_dir))


def _forecaster(spark: SparkSession, sf_dir: str) -> tuple[forecast.Trained, DataFrame]:
    """Models and forecast over the weekly panel, made on first use and then loaded."""
    path = staging_path(spark, sf_dir, "models")
    if path is None:
        panel = _panel(spark, sf_dir)
        trained = forecast.train(panel)
        return trained, forecast.forecast(trained.model, panel)
    made_once(path, lambda: forecast.run_forecaster(_sales(spark, sf_dir), path))
    return forecast.load_trained(spark, path), forecast.load_forecast(spark, f"{path}/forecast")


def _own_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = staging_path(spark, sf_dir, name)
    if path is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return path


def _rollup(spark: SparkSession, sf_dir: str) -> rollup.Rollup:
    """The stored rollup, made on first use of two batches of sales."""
    path = _own_path(spark, sf_dir, "rollup")
    stored = rollup.Rollup(spark, path)

    def build() -> None:
        sales = _sales(spark, sf_dir)
        late = F.col("order_date") >= F.lit("1998-05-17").cast("date")
        stored.add(sales.filter(~late))
        stored.add(sales.filter(late))

    made_once(path, build)
    return stored


def _by_order(raw: DataFrame) -> DataFrame:
    """Rows with those of an order in one task, in input order.

    All that the first row of an order hangs on; a sort of the whole table would
    move every wide row again. The window keeps an order whole where a skewed
    join was split, and leaves the rows sorted.
    """
    place = Window.partitionBy(ORDER_KEY).orderBy("order_id", SEQUENCE)
    placed = raw.withColumn("_place", F.row_number().over(place)).filter("_place > 0")
    return placed.sortWithinPartitions(ORDER_KEY, "order_id", SEQUENCE).drop("_place")


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows out to CSV, each order in one file, back through the CSV source, cleaned."""
    path = _own_path(spark, sf_dir, "raw_csv")
    raw = _by_order(_raw(sized(spark, star_files(sf_dir)), sf_dir)).drop(ORDER_KEY, SEQUENCE)
    made_once(path, lambda: write_csv(raw, path, "gzip"))
    return clean(read_sales_csv(spark, path))


def _csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows in three folders of files with other columns each, read as one and cleaned."""
    path = _own_path(spark, sf_dir, "mixed_csv")
    part = F.col(ORDER_KEY) % 3
    raw = _raw(sized(spark, star_files(sf_dir)), sf_dir)

    def third(k: int) -> DataFrame:
        return _by_order(raw.filter(part == k)).drop(SEQUENCE)

    def write() -> None:
        write_csv(third(0).drop(ORDER_KEY), f"{path}/whole", "gzip")
        lacking = third(1).drop("region", "cost", ORDER_KEY)
        write_csv(lacking.select(*reversed(lacking.columns)), f"{path}/lacking", "gzip")
        write_csv(third(2).drop("segment").withColumnRenamed(ORDER_KEY, "noted"), f"{path}/other", "gzip")

    made_once(path, write)
    return clean(read_sales_csv(spark, f"{path}/*").drop("noted"))


def _views_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three created views, read by name and put under each other."""
    desk = adhoc.AdHoc(spark)
    desk.register(_sales(spark, sf_dir))
    return desk.select(VIEW_ROWS)


def _records_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly trend as a client gets it, in pages of one stored result."""
    served = serving.serve(kpi.revenue_trend_monthly(_sales(spark, sf_dir)))
    pages = served.page(0, 25)
    for first in range(25, served.count, 25):
        pages = pages.union(served.page(first, 25))
    return pages


def _fixed_lakhs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_in_lakhs(_fixed_forecast(spark, sf_dir))


def _report_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per report table as written: its rows and its total revenue."""
    path = _own_path(spark, sf_dir, "report")
    made_once(path, lambda: marts.write_marts(marts.report_marts(_sales(spark, sf_dir)), path))
    rows = None
    for name, revenue in MART_REVENUE.items():
        written = spark.read.parquet(f"{path}/{name}")
        row = written.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(revenue), 2).alias("total"))
        row = row.select(F.lit(name).alias("mart"), "rows", "total")
        rows = row if rows is None else rows.union(row)
    return rows


def _fixed_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursion with weights that are known beforehand."""
    model = forecast.linear_model(spark, FIXED_WEIGHTS)
    return forecast.forecast(model, _panel(spark, sf_dir))


def _fixed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of the same forecast, saved and read again."""
    path = _own_path(spark, sf_dir, "fixed_forecast")
    made_once(path, lambda: forecast.save_forecast(_fixed_forecast(spark, sf_dir), path))
    return forecast.forecast_summary(forecast.load_forecast(spark, path))


def _holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past figures as predictions of the next week, scored on the holdout."""
    scores = forecast.compare_columns(_panel(spark, sf_dir), ["revenue_lag1", "revenue_ma4", "revenue_ma8"])
    return scores.select("model", *[F.round(c, 2).alias(c) for c in ("mae", "rmse")], F.round("r2", 6).alias("r2"), "is_best")


def _live_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _ = _forecaster(spark, sf_dir)
    return forecast.forecast(trained.model, _panel(spark, sf_dir))


def _normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    mangled = F.concat(F.lit("\t "), F.upper("p_name"), F.lit("-o'neil 2nd\n"))
    return parts.select("p_partkey", normalize(mangled).alias("label"))


def _adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    desk = adhoc.AdHoc(spark)
    desk.register(_sales(spark, sf_dir))
    return desk.select(ADHOC)


def entry(spark: SparkSession) -> DataFrame:
    """Headline KPIs straight from the source tables, in one plan."""
    return _shown(kpi.overall_kpis(_cleaned(spark, "/root/testdata/sf0.001")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator under its key, over whole tables."""
    on_raw = {
        "quality_report": issues,
        "quality_nulls": null_counts,
    }
    on_dirty = {
        "quality_report_dirty": issues,
        "quality_nulls_dirty": null_counts,
        "sales_clean_dirty": clean,
    }
    on_sales = {
        "sales_rfm": lambda s: with_rfm(s).select(
            "order_id", "customer_id", "sales", "recency_days", "frequency", "monetary"
        ),
        "customer_rfm": rank_customers,
        "customer_segments": lambda s: rank_customers(s, limit=None),
        "monthly_kpi": views.monthly_kpi,
        "category_kpi": views.category_kpi,
        "rep_performance": views.rep_performance,
        "overall_kpis": kpi.overall_kpis,
        "revenue_trend_monthly": kpi.revenue_trend_monthly,
        "revenue_trend_year": lambda s: kpi.revenue_trend_monthly(s, 1997),
        "top_products": kpi.top_products,
        "top_products_50": lambda s: kpi.requested_products(s, 500),
        "region_segment_matrix": kpi.region_segment_matrix,
        "sales_rep_leaderboard": kpi.sales_rep_leaderboard,
        "discount_impact": kpi.discount_impact,
        "low_margin_alerts": kpi.low_margin_alerts,
        "trend_period": marts.trend_period,
        "rep_lakhs": marts.rep_in_lakhs,
        "category_breakdown": marts.category_breakdown,
        "category_margin_rank": marts.category_margin_rank,
        "region_segment_pivot": marts.region_segment_pivot,
        "records_json": lambda s: marts.json_records(kpi.revenue_trend_monthly(s)),
        "weekly_agg": features.weekly,
        "weekly_features": features.build_features,
        "weekly_features_region": lambda s: features.build_features(s, ["region"]),
        "train_test_split": lambda s: features.split_by_time(features.build_features(s)).select(
            "week", "revenue", "is_train"
        ),
    }
    on_rollup = {
        "overall_kpis": rollup.overall_kpis,
        "revenue_trend_monthly": rollup.revenue_trend_monthly,
        "revenue_trend_year": lambda r: rollup.revenue_trend_monthly(r, 1997),
        "top_products": rollup.top_products,
        "top_products_50": lambda r: rollup.requested_products(r, 500),
        "region_segment_matrix": rollup.region_segment_matrix,
        "sales_rep_leaderboard": rollup.sales_rep_leaderboard,
        "discount_impact": rollup.discount_impact,
        "low_margin_alerts": rollup.low_margin_alerts,
        "monthly_kpi": rollup.monthly_kpi,
        "category_kpi": rollup.category_kpi,
        "rep_performance": rollup.rep_performance,
    }
    on_folder = {
        "quality_report_of_write": _checked_write,
        "sales_in_batches": _in_batches,
        "normalize_text": _normalized_texts,
        "adhoc_select": _adhoc,
        "csv_round_trip": _csv_round_trip,
        "csv_mixed_headers": _csv_mixed_headers,
        "views_by_name": _views_by_name,
        "records_paged": _records_paged,
        "report_marts": _report_marts,
        "forecast_8w": _live_forecast,
        "forecast_fixed": _fixed_forecast,
        "forecast_fixed_lakhs": _fixed_lakhs,
        "forecast_fixed_summary": _fixed_summary,
        "holdout_metrics": _holdout_metrics,
    }
    on_trained = {
        "model_metrics": lambda trained: trained.metrics,
        "model_info": forecast.model_info,
        "feature_importance": forecast.top_tree_features,
    }
    on_forecast = {
        "forecast_lakhs": forecast.forecast_in_lakhs,
        "forecast_summary": forecast.forecast_summary,
    }

    def over(load, query):
        return lambda spark, sf_dir: _shown(query(load(configure(spark), sf_dir)))

    def direct(query):
        return lambda spark, sf_dir: _shown(query(configure(spark), sf_dir))

    def trained(spark: SparkSession, sf_dir: str):
        return _forecaster(configure(spark), sf_dir)[0]

    def predicted(spark: SparkSession, sf_dir: str):
        return _forecaster(configure(spark), sf_dir)[1]

    return (
        {k: over(_raw, q) for k, q in on_raw.items()}
        | {k: over(_dirty, q) for k, q in on_dirty.items()}
        | {"sales_clean": direct(_cleaned), "sales_clean_fine": direct(_fine)}
        | {k: over(_sales, q) for k, q in on_sales.items()}
        | {f"{k}_rollup": over(_rollup, q) for k, q in on_rollup.items()}
        | {k: direct(q) for k, q in on_folder.items()}
        | {k: over(trained, q) for k, q in on_trained.items()}
        | {k: over(predicted, q) for k, q in on_forecast.items()}
        | _llm_queries()
    )


def oracle_sql() -> dict[str, str]:
    """Equivalent DuckDB SQL; Spark ML results have none."""
    twins = {name: ORACLES[name.removesuffix("_rollup")] for name in queries() if name.endswith("_rollup")}
    twins["records_paged"] = ORACLES["records_json"]
    twins["forecast_fixed_lakhs"] = f"SELECT *, ROUND(forecasted_revenue / 100000, 7) AS revenue_lakh FROM ({ORACLES['forecast_fixed']})"
    twins["sales_in_batches"] = ORACLES["sales_clean_dirty"]
    twins["quality_report_of_write"] = ORACLES["quality_report_dirty"]
    return dict(ORACLES) | twins | _llm_oracles()
