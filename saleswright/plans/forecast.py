"""Train, compare and apply weekly revenue models with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions import in_lakhs
from ..session import ensure_checkpoint_dir
from ..sources.csv_files import write_csv
from ..sources.versions import current_folder, new_version
from .features import FEATURES, LAGS, TEST_SHARE, build_features, calendar, split_by_time

FOREST, BOOSTING, RIDGE = "RandomForest", "GradientBoosting", "Ridge"
WEEKS = 8
# Sets how training rows are laid out. Trees draw their samples per partition,
# so another layout gives slightly different trees.
ROWS_PER_TASK = 200_000


@dataclass(frozen=True)
class Settings:
    """Model parameters; the defaults are fixed values the results depend on."""

    trees: int = 200
    forest_depth: int = 8
    forest_leaf: int = 3
    rounds: int = 200
    rate: float = 0.05
    boost_depth: int = 4
    alpha: float = 10.0
    seed: int = 42
    test_share: float = TEST_SHARE
    # Split candidates per feature: more than the weeks of a long history, so
    # that the panel of one series gets one per distinct value.
    bins: int = 2048


@dataclass(frozen=True)
class Trained:
    """The winner and how all models did on the holdout."""

    best: str
    model: PipelineModel
    metrics: DataFrame
    importances: DataFrame


def _estimators(s: Settings, train_rows: int, label_spread: float) -> dict[str, Estimator]:
    trees = {"featuresCol": "features", "labelCol": "revenue", "seed": s.seed, "maxBins": s.bins}
    return {
        FOREST: RandomForestRegressor(
            numTrees=s.trees,
            maxDepth=s.forest_depth,
            minInstancesPerNode=s.forest_leaf,
            featureSubsetStrategy="all",
            **trees,
        ),
        BOOSTING: GBTRegressor(
            maxIter=s.rounds, stepSize=s.rate, maxDepth=s.boost_depth, lossType="squared", **trees
        ),
        # Spark divides the loss by the row count and works on a label of unit
        # spread, so the plain ridge penalty is rescaled by both.
        RIDGE: LinearRegression(
            featuresCol="features",
            labelCol="revenue",
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
            regParam=s.alpha * label_spread / train_rows,
        ),
    }


def _as_doubles(panel: DataFrame) -> DataFrame:
    return panel.withColumns({c: F.col(c).cast("double") for c in ("revenue", *FEATURES)})


def _scores(scored: DataFrame, names: Sequence[str]) -> DataFrame:
    """MAE, RMSE and R² of every model in one pass over the holdout."""
    long = scored.select("revenue", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(n).alias("predicted")) for n in names
    ])))
    error = F.col("revenue") - F.col("predicted")
    return long.groupBy("model").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / (F.var_pop("revenue") * F.count("revenue"))).alias("r2"),
    )


def train(panel: DataFrame, series: Sequence[str] = (), settings: Settings = Settings()) -> Trained:
    """Fit the three models on the early part of the panel, score the late part.

    All series are pooled into one fit, which Spark ML distributes. Training
    rows are laid out by key, since the same rows in the same partitions give
    the same trees on every run, and checkpointed: boosting submits hundreds of
    jobs over them, each of which would otherwise carry the whole lineage.
    """
    spark = panel.sparkSession
    ensure_checkpoint_dir(spark)
    rows = split_by_time(_as_doubles(panel), series, settings.test_share).checkpoint()
    early = rows.filter("is_train = 1")
    n, spread = early.agg(F.count("revenue"), F.stddev_pop("revenue")).first()
    if not n:
        raise ValueError("no complete weeks to train on")
    keys = [*series, "week"]
    tasks = -(-n // ROWS_PER_TASK)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    ready = assembler.transform(early.repartition(tasks, *keys).sortWithinPartitions(*keys))
    ready = ready.select("revenue", "features").checkpoint()

    estimators = _estimators(settings, n, spread)

    def fit(name: str):
        return name, estimators[name].setPredictionCol(name).fit(ready)

    with ThreadPool(len(estimators)) as pool:
        fitted = dict(pool.map(inheritable_thread_target(spark)(fit), estimators))

    scored = assembler.transform(rows.filter("is_train = 0"))
    for model in fitted.values():
        scored = model.transform(scored)
    metrics = _scores(scored, list(fitted)).checkpoint()
    best = metrics.orderBy("rmse", "model").first()["model"]
    metrics = metrics.withColumn("is_best", F.col("model") == best)
    return Trained(best, PipelineModel([assembler, fitted[best]]), metrics, _importances(spark, fitted, best))


def _importances(spark: SparkSession, fitted: dict, best: str) -> DataFrame:
    """Weight of each feature in each tree model: two times twenty values."""
    weights = [
        (name, name == best, feature, float(weight))
        for name, model in fitted.items()
        if hasattr(model, "featureImportances")
        for feature, weight in zip(FEATURES, model.featureImportances.toArray())
    ]
    return spark.createDataFrame(weights, "model string, is_best boolean, feature string, importance double")


def top_features(trained: Trained, limit: int = 5) -> DataFrame:
    """The features the winner leans on most; no rows if it is not a tree model."""
    return trained.importances.filter("is_best").orderBy(F.desc("importance"), "feature").limit(limit)


def top_tree_features(trained: Trained, limit: int = 5) -> DataFrame:
    """The same for every tree model, the winner marked."""
    ranked = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return (
        trained.importances.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= limit)
        .orderBy("model", "rank")
    )


def linear_model(spark: SparkSession, weights: dict[str, float], intercept: float = 0.0) -> PipelineModel:
    """A model with given weights by feature, for forecasts whose figures are known beforehand."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    vector = Vectors.dense([weights.get(f, 0.0) for f in FEATURES])
    built = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        "fixed", _py2java(spark.sparkContext, vector), float(intercept)
    )
    return PipelineModel([assembler, LinearRegressionModel(built)])


def compare_columns(panel: DataFrame, columns: Sequence[str], test_share: float = TEST_SHARE) -> DataFrame:
    """Holdout scores of panel columns taken as predictions, the best marked.

    The same scoring that compares fitted models: what a model has to beat.
    """
    late = split_by_time(_as_doubles(panel), (), test_share).filter("is_train = 0")
    scores = _scores(late, columns)
    first = Window.partitionBy().orderBy("rmse", "model")  # a row per column
    return scores.withColumn("is_best", F.row_number().over(first) == 1)


# --- forecast -----------------------------------------------------------------

_CARRIED = ("orders", "avg_order_value", "unique_customers", "avg_margin", "discounted_orders")
_HISTORY = 8


def _last_state(panel: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per series: its last week, and its latest values, newest first.

    A series adds at most eight rows to its arrays, picked before collecting.
    """
    latest = Window.partitionBy(*series).orderBy(F.desc("week"))
    state = (
        _as_doubles(panel)
        .withColumn("_rn", F.row_number().over(latest))
        .filter(F.col("_rn") <= _HISTORY)
        .groupBy(*series)
        .agg(
            F.sort_array(F.collect_list(F.struct("week", "revenue", "orders")), asc=False).alias("_tail"),
            *[F.max_by(c, "week").alias(c) for c in _CARRIED],
            F.max("week").alias("week"),
        )
        .filter(F.col("week").isNotNull())
    )
    return state.select(
        *series,
        "week",
        *_CARRIED,
        F.col("_tail.revenue").alias("_revenues"),
        F.col("_tail.orders").alias("_orders"),
        F.array().cast("array<struct<week:date,revenue:double>>").alias("_forecast"),
    )


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / F.size(values)


def _sample_std(values: Column) -> Column:
    mean, n = _mean(values), F.size(values)
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def _push(value: Column, values: Column) -> Column:
    return F.slice(F.concat(F.array(value), values), 1, _HISTORY)


def _step(state: DataFrame, model: PipelineModel, series: Sequence[str]) -> DataFrame:
    """Forecast the next week of every series and add it to the history."""
    revenues, orders = F.col("_revenues"), F.col("_orders")
    latest = F.slice(revenues, 1, 4)
    inputs = {f"revenue_lag{k}": F.coalesce(F.get(revenues, F.lit(k - 1)), F.lit(0.0)) for k in LAGS}
    inputs |= {f"orders_lag{k}": F.coalesce(F.get(orders, F.lit(k - 1)), F.lit(0.0)) for k in LAGS}
    inputs |= {"revenue_ma4": _mean(latest), "revenue_ma8": _mean(revenues), "revenue_std4": _sample_std(latest)}
    ready = state.withColumn("week", F.date_add("week", 7)).withColumns({**inputs, **calendar(F.col("week"))})
    predicted = model.stages[-1].getPredictionCol()
    scored = model.transform(ready).withColumn(
        "_next", F.when(F.col("revenue_std4").isNotNull(), F.col(predicted))
    )
    step = F.struct(F.col("week").alias("week"), F.col("_next").alias("revenue"))
    return scored.select(
        *series,
        "week",
        *_CARRIED,
        _push(F.col("_next"), revenues).alias("_revenues"),
        _push(F.col("orders"), orders).alias("_orders"),
        F.array_append("_forecast", step).alias("_forecast"),
    )


def forecast(model: PipelineModel, panel: DataFrame, weeks: int = WEEKS, series: Sequence[str] = ()) -> DataFrame:
    """``weeks`` further weeks per series, each fed back into the next.

    All series advance together, one model pass per week over one row each.
    Counts and margins of the last week are carried forward; the unrounded
    prediction joins the history. A series with a single complete week has no
    spread to predict from and gets nulls. Every eight steps the state is
    checkpointed, so that long horizons do not grow the plan without end.
    """
    model = model.copy()
    model.stages[0].setHandleInvalid("keep")
    state = _last_state(panel, series)
    for done in range(weeks):
        if done and done % 8 == 0:
            ensure_checkpoint_dir(panel.sparkSession)
            state = state.checkpoint()
        state = _step(state, model, series)
    revenue = F.col("revenue").cast("decimal(28,2)").alias("forecasted_revenue")
    return state.select(*series, F.inline("_forecast")).select(*series, "week", revenue).orderBy(*series, "week")


def forecast_summary(predicted: DataFrame) -> DataFrame:
    """Number of weeks, total and range of a forecast."""
    amount = F.col("forecasted_revenue")
    return predicted.agg(
        F.count(F.lit(1)).alias("forecast_weeks"),
        F.round(F.sum(amount), 2).alias("total_forecasted_revenue"),
        F.min(amount).alias("min_forecasted_revenue"),
        F.max(amount).alias("max_forecasted_revenue"),
    )


def forecast_in_lakhs(predicted: DataFrame) -> DataFrame:
    """The forecast as charts show it."""
    return predicted.withColumn("revenue_lakh", in_lakhs(F.col("forecasted_revenue")))


# --- storage ------------------------------------------------------------------


def save_trained(trained: Trained, path: str) -> None:
    """Replace the stored winner, metrics and feature weights, all three at once."""
    with new_version(trained.metrics.sparkSession, path) as version:
        trained.model.write().save(f"{version.folder}/model")
        trained.metrics.coalesce(1).write.parquet(f"{version.folder}/metrics")
        trained.importances.coalesce(1).write.parquet(f"{version.folder}/importances")


def load_trained(spark: SparkSession, path: str) -> Trained:
    """The stored model, or ``FileNotFoundError`` if none was trained."""
    path = current_folder(spark, path)
    metrics = _existing(spark, f"{path}/metrics", "no trained model")
    best = metrics.filter("is_best").first()["model"]
    return Trained(best, PipelineModel.load(f"{path}/model"), metrics, spark.read.parquet(f"{path}/importances"))


def save_forecast(predicted: DataFrame, path: str) -> None:
    write_csv(predicted, path)


def load_forecast(spark: SparkSession, path: str) -> DataFrame:
    """A saved forecast, or ``FileNotFoundError`` if none was made."""
    header = _existing(spark, path, "no forecast", fmt="csv")
    kinds = {"week": "date", "forecasted_revenue": "decimal(28,2)"}
    return header.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})


def _existing(spark: SparkSession, path: str, what: str, fmt: str = "parquet") -> DataFrame:
    try:
        return spark.read.format(fmt).option("header", True).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{what} at {path}; run the forecaster first") from None
        raise


def model_info(trained: Trained) -> DataFrame:
    """Winner, its inputs, and the metrics of every model, one row per model."""
    return trained.metrics.select(
        F.lit(trained.best).alias("model_name"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("features"),
        "model",
        "mae",
        "rmse",
        "r2",
    ).orderBy("model")


def run_forecaster(
    sales: DataFrame, path: str, series: Sequence[str] = (), settings: Settings = Settings(), weeks: int = WEEKS
) -> tuple[Trained, DataFrame]:
    """Features, training and forecast of cleaned sales, all stored under ``path``.

    The panel is checkpointed: training and forecast both start from it, and
    sales should be read and aggregated once.
    """
    ensure_checkpoint_dir(sales.sparkSession)
    panel = build_features(sales, series).checkpoint()
    trained = train(panel, series, settings)
    save_trained(trained, path)
    save_forecast(forecast(trained.model, panel, weeks, series), f"{path}/forecast")
    return trained, load_forecast(sales.sparkSession, f"{path}/forecast")
