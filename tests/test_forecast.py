from datetime import timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from saleswright.plans import forecast as fc
from saleswright.plans.features import FEATURES, build_features, split_by_time

QUICK = fc.Settings(trees=5, rounds=3, bins=16)


@pytest.fixture(scope="module")
def panel(sales):
    return build_features(sales).cache()


@pytest.fixture(scope="module")
def trained(panel):
    return fc.train(panel, settings=QUICK)


def arrays(panel):
    pdf = split_by_time(panel).orderBy("week").toPandas()
    x, y = pdf[list(FEATURES)].astype(float).to_numpy(), pdf["revenue"].astype(float).to_numpy()
    early = (pdf["is_train"] == 1).to_numpy()
    return x[early], y[early], x[~early], y[~early]


def test_ridge_equals_the_closed_form(panel, trained):
    x, y, x_test, y_test = arrays(panel)
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + 10.0 * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    error = y_test - ((x_test - mx) @ w + my)
    got = {r.model: r for r in trained.metrics.collect()}["Ridge"]
    assert got.mae == pytest.approx(np.abs(error).mean(), rel=1e-6)
    assert got.rmse == pytest.approx(np.sqrt((error**2).mean()), rel=1e-6)
    assert got.r2 == pytest.approx(1 - (error**2).sum() / ((y_test - y_test.mean()) ** 2).sum(), rel=1e-6)


def test_best_has_least_rmse(trained):
    rows = trained.metrics.collect()
    assert {r.model for r in rows} == {"RandomForest", "GradientBoosting", "Ridge"}
    assert min(rows, key=lambda r: r.rmse).model == trained.best
    assert [r.model for r in rows if r.is_best] == [trained.best]


def test_training_is_repeatable(panel, trained):
    again = fc.train(panel.repartition(5), settings=QUICK)
    key = lambda r: r.model
    assert sorted(again.metrics.collect(), key=key) == sorted(trained.metrics.collect(), key=key)


def test_top_features(trained):
    rows = fc.top_tree_features(trained).collect()
    assert len(rows) == 10 and {r.feature for r in rows} <= set(FEATURES)
    assert fc.top_features(trained).count() == (0 if trained.best == "Ridge" else 5)


def average_of(*features):
    """A model that predicts the mean of the named features."""
    from pyspark.ml.linalg import Vectors

    weights = Vectors.dense([1 / len(features) if f in features else 0.0 for f in FEATURES])
    spark_model = LinearRegressionModel  # built through its Java class, as PySpark has no public constructor
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    java = sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel("fixed", _java_vector(sc, weights), 0.0)
    model = spark_model(java).setFeaturesCol("features").setPredictionCol("predicted")
    return PipelineModel([VectorAssembler(inputCols=list(FEATURES), outputCol="features"), model])


def _java_vector(sc, vector):
    gateway = sc._gateway
    values = gateway.new_array(gateway.jvm.double, len(vector))
    for i, v in enumerate(vector):
        values[i] = float(v)
    return sc._jvm.org.apache.spark.ml.linalg.Vectors.dense(values)


def test_recursion_by_hand(panel):
    """Mean of lag 1, lag 4, both averages and the spread, fed back for ten weeks."""
    pdf = panel.orderBy("week").toPandas()
    history, week, want = [float(v) for v in pdf["revenue"]], pdf["week"].iloc[-1], []
    for _ in range(10):
        week += timedelta(weeks=1)
        last4 = history[-4:]
        value = np.mean([history[-1], history[-4], np.mean(last4), np.mean(history[-8:]), np.std(last4, ddof=1)])
        history.append(value)
        want.append((week, value))
    model = average_of("revenue_lag1", "revenue_lag4", "revenue_ma4", "revenue_ma8", "revenue_std4")
    got = fc.forecast(model, panel, weeks=10).collect()
    assert [r.week for r in got] == [w for w, _ in want]
    assert [float(r.forecasted_revenue) for r in got] == pytest.approx([v for _, v in want], abs=0.006)


def test_carried_and_calendar_features(panel):
    last = panel.orderBy(F.desc("week")).first()
    orders = fc.forecast(average_of("orders", "orders_lag1", "unique_customers"), panel, weeks=3).collect()
    want = (2 * last.orders + last.unique_customers) / 3
    assert [float(r.forecasted_revenue) for r in orders] == pytest.approx([want] * 3, abs=0.006)
    months = fc.forecast(average_of("month"), panel, weeks=8).collect()
    assert [int(r.forecasted_revenue) for r in months] == [r.week.month for r in months]


def test_short_series(panel):
    ordered = panel.orderBy("week").limit(3)
    model = average_of("revenue_lag4", "orders_lag4")
    rows = fc.forecast(model, ordered, weeks=2).collect()
    first = ordered.collect()[0]
    assert rows[0].forecasted_revenue == 0  # four weeks back lies before the history
    assert float(rows[1].forecasted_revenue) == pytest.approx((float(first.revenue) + first.orders) / 2, abs=0.006)
    single = fc.forecast(model, ordered.limit(1), weeks=2).collect()
    assert [r.forecasted_revenue for r in single] == [None, None]


def test_no_history_gives_no_rows(panel):
    assert fc.forecast(average_of("month"), panel.filter("false"), weeks=2).count() == 0


def test_many_series_at_once(sales):
    by_region = build_features(sales, ["region"])
    trained = fc.train(by_region, ["region"], QUICK)
    rows = fc.forecast(trained.model, by_region, weeks=3, series=["region"])
    counts = {r.region: r["count"] for r in rows.groupBy("region").count().collect()}
    assert set(counts.values()) == {3} and len(counts) == 5


def test_nothing_to_train_on(panel):
    with pytest.raises(ValueError):
        fc.train(panel.filter("false"))


def test_store_and_load(spark, sales, tmp_path):
    path = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        fc.load_trained(spark, path)
    with pytest.raises(FileNotFoundError):
        fc.load_forecast(spark, f"{path}/forecast")
    trained, predicted = fc.run_forecaster(sales, path, settings=QUICK)
    loaded = fc.load_trained(spark, path)
    assert loaded.best == trained.best
    again = fc.forecast(loaded.model, build_features(sales)).collect()
    assert again == predicted.orderBy("week").collect() and len(again) == 8
    summary = fc.forecast_summary(predicted).first()
    amounts = [r.forecasted_revenue for r in again]
    assert summary.asDict() == {
        "forecast_weeks": 8,
        "total_forecasted_revenue": sum(amounts),
        "min_forecasted_revenue": min(amounts),
        "max_forecasted_revenue": max(amounts),
    }
    info = fc.model_info(loaded).collect()
    assert len(info) == 3 and all(len(r.features) == 20 and r.model_name == loaded.best for r in info)
