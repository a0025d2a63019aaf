import datetime as dt
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from data import events, months, ramp
from monthtide.operators import models, wide_trees
from monthtide.operators.features import bin_count
from monthtide.operators.models import COLUMNS, tree_estimator
from monthtide.operators.tuning import tune_generalized_linear, tune_tree
from monthtide.plans.direct import forecast_direct
from monthtide.plans.recursive import forecast_recursive
from monthtide.plans.training import build_series

JAN = dt.date(2015, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    counts = {
        (f"d{k}", m): rng.randint(1, 5) + 2 * k for k in range(4) for m in months(JAN, 12)
    }
    return build_series(events(spark, counts), "doctor")


def spark_cross_validation(estimator, grid, series):
    evaluator = RegressionEvaluator(labelCol="n", metricName="rmse")
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
        numFolds=3, foldCol="fold",
    ).fit(series.frame)


def test_trees_as_by_sparks_cross_validator(series):
    tuned = tune_tree(series.frame, series.bounds.last_id, 4)
    estimator = tree_estimator(max_bins=bin_count(series.bounds.last_id, 4))
    grid = ParamGridBuilder().addGrid(estimator.maxDepth, [3, 5, 7]).build()
    want = spark_cross_validation(estimator, grid, series)
    assert tuned.rmse == pytest.approx(want.avgMetrics)
    assert tuned.model.depth == want.bestModel.depth


def test_families_as_by_sparks_cross_validator(series):
    tuned = tune_generalized_linear(series.frame)
    estimator = GeneralizedLinearRegression(**COLUMNS)
    grid = ParamGridBuilder().addGrid(estimator.family, ["gaussian", "poisson"]).build()
    want = spark_cross_validation(estimator, grid, series)
    assert tuned.rmse == pytest.approx(want.avgMetrics)
    assert tuned.model.coefficients.toArray() == pytest.approx(
        want.bestModel.coefficients.toArray()
    )


def test_too_few_rows_for_the_categories(spark):
    df = events(spark, {(f"d{k}", JAN): 1 for k in range(9)})
    with pytest.raises(ValueError, match="too few for a model"):
        forecast_recursive(build_series(df, "doctor"), 1)


@pytest.mark.parametrize("forecast", [forecast_recursive, forecast_direct])
def test_too_few_months_for_the_folds(spark, forecast):
    with pytest.raises(ValueError, match="too few"):
        forecast(build_series(ramp(spark, JAN, [1, 2])), 1)


@pytest.mark.parametrize("depths, packed", [((3, 5, 7), 7), ((4, 2), 7), ((2, 9), 7), ((3, 5), 2)])
def test_trees_of_very_many_categories(monkeypatch, spark, depths, packed):
    """Grown as tables, all folds together; the scores, the choice and the model are the same."""
    rng = random.Random(8)
    counts = {
        (f"d{k:02d}", m): rng.randint(1, 30) + 3 * (k % 5) + i // 2
        for k in range(35) for i, m in enumerate(months(JAN, 20)) if rng.random() < 0.9
    }
    series = build_series(events(spark, counts), "doctor")
    last, n = series.bounds.last_id, series.bounds.categories

    def found():
        tuned = tune_tree(series.frame, last, n, depths)
        rows = tuned.model.transform(series.frame).select("category", "id", "prediction").collect()
        return tuned, {(r.category, r.id): r.prediction for r in rows}

    want, predicted = found()
    monkeypatch.setattr(models, "WIDE_FROM", 30)
    monkeypatch.setattr(wide_trees, "PACKED_DEPTH", packed)
    got, rows = found()
    assert isinstance(got.model, wide_trees.WideForest)
    assert got.rmse == pytest.approx(want.rmse)
    assert list(got.best.values()) == list(want.best.values())
    assert rows == pytest.approx(predicted)
