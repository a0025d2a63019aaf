import datetime as dt
import random
from functools import reduce

import numpy as np
import pytest
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from data import events, months, ramp
from monthtide.operators import models
from monthtide.operators.moments import ElasticNet, Moments, fold_moments, moments, outside
from monthtide.operators.poisson import fit_poisson
from monthtide.operators.tuning import tune_linear
from monthtide.plans.recursive import forecast_recursive
from monthtide.plans.training import build_series

JAN = dt.date(2015, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(4)
    counts = {
        (f"d{k}", m): rng.randint(1, 9) + 3 * k + i // 3
        for k in range(5) for i, m in enumerate(months(JAN, 18)) if rng.random() < 0.9
    }
    return build_series(events(spark, counts), "doctor")


def of_rows(rows):
    x = np.array(rows, float)
    return Moments(len(x), x.mean(0), (x - x.mean(0)).T @ (x - x.mean(0)))


def test_parts_make_the_whole():
    rng = np.random.default_rng(1)
    # far from zero, so that plain sums of squares would lose all digits
    rows = rng.normal(0, 1, (60, 3)) + [1e9, -1e9, 1e10]
    parts = [of_rows(rows[:1]), of_rows(rows[1:20]), Moments.none(2), of_rows(rows[20:])]
    whole, want = reduce(Moments.__add__, parts), of_rows(rows)
    assert whole.rows == 60 and whole.means == pytest.approx(want.means)
    assert whole.spread == pytest.approx(want.spread, rel=1e-6)
    but_one = outside(parts, 1)
    assert but_one.spread == pytest.approx(of_rows(np.delete(rows, slice(1, 20), 0)).spread, rel=1e-6)


def test_moments_of_folds(series):
    whole = moments(series.frame)
    parts = fold_moments(series.frame, 3)
    assert sum(p.rows for p in parts) == whole.rows == series.bounds.rows
    assert reduce(Moments.__add__, parts).spread == pytest.approx(whole.spread)
    assert fold_moments(series.frame.where("fold = 0"), 3)[1].rows == 0


@pytest.mark.parametrize(
    "reg, elastic", [(0.0, 0.0), (0.01, 0.0), (3.0, 0.0), (0.01, 1.0), (1.5, 1.0), (0.7, 0.5), (1e6, 1.0)]
)
def test_as_sparks_linear_regression(series, reg, elastic):
    want = LinearRegression(
        regParam=reg, elasticNetParam=elastic, maxIter=5000, tol=1e-13, **models.COLUMNS
    ).fit(series.frame)
    got = ElasticNet(reg, elastic)(series.frame)
    assert got.coefficients.toArray() == pytest.approx(want.coefficients.toArray(), abs=1e-6)
    assert got.intercept == pytest.approx(want.intercept, abs=1e-5)
    both = want.transform(series.frame).withColumnRenamed("prediction", "other")
    apart = got.transform(both).agg(F.max(F.abs(F.col("prediction") - F.col("other")))).first()[0]
    assert apart < 1e-5


def test_errors_without_a_scan(series):
    fit = ElasticNet(0.5)(series.frame.where("fold <> 1"))
    part = fold_moments(series.frame, 3)[1]
    scored = fit.transform(series.frame.where("fold = 1"))
    want = scored.agg(F.sqrt(F.avg(F.pow(F.col("n") - F.col("prediction"), 2)))).first()[0]
    assert part.rmse(fit) == pytest.approx(want)


def test_constant_features_and_labels(spark):
    flat = build_series(ramp(spark, JAN, [7] * 5))
    fit = ElasticNet(0.1, 1.0)(flat.frame)
    assert fit.intercept == 7 and list(fit.weights) == [0.0]
    one = build_series(events(spark, {("a", m): i + 1 for i, m in enumerate(months(JAN, 6))}), "doctor")
    fit = ElasticNet()(one.frame)
    assert fit.intercept == pytest.approx(0, abs=1e-9) and fit.weights == pytest.approx([1.0, 0.0])


def test_no_rows_and_wrong_penalties(series):
    with pytest.raises(ValueError, match="no rows"):
        ElasticNet()(series.frame.where("false"))
    for reg, elastic in ((-1, 0), (0, 2)):
        with pytest.raises(ValueError):
            ElasticNet(reg, elastic)


def test_the_best_penalty_wins(series):
    grid = [ElasticNet(p) for p in (1e5, 0.01, 0.0, 1e3)]
    tuned = tune_linear(series.frame, grid)
    assert tuned.best == grid[tuned.rmse.index(min(tuned.rmse))] and tuned.best.reg_param < 1
    assert tuned.model.weights == pytest.approx(tuned.best(series.frame).weights)


def test_poisson_as_spark(series):
    members = [F.col("fold") != 0, F.lit(True)]
    known = [moments(series.frame.where(m)) for m in members]
    got = fit_poisson(series.frame, members, known)
    for fit, member in zip(got, members):
        want = GeneralizedLinearRegression(family="poisson", tol=1e-12, **models.COLUMNS).fit(
            series.frame.where(member)
        )
        assert fit.coefficients.toArray() == pytest.approx(want.coefficients.toArray(), abs=1e-7)
        assert fit.intercept == pytest.approx(want.intercept, abs=1e-7)


@pytest.mark.parametrize("labels", [[0, 0, 0, 0, 1], [1, 10**6, 1, 1, 10**6], [5] * 5, [0, 0, 0, 0, 10**9]])
def test_poisson_converges_on_steep_data(spark, labels):
    df = spark.createDataFrame([(float(i), y) for i, y in enumerate(labels)], "id double, n long")
    fit = fit_poisson(df, [F.lit(True)], [moments(df)])[0]
    scored = fit.transform(df)
    # the score equations of the maximum: the residuals sum to zero, also weighted by the id
    miss = scored.agg(F.sum(F.col("n") - F.col("prediction")), F.sum(F.col("id") * (F.col("n") - F.col("prediction")))).first()
    assert max(map(abs, miss)) <= 1e-4 * max(labels)


def test_poisson_needs_a_label_above_zero(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "id double, n long")
    with pytest.raises(ValueError, match="above 0"):
        fit_poisson(df, [F.lit(True)], [moments(df)])


@pytest.mark.parametrize("by", [None, "doctor"])
@pytest.mark.parametrize("net, model", [
    (ElasticNet(), lambda df: models.linear(df, max_iter=1000)),
    (ElasticNet(2.0), lambda df: models.linear(df, 2.0, 0.0, 1000)),
])
def test_recursion_by_moments_as_by_fits(spark, by, net, model):
    rng = random.Random(8)
    counts = {(f"d{k}", m): rng.randint(1, 9) + 4 * k for k in range(4) for m in months(JAN, 14)}
    series = build_series(events(spark, counts), by)
    columns = ["Date", by] if by else ["Date"]
    got = forecast_recursive(series, 4, fit=net).orderBy(*columns).collect()
    want = forecast_recursive(series, 4, fit=model).orderBy(*columns).collect()
    assert got == want and len(got) == (16 if by else 4)


def test_recursion_scans_the_history_once(spark, series):
    """As many jobs for three years as for two months."""
    def jobs(horizon):
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"h{horizon}", "")
        forecast_recursive(series, horizon, fit=ElasticNet())
        found = tracker.getJobIdsForGroup(f"h{horizon}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(found)

    assert jobs(2) == jobs(36) > 0
