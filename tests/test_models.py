import datetime as dt
import random

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from data import events, months, ramp
from monthtide.operators import models
from monthtide.operators.features import bin_count
from monthtide.operators.metrics import metrics
from monthtide.plans.training import build_series

JAN = dt.date(2015, 1, 1)


@pytest.fixture(scope="module")
def by_doctor(spark):
    rng = random.Random(5)
    ms = months(JAN, 20)
    counts = {
        (f"d{k}", m): rng.randint(1, 9) + i // 4
        for k in range(6) for i, m in enumerate(ms) if rng.random() < 0.8
    }
    return build_series(events(spark, counts), "doctor")


def predictions(model, series):
    rows = model.transform(series.frame).select("category", "id", "prediction").collect()
    return {(r.category, r.id): r.prediction for r in rows}


def test_isotonic_of_merged_rows_is_isotonic_of_all_rows(by_doctor):
    merged = predictions(models.isotonic(by_doctor.frame), by_doctor)
    plain = IsotonicRegression(featuresCol="features", labelCol="n").fit(by_doctor.frame)
    assert merged == pytest.approx(predictions(plain, by_doctor))


def test_tree_predicts_the_mean_of_its_leaf(by_doctor):
    series = by_doctor
    model = models.tree(series.frame, 7, bin_count(series.bounds.last_id, series.bounds.categories))
    leaves = model.setLeafCol("leaf").transform(series.frame).groupBy("leaf").agg(
        F.avg("n").alias("mean"), F.min("prediction").alias("lo"), F.max("prediction").alias("hi")
    )
    rows = leaves.collect()
    assert len(rows) > 10
    for r in rows:
        assert r.mean == pytest.approx(r.lo) == pytest.approx(r.hi)


def test_forest_predicts_within_the_labels(by_doctor):
    model = models.forest(by_doctor.frame, 10, 3)
    assert model.getNumTrees == 10 and model.totalNumNodes > 10
    values = predictions(model, by_doctor).values()
    top = by_doctor.frame.agg(F.max("n")).first()[0]
    assert 1 <= min(values) < max(values) <= top


@pytest.mark.parametrize("depth", [31, 99, -1])
def test_no_tree_is_that_deep(by_doctor, depth):
    with pytest.raises(ValueError, match="depth"):
        models.tree(by_doctor.frame, depth)
    with pytest.raises(ValueError, match="depth"):
        models.forest(by_doctor.frame, 2, depth)
    assert models.tree_estimator(30).getMaxDepth() == 30


def test_forest_of_all_rows_is_the_tree(by_doctor):
    forest = models.forest(by_doctor.frame, 4, 3, bootstrap=False, feature_subset="all")
    want = predictions(models.tree(by_doctor.frame, 3), by_doctor)
    assert predictions(forest, by_doctor) == pytest.approx(want)


def test_exact_line(spark):
    series = build_series(ramp(spark, JAN, [3 + 2 * i for i in range(1, 13)]))
    row = models.coefficients(series.frame, models.linear(series.frame)).first()
    assert (row.intercept, row.coef_id) == pytest.approx((3.0, 2.0))
    scores = metrics(models.linear(series.frame).transform(series.frame))
    assert scores == pytest.approx((0.0, 0.0, 1.0), abs=1e-9)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "n double, prediction double")
    assert metrics(df) == pytest.approx((4 / 3, (10 / 3) ** 0.5, 1 - 10 / 8))


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_partitioning_of_the_input_changes_nothing(spark, partitions):
    rng = random.Random(9)
    counts = {(f"d{k}", m): rng.randint(1, 9) for k in range(4) for m in months(JAN, 15)}
    df = events(spark, counts)
    want = build_series(df.coalesce(1), "doctor")
    got = build_series(df.repartition(partitions, F.rand(partitions)), "doctor")
    for fit in (
        lambda f: models.forest(f, 5, 4),
        lambda f: models.tree(f, 5),
        lambda f: models.generalized_linear(f, "poisson"),
    ):
        assert predictions(fit(got.frame), got) == predictions(fit(want.frame), want)
