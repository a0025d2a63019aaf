import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from data import events, months, ramp
from monthtide.operators import models
from monthtide.operators.nested import NestedTree, score_cuts
from monthtide.operators.tuning import tune_tree
from monthtide.plans.training import build_series

JAN = dt.date(2015, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(11)
    counts = {
        (f"d{k}", m): rng.randint(1, 30) + 5 * k for k in range(12) for m in months(JAN, 30)
    }
    return build_series(events(spark, counts), "doctor")


def values(df):
    return {(r.category, r.id): r.prediction for r in df.select("category", "id", "prediction").collect()}


@pytest.mark.parametrize("depth", [0, 1, 3, 5, 7])
def test_a_cut_is_the_tree_of_that_depth(series, depth):
    deep = NestedTree.of(models.tree(series.frame, 7))
    alone = models.tree(series.frame, depth)
    assert values(deep.cut(depth).transform(series.frame)) == values(alone.transform(series.frame))
    assert deep.cut(depth).depth == alone.depth


def test_one_pass_scores_all_depths(series):
    deep = NestedTree.of(models.tree(series.frame, 6))
    scored = score_cuts(deep, series.frame, (2, 4, 6))
    for i, depth in enumerate((2, 4, 6)):
        one = scored.select("category", "id", F.col(f"prediction_{i}").alias("prediction"))
        assert values(one) == values(deep.cut(depth).transform(series.frame))


def test_equal_means_are_merged(spark):
    flat = build_series(ramp(spark, JAN, [7] * 9))
    tree = NestedTree.of(models.tree(flat.frame, 5))
    assert tree.depth == 0 and tree.leaf_means() == [7.0]


def test_not_deeper_than_grown(series):
    with pytest.raises(ValueError, match="grown"):
        NestedTree.of(models.tree(series.frame, 2)).cut(3)


@pytest.mark.parametrize("depths", [(2, 4), (4, 2), (3, 14)])
def test_depths_in_any_order_and_beyond_the_nested(series, depths):
    tuned = tune_tree(series.frame, series.bounds.last_id, series.bounds.categories, depths)
    chosen = depths[tuned.rmse.index(min(tuned.rmse))]
    assert tuned.model.depth <= chosen
    want = models.tree(series.frame, chosen)
    assert values(tuned.model.transform(series.frame)) == values(want.transform(series.frame))
