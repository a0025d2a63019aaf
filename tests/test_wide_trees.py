import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from data import events, months, ramp
from monthtide.operators import models, wide_trees
from monthtide.operators.features import bin_count
from monthtide.operators.wide_trees import poisson_steps, poisson_weight, uniform, wide_forest, wide_tree
from monthtide.plans.recursive import forecast_recursive
from monthtide.plans.training import build_series

JAN = dt.date(2015, 1, 1)


def make(spark, seed, categories, n_months, share=0.8):
    rng = random.Random(seed)
    counts = {
        (f"d{k}", m): rng.randint(1, 40) + 3 * (k % 7) + i // 2
        for k in range(categories) for i, m in enumerate(months(JAN, n_months)) if rng.random() < share
    }
    return build_series(events(spark, counts), "doctor")


@pytest.fixture(scope="module")
def series(spark):
    return make(spark, 3, 40, 30)


def values(df):
    rows = df.select("category", "id", "prediction").collect()
    out = {(r.category, r.id): r.prediction for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("ranged_from", [200_000, 0])
@pytest.mark.parametrize("depth", [0, 1, 4, 7])
def test_as_sparks_tree(monkeypatch, series, depth, ranged_from):
    """Rows that the tree has not seen go the same way too."""
    monkeypatch.setattr(wide_trees, "RANGED_FROM", ranged_from)
    train = series.frame.where("id < 20 and category_idx <> 5")
    spark_tree = models.tree(train, depth, bin_count(series.bounds.last_id, 40))
    want = values(spark_tree.transform(series.frame))
    assert values(wide_tree(train, depth).transform(series.frame)) == pytest.approx(want)


def test_overall(spark):
    series = build_series(ramp(spark, JAN, [5, 9, 9, 2, 7, 7, 7, 30, 1, 4]))
    want = models.tree(series.frame, 4).transform(series.frame).orderBy("id").collect()
    got = wide_tree(series.frame, 4).transform(series.frame).orderBy("id").collect()
    assert [r.prediction for r in got] == pytest.approx([r.prediction for r in want])
    assert set(got[0].asDict()) == set(want[0].asDict())


def test_more_categories_than_bins(spark):
    """Three thousand categories, which Spark's tree would need as many bins for."""
    rows = [(f"c{k:04d}", float(k), m, (k * 7919) % 13 + m) for k in range(3000) for m in (1, 2)]
    df = spark.createDataFrame(rows, "category string, category_idx double, id int, n long")
    model = wide_tree(df, 6)
    predicted = model.transform(df)
    errors = predicted.agg(F.avg(F.pow(F.col("n") - F.col("prediction"), 2)), F.var_pop("n")).first()
    assert errors[0] < 0.02 * errors[1]
    # the sets of categories are rows of a table, at most all of them at each level
    assert model.lefts.count() <= 6 * 3000


def test_leaves_predict_their_mean(series):
    model = wide_tree(series.frame, 3)
    predicted = model.transform(series.frame)
    for r in predicted.groupBy("prediction").agg(F.avg("n").alias("mean")).collect():
        assert r.mean == pytest.approx(r.prediction)


def test_a_forest_does_not_depend_on_partitions(spark, series):
    want = values(wide_forest(series.frame.coalesce(1), 5, 3).transform(series.frame))
    got = wide_forest(series.frame.repartition(7, F.rand(1)), 5, 3).transform(series.frame.repartition(3))
    assert values(got) == pytest.approx(want)
    other = wide_forest(series.frame, 5, 3, seed=1).transform(series.frame)
    assert values(other) != pytest.approx(want)


def test_a_forest_of_all_rows_and_features_is_the_tree(series):
    want = values(wide_tree(series.frame, 3).transform(series.frame))
    got = wide_forest(series.frame, 3, 3, bootstrap=False, feature_subset="all").transform(series.frame)
    assert values(got) == pytest.approx(want)


def test_a_forest_in_plain_python(spark):
    """Depth 1: each tree's best cut of its one feature, worked out by hand."""
    series = make(spark, 9, 6, 8)
    rows = [(r.category, r.category_idx, r.id, r.n) for r in series.frame.collect()]

    def chance(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32

    ids = sorted({r[2] for r in rows})
    total = {(r[0], r[2]): 0.0 for r in rows}
    trees = 8
    for tree in range(trees):
        drawn = [(r, sum(chance(17, tree, r[0], r[2]) >= s for s in poisson_steps())) for r in rows]
        drawn = [(r, w) for r, w in drawn if w]
        by_month = chance(17, tree, 1, "feature") < 0.5
        groups = {}
        for r, w in drawn:
            groups.setdefault(r[2] if by_month else r[1], []).append((r[3], w))
        mean = lambda x: sum(n * w for n, w in x) / sum(w for _, w in x)
        order = sorted(groups, key=lambda v: (v if by_month else mean(groups[v]), 0 if by_month else v))
        loss = lambda x: sum(w * (n - mean(x)) ** 2 for n, w in x)
        flat = lambda vs: [x for v in vs for x in groups[v]]
        best = min(range(1, len(order)), key=lambda k: round(loss(flat(order[:k])) + loss(flat(order[k:])), 9))
        assert loss(flat(order[:best])) + loss(flat(order[best:])) < loss(flat(order))
        if by_month:
            last = order[best - 1]
            cut = (last + ids[ids.index(last) + 1]) / 2
            goes_left = lambda r: r[2] <= cut
        else:
            lefts = set(order[:best])
            goes_left = lambda r: r[1] in lefts
        for r in rows:
            total[r[0], r[2]] += mean(flat(order[:best] if goes_left(r) else order[best:])) / trees
    got = values(wide_forest(series.frame, trees, 1).transform(series.frame))
    assert got == pytest.approx(total)


def test_weights_are_poisson(spark):
    n = 200_000
    weight = poisson_weight(uniform(F.lit(3), F.col("id")))
    row = spark.range(n).select(weight.alias("w")).agg(
        F.avg("w"), F.var_pop("w"), F.avg((F.col("w") == 0).cast("int")), F.max("w")
    ).first()
    assert row[0] == pytest.approx(1, abs=0.01) and row[1] == pytest.approx(1, abs=0.02)
    assert row[2] == pytest.approx(0.36788, abs=0.005) and 6 <= row[3] <= 13


def test_recursive_forecast_with_wide_trees(series):
    want = forecast_recursive(series, 2, depths=(4,)).orderBy("Date", "doctor").collect()
    got = forecast_recursive(series, 2, fit=lambda df: wide_tree(df, 4)).orderBy("Date", "doctor").collect()
    assert got == want


def test_wrong_arguments_and_no_rows(series):
    for call in (lambda: wide_tree(series.frame, 31), lambda: wide_forest(series.frame, 0),
                 lambda: wide_forest(series.frame, 1, feature_subset="some"),
                 lambda: wide_tree(series.frame.where("false"), 2)):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("packed", [(7, 2048), (2, 2048), (0, 0)])
def test_a_forest_by_arrays_or_joins(monkeypatch, series, packed):
    """Rows stay whole, with their places in all trees, down to a level of the depth that is told."""
    want = values(wide_forest(series.frame, 4, 4).transform(series.frame))
    monkeypatch.setattr(wide_trees, "PACKED_DEPTH", packed[0])
    monkeypatch.setattr(wide_trees, "PACKED_NODES", packed[1])
    assert values(wide_forest(series.frame, 4, 4).transform(series.frame)) == pytest.approx(want)


def test_rows_of_a_category_stay_together(series):
    """A task sums all of a category's rows; the rows are not written or dealt anew at each level."""
    planted = wide_trees._planted(series.frame, F.array_repeat(F.lit(1.0), 3), True, 4)
    assert planted.count() == series.frame.count()
    places = planted.select("key", F.spark_partition_id().alias("part")).distinct()
    assert places.count() == planted.select("key").distinct().count()


def test_sparks_tree_and_forest_with_very_many_bins(monkeypatch, series):
    bins = bin_count(series.bounds.last_id, 40)
    train = series.frame.where("id < 20")
    want = values(models.tree(train, 4, bins).transform(series.frame))
    monkeypatch.setattr(models, "WIDE_FROM", 30)
    tree, forest = models.tree(train, 4, bins), models.forest(train, 3, 4, bins, False, "all")
    assert isinstance(tree, wide_trees.WideForest) and isinstance(forest, wide_trees.WideForest)
    assert values(tree.transform(series.frame)) == pytest.approx(want)
    assert values(forest.transform(series.frame)) == pytest.approx(want)
    assert not isinstance(models.forest(train, 2, 2, bins), wide_trees.WideForest)
