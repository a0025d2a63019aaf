"""Parameter grids and k-fold cross-validation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.operators.features import bin_count
from monthtide.operators.metrics import rmse
from monthtide.operators.models import COLUMNS, is_wide, tree_estimator
from monthtide.operators.moments import (
    ElasticNet,
    LinearFit,
    Moments,
    feature_columns,
    fold_moments,
    outside,
)
from monthtide.operators.nested import NestedTree, score_cuts
from monthtide.operators.poisson import fit_poisson
from monthtide.operators.wide_trees import WideForest, in_arrays, wide_folds

# Folds and the swept parameters.
FOLDS = 3
TREE_DEPTHS = (3, 5, 7)
GLR_FAMILIES = ("gaussian", "poisson")

# Fits that run at the same time.
PARALLELISM = 9

# The nodes of trees up to this depth are read on the driver.
NESTED_DEPTH = 12


@dataclass
class Tuned:
    model: Model | NestedTree | WideForest | LinearFit
    best: dict[Param, object] | ElasticNet
    grid: list[dict[Param, object]] | list[ElasticNet]
    rmse: list[float]


def least(means: list[float]) -> int:
    """The place of the least mean, the first on a tie, NaN never."""
    return min(range(len(means)), key=lambda i: (math.isnan(means[i]), means[i]))


def add_fold(df: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Fold of each row, from its month number and category only.

    Random folds would depend on how the rows are partitioned.
    """
    key = F.col("id").cast("long")
    if "category_idx" in df.columns:
        key = key + F.col("category_idx").cast("long")
    return df.withColumn("fold", F.pmod(key, F.lit(folds)).cast("int"))


def cross_validate(
    estimator: Estimator,
    grid: list[dict[Param, object]],
    data: DataFrame,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    min_training_rows: int = 1,
) -> Tuned:
    """Least mean RMSE over the folds wins, the first on a tie, NaN never; refit on all rows.

    ``data`` has ``fold`` and should be cached; counting its folds fills the cache before
    the fits start, and raises when they are too small. The fits of all folds and parameters
    run at the same time, and one pass per fold scores all its models. (Spark's own
    cross-validator checks a fold column with a Python UDF on every row.)
    """

    def fit(task: tuple[int, int]) -> Model:
        fold, i = task
        model = estimator.fit(data.where(F.col("fold") != fold), grid[i])
        return model.setPredictionCol(f"prediction_{i}")

    def score(fold_models: tuple[int, list[Model]]) -> list[float]:
        fold, models = fold_models
        held_out = data.where(F.col("fold") == fold)
        for model in models:
            held_out = model.transform(held_out)
        return list(
            held_out.agg(
                *(rmse(F.col("n"), F.col(f"prediction_{i}")) for i in range(len(grid)))
            ).first()
        )

    check_folds(data, folds, min_training_rows)
    spark = data.sparkSession
    tasks = [(k, i) for k in range(folds) for i in range(len(grid))]
    with ThreadPoolExecutor(min(parallelism, len(tasks))) as pool:
        fitted = list(pool.map(inheritable_thread_target(spark)(fit), tasks))
        by_fold = [(k, fitted[k * len(grid) : (k + 1) * len(grid)]) for k in range(folds)]
        scores = list(pool.map(inheritable_thread_target(spark)(score), by_fold))
    means = [sum(s[i] for s in scores) / folds for i in range(len(grid))]
    best = grid[least(means)]
    return Tuned(estimator.fit(data, best), best, grid, means)


def check_folds(data: DataFrame, folds: int, min_training_rows: int) -> None:
    in_fold = [F.count(F.when(F.col("fold") == k, 1)).alias(f"fold_{k}") for k in range(folds)]
    check_fold_sizes(data.agg(*in_fold).first(), folds, min_training_rows)


def check_fold_sizes(counts: Sequence[float], folds: int, min_training_rows: int) -> None:
    fewest = sum(counts) - max(counts)
    if fewest < min_training_rows:
        raise ValueError(
            f"a fold has {fewest:.0f} training rows, too few for a model that needs "
            f"{min_training_rows}"
        )
    if min(counts) == 0:
        raise ValueError(f"too few months for {folds} folds")


def tune_tree(
    data: DataFrame,
    max_id: int,
    n_categories: int,
    depths: tuple[int, ...] = TREE_DEPTHS,
    parallelism: int = PARALLELISM,
) -> Tuned:
    """Decision tree, its depth chosen by cross-validation.

    A tree has at most as many bins as training rows, and needs one per category. One tree of
    the greatest depth is fitted without each fold and one on all rows, all at the same time;
    what the trees of the other depths predict is read off them. With many categories these are
    wide trees: the bins of Spark's, all of which every task sums for every node, would grow with
    the square of the input.
    """
    estimator = tree_estimator()
    grid = (
        ParamGridBuilder()
        .baseOn({estimator.maxBins: bin_count(max_id, n_categories)})
        .addGrid(estimator.maxDepth, list(depths))
        .build()
    )
    if is_wide(data, bin_count(max_id, n_categories)):
        check_folds(data, FOLDS, n_categories)
        return tune_wide_tree(data, depths, grid)
    if max(depths) > NESTED_DEPTH:
        return cross_validate(
            estimator, grid, data, parallelism=parallelism, min_training_rows=n_categories
        )
    folds = range(FOLDS)
    deepest = grid[max(range(len(depths)), key=lambda i: depths[i])]

    def fit(fold: int) -> NestedTree:
        rows = data if fold == FOLDS else data.where(F.col("fold") != fold)
        return NestedTree.of(estimator.fit(rows, deepest))

    def score(fold: int) -> list[float]:
        scored = score_cuts(trees[fold], data.where(F.col("fold") == fold), depths)
        errors = [rmse(F.col("n"), F.col(f"prediction_{i}")) for i in range(len(depths))]
        return list(scored.agg(*errors).first())

    check_folds(data, FOLDS, n_categories)
    spark = data.sparkSession
    with ThreadPoolExecutor(min(parallelism, FOLDS + 1)) as pool:
        trees = list(pool.map(inheritable_thread_target(spark)(fit), [*folds, FOLDS]))
        scores = list(pool.map(inheritable_thread_target(spark)(score), folds))
    means = [sum(s[i] for s in scores) / FOLDS for i in range(len(depths))]
    best = least(means)
    return Tuned(trees[FOLDS].cut(depths[best]), grid[best], grid, means)


def tune_wide_tree(
    data: DataFrame, depths: Sequence[int], grid: list[dict[Param, object]]
) -> Tuned:
    """The trees without each fold and on all rows grow together, and are read at each depth."""
    trees = wide_folds(data, max(depths), FOLDS)
    n, fold = F.col("of.n"), F.col("of.fold")
    if in_arrays(trees.trees, trees.depth):
        # a row goes down the tree of its own fold only
        scored = trees.walked(data, depths, F.array("fold"))
        errors = [rmse(n, F.get(f"means_{i}", F.lit(0))).alias(f"rmse_{i}") for i in range(len(depths))]
        by_fold = scored.groupBy(fold.alias("fold")).agg(*errors).collect()
    else:
        by_fold = [
            {
                f"rmse_{i}": trees.one(k, depth)
                .transform(data.where(F.col("fold") == k))
                .agg(rmse(F.col("n"), F.col("prediction")))
                .first()[0]
                for i, depth in enumerate(depths)
            }
            for k in range(FOLDS)
        ]
    means = [sum(r[f"rmse_{i}"] for r in by_fold) / FOLDS for i in range(len(depths))]
    best = least(means)
    return Tuned(trees.one(FOLDS, depths[best]), grid[best], grid, means)


def tune_generalized_linear(
    data: DataFrame,
    families: tuple[str, ...] = GLR_FAMILIES,
    parallelism: int = PARALLELISM,
) -> Tuned:
    """Generalized linear regression, its family chosen by cross-validation.

    The gaussian fits and errors follow from the moments of each fold, one scan for all. The
    Poisson fits of all folds and of all rows share each of their steps' scans.
    """
    estimator = GeneralizedLinearRegression(**COLUMNS)
    grid = ParamGridBuilder().addGrid(estimator.family, list(families)).build()
    if not set(families) <= set(GLR_FAMILIES):
        return cross_validate(estimator, grid, data, parallelism=parallelism)
    parts, sets = training_moments(data)
    fits: dict[str, list[LinearFit]] = {}
    scores: dict[str, list[float]] = {}
    if "gaussian" in families:
        fits["gaussian"] = [ElasticNet().solve(m) for m in sets]
        scores["gaussian"] = [p.rmse(f) for p, f in zip(parts, fits["gaussian"])]
    if "poisson" in families:
        members = [F.col("fold") != k for k in range(FOLDS)] + [F.lit(True)]
        fits["poisson"] = fit_poisson(data, members, sets)
        names = [F.col(c) for c in feature_columns(data)]
        errors = [
            rmse(F.when(F.col("fold") == k, F.col("n")), fits["poisson"][k].value(*names))
            for k in range(FOLDS)
        ]
        scores["poisson"] = list(data.agg(*errors).first())
    means = [sum(scores[family]) / FOLDS for family in families]
    best = least(means)
    return Tuned(fits[families[best]][FOLDS], grid[best], grid, means)


def tune_linear(data: DataFrame, grid: Sequence[ElasticNet]) -> Tuned:
    """Linear regression, its penalties chosen by cross-validation, from one scan."""
    parts, sets = training_moments(data)
    means = [
        sum(p.rmse(net.solve(m)) for p, m in zip(parts, sets)) / FOLDS for net in grid
    ]
    best = grid[least(means)]
    return Tuned(best.solve(sets[FOLDS]), best, list(grid), means)


def training_moments(data: DataFrame) -> tuple[list[Moments], list[Moments]]:
    """The moments of each fold; and of the rows outside each, then of all rows."""
    parts = fold_moments(data, FOLDS)
    check_fold_sizes([p.rows for p in parts], FOLDS, 1)
    return parts, [outside(parts, k) for k in range(FOLDS + 1)]
