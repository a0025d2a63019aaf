"""Regressions of the monthly count ``n`` on ``features``."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
    IsotonicRegression,
    IsotonicRegressionModel,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.operators.features import MIN_BINS, assemble

if TYPE_CHECKING:
    from monthtide.operators.wide_trees import WideForest

COLUMNS = {"featuresCol": "features", "labelCol": "n"}
SEED = 17

# Fixed value: the deepest tree Spark ML grows.
MAX_DEPTH = 30

# With more bins than this, categories have them: every task would sum all of a node's, so that
# the sums grow with the square of the input. Such trees are grown by ``wide_trees``.
WIDE_FROM = 1_000


def linear(
    training: DataFrame, reg_param: float = 0.0, elastic_net: float = 0.0, max_iter: int = 100
) -> LinearRegressionModel:
    """Least squares; elastic_net 0.0 is ridge, 1.0 lasso."""
    return LinearRegression(
        regParam=reg_param, elasticNetParam=elastic_net, maxIter=max_iter, **COLUMNS
    ).fit(training)


def generalized_linear(
    training: DataFrame, family: str = "gaussian"
) -> GeneralizedLinearRegressionModel:
    return GeneralizedLinearRegression(family=family, **COLUMNS).fit(training)


def isotonic(training: DataFrame) -> IsotonicRegressionModel:
    """Non-decreasing fit on the month number.

    Rows of one month number are first merged to their mean with their count as
    weight, which leaves the fit unchanged. Spark pools the points of one month number
    in one task and the blocks on the driver, so this bounds both by the number of months.
    """
    merged = training.groupBy("id").agg(
        F.avg("n").alias("n"), F.count(F.lit(1)).cast("double").alias("weight")
    )
    return IsotonicRegression(weightCol="weight", featureIndex=0, **COLUMNS).fit(assemble(merged))


def check_depth(max_depth: int) -> int:
    if not 0 <= max_depth <= MAX_DEPTH:
        raise ValueError(f"a tree's depth is from 0 to {MAX_DEPTH}, not {max_depth}")
    return max_depth


def tree_estimator(max_depth: int = 5, max_bins: int = MIN_BINS) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        maxDepth=check_depth(max_depth), maxBins=max_bins, seed=SEED, **COLUMNS
    )


def is_wide(training: DataFrame, max_bins: int) -> bool:
    return max_bins > WIDE_FROM and "category_idx" in training.columns


def tree(
    training: DataFrame, max_depth: int = 5, max_bins: int = MIN_BINS
) -> DecisionTreeRegressionModel | WideForest:
    """Spark's tree, or with very many categories the same tree as tables."""
    if is_wide(training, max_bins):
        from monthtide.operators.wide_trees import wide_tree

        return wide_tree(training, max_depth)
    return tree_estimator(max_depth, max_bins).fit(training)


def forest(
    training: DataFrame,
    num_trees: int,
    max_depth: int = 5,
    max_bins: int = MIN_BINS,
    bootstrap: bool = True,
    feature_subset: str = "auto",
) -> RandomForestRegressionModel | WideForest:
    """Mean of trees on samples of the rows (``bootstrap``) and of the features per node.

    Without samples, and with very many categories, the same forest as tables.
    """
    if is_wide(training, max_bins) and not bootstrap and feature_subset == "all":
        from monthtide.operators.wide_trees import wide_forest

        return wide_forest(training, num_trees, max_depth, False, "all")
    return RandomForestRegressor(
        numTrees=num_trees,
        maxDepth=check_depth(max_depth),
        maxBins=max_bins,
        bootstrap=bootstrap,
        featureSubsetStrategy=feature_subset,
        seed=SEED,
        **COLUMNS,
    ).fit(training)


def coefficients(
    training: DataFrame, model: LinearRegressionModel | GeneralizedLinearRegressionModel
) -> DataFrame:
    """One row: ``intercept``, ``coef_id`` and, by category, ``coef_category``."""
    names = ["coef_id", "coef_category"][: len(model.coefficients)]
    values = [F.lit(float(v)).alias(c) for c, v in zip(names, model.coefficients)]
    one_row = training.sparkSession.range(1, numPartitions=1)
    return one_row.select(F.lit(float(model.intercept)).alias("intercept"), *values)
