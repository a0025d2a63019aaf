"""One future month at a time, each prediction joining the next fit."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.operators.features import assemble
from monthtide.operators.future import check_horizon, feedback_union, future_frame
from monthtide.operators.moments import (
    LABEL,
    ElasticNet,
    LinearFit,
    feature_columns,
    moment_columns,
    predicted_moments,
    read_moments,
)
from monthtide.operators.tuning import PARALLELISM, TREE_DEPTHS, add_fold, tune_tree
from monthtide.plans.finish import finish
from monthtide.plans.training import MonthlySeries, lay_out


def forecast_recursive(
    series: MonthlySeries,
    horizon: int,
    clamp: bool = False,
    depths: tuple[int, ...] = TREE_DEPTHS,
    fit: Callable[[DataFrame], Model] | ElasticNet | None = None,
    parallelism: int = PARALLELISM,
) -> DataFrame:
    """Step k fits a model on the history and the unrounded prediction of step k-1.

    ``fit`` makes a model of the training rows; without it, a tree of one of ``depths`` is
    chosen by cross-validation, ``parallelism`` fits at a time. A tree holds sets of
    categories, so with very many of them a linear ``fit`` is the better choice. An
    ``ElasticNet`` needs no training rows, only their moments: the history is scanned once,
    whatever the horizon.

    Earlier predictions are not kept in the training rows. Month numbers and dates of
    each step follow from the history's bounds, and a prediction needs only the
    categories and that step's model, so the lineage does not grow with the steps. The
    training rows of a step are laid out by their keys and kept in memory for its fits.
    """
    check_horizon(horizon)
    if isinstance(fit, ElasticNet):
        return finish(_from_moments(series, horizon, fit), series.by, clamp)
    bounds = series.bounds

    def tuned(training: DataFrame, step: int) -> Model:
        last_id = bounds.last_id + step - 1
        return tune_tree(training, last_id, bounds.categories, depths, parallelism).model

    steps: list[DataFrame] = []
    training = series.frame
    for step in range(1, horizon + 1):
        training = training.persist()
        try:
            model = fit(training) if fit else tuned(training, step)
        finally:
            training.unpersist()
        future = future_frame(
            series.starts, bounds.last_month, bounds.last_id, horizon=1, first_step=step
        )
        predicted = model.transform(assemble(future)).drop("features")
        steps.append(predicted)
        rows = bounds.rows + bounds.categories
        union = feedback_union(series.frame, predicted)
        training = add_fold(assemble(lay_out(union, rows, series.rows_per_partition)))
    return finish(reduce(DataFrame.unionByName, steps), series.by, clamp)


def _from_moments(series: MonthlySeries, horizon: int, net: ElasticNet) -> DataFrame:
    """All months' predictions. A step's moments are the history's and the last month's."""
    names = feature_columns(series.rows)
    columns, bounds = [*names, LABEL], series.bounds
    row = series.rows.agg(
        *moment_columns(columns),
        *moment_columns(columns, F.col("id") == 1, "start_"),
    ).first()
    history = read_moments(row, len(columns))
    starts = read_moments(row, len(columns), "start_")
    fits: list[LinearFit] = []
    training = history
    for step in range(1, horizon + 1):
        fits.append(net.solve(training))
        training = history + predicted_moments(fits[-1], bounds.last_id + step, starts)
    future = future_frame(series.starts, bounds.last_month, bounds.last_id, horizon)
    step = (F.col("id") - bounds.last_id).cast("int")

    def of_step(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), step)

    value = of_step([f.intercept for f in fits])
    for i, name in enumerate(names):
        value = value + of_step([f.weights[i] for f in fits]) * F.col(name)
    return future.withColumn("prediction", value)
