"""All future months at once from one fit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import DataFrame

from monthtide.operators.features import assemble
from monthtide.operators.future import check_horizon, future_frame
from monthtide.operators.tuning import PARALLELISM, tune_generalized_linear
from monthtide.plans.finish import finish
from monthtide.plans.training import MonthlySeries


def tuned_glr(training: DataFrame, parallelism: int = PARALLELISM) -> Model:
    return tune_generalized_linear(training, parallelism=parallelism).model


def forecast_direct(
    series: MonthlySeries,
    horizon: int,
    fit: Callable[[DataFrame], Model] = tuned_glr,
    clamp: bool = True,
) -> DataFrame:
    """Fit once, predict ``horizon`` months per category, round, clamp at zero."""
    check_horizon(horizon)
    with series.cached():
        model = fit(series.frame)
    future = future_frame(series.starts, series.bounds.last_month, series.bounds.last_id, horizon)
    return finish(model.transform(assemble(future)), series.by, clamp)
