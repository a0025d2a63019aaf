"""A whole forecast: read, predict, write."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession

from monthtide.functions.calendar import UTC
from monthtide.operators.future import check_horizon
from monthtide.operators.tuning import PARALLELISM
from monthtide.plans.direct import forecast_direct, tuned_glr
from monthtide.plans.recursive import forecast_recursive
from monthtide.plans.training import build_series
from monthtide.shared import scratch
from monthtide.sources.forecast_files import (
    direct_name,
    recursive_name,
    recursive_name_from_input,
    write_forecast,
)
from monthtide.sources.publish import publish
from monthtide.sources.tables import OVERALL, read_records, read_table, resolve_dimension

METHODS = ("recursive", "direct")


def run_forecast_job(
    spark: SparkSession,
    path: str,
    by: str = OVERALL,
    horizon: int = 3,
    save_path: str | None = None,
    method: str = "recursive",
    date_col: str | None = None,
    allowed: Iterable[str] | None = None,
    name_from_input: bool = False,
    required_in_path: Iterable[str] = (),
    null_category: str = "error",
    time_zone: str = UTC,
    fit: Callable[[DataFrame], Model] | None = None,
    parallelism: int = PARALLELISM,
    files: int | None = 1,
    work_dir: str | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """Forecast the rows of ``path`` and return ``Date, [<by>], prediction``.

    With ``save_path`` the forecast is also written below it as CSV, in ``files`` part files,
    and what is returned reads those. All arguments are checked before the first row is
    read. ``required_in_path`` are texts the input's path must contain, ``allowed`` the
    dimensions to accept (any column by default). ``fit`` takes the place of the tuned
    model, ``parallelism`` is the number of fits at a time. Records that cannot be counted raise,
    or with ``quarantine`` are written to that path as parquet (reason, file, record) and left out.

    The job's tables in the shared folder are removed at its end; only a forecast that
    isn't saved stays there, as one table, until the scope around the job ends.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    for text in required_in_path:
        if text not in path:
            raise ValueError(f"the input path must contain {text!r}: {path}")
    check_horizon(horizon)
    records = None if quarantine is None else read_records(spark, path, date_col)
    df = records.good if records else read_table(spark, path)
    column = resolve_dimension(df, by, allowed)
    if records:
        publish(records.bad, quarantine, "parquet")
    with (
        scratch(spark) as scope,
        build_series(df, column, date_col, null_category, time_zone, work_dir) as series,
    ):
        if method == "recursive":
            forecast = forecast_recursive(series, horizon, fit=fit, parallelism=parallelism)
        else:
            chosen = fit or (lambda training: tuned_glr(training, parallelism))
            forecast = forecast_direct(series, horizon, chosen)
        if save_path is None:
            return scope.keep(forecast, work_dir)
        if method == "direct":
            target = direct_name(by, horizon, save_path)
        elif name_from_input:
            target = recursive_name_from_input(by, horizon, path, save_path)
        else:
            target = recursive_name(by, horizon, save_path)
        write_forecast(forecast, target, files)
    return spark.read.schema(forecast.schema).option("header", True).csv(target)
