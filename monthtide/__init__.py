"""Monthly count forecasting on Spark."""

from monthtide.plans.direct import forecast_direct
from monthtide.plans.job import run_forecast_job
from monthtide.plans.recursive import forecast_recursive
from monthtide.plans.training import MonthlySeries, build_series

__all__ = [
    "MonthlySeries",
    "build_series",
    "forecast_direct",
    "forecast_recursive",
    "run_forecast_job",
]
