"""Writing forecasts as CSV."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from monthtide.sources.publish import publish
from monthtide.sources.tables import OVERALL

# Fixed values below: the names of forecast files.


def recursive_name(by: str, horizon: int, save_path: str | None = None) -> str:
    """``Prediction_<by>_<horizon>.csv`` below ``save_path``; overall is lower case."""
    label = OVERALL if by.lower() == OVERALL else by
    return os.path.join(save_path or "", f"Prediction_{label}_{horizon}.csv")


def recursive_name_from_input(
    by: str, horizon: int, input_path: str, save_path: str | None = None
) -> str:
    """Named after the input file, up to the first dot of its base name.

    The overall forecast puts ``overall`` before the input's name, a forecast by
    column puts the column after it.
    """
    stem = os.path.basename(input_path.rstrip("/")).split(".")[0]
    if by.lower() == OVERALL:
        name = f"Prediction_{OVERALL}_{stem}_{horizon}.csv"
    else:
        name = f"Prediction_{stem}_{by}_{horizon}.csv"
    return os.path.join(save_path or "", name)


def direct_name(by: str, horizon: int, save_path: str | None = None) -> str:
    """``prediction_<by>_<horizon>``, ``by`` spelled as the caller gave it."""
    return os.path.join(save_path or "", f"prediction_{by}_{horizon}")


def write_forecast(
    forecast: DataFrame,
    path: str,
    files: int | None = 1,
) -> None:
    """CSV with a header, sorted by date and category; once whole, it replaces ``path``.

    ``files`` part files, one by default; None leaves the number to Spark. Each file is
    sorted, and with more than one they follow each other.
    """
    keys = forecast.columns[:-1]
    if files == 1:
        # repartition, not coalesce: the predicting stays parallel, one task writes.
        laid_out = forecast.repartition(1)
    elif files is None:
        laid_out = forecast.repartitionByRange(*keys)
    else:
        laid_out = forecast.repartitionByRange(files, *keys)
    publish(laid_out.sortWithinPartitions(*keys), path)


def write_parts(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Any format by name, one file per partition; once whole, they replace ``path``."""
    publish(df, path, fmt)
