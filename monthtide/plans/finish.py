"""From predictions to the forecast users see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.functions.numeric import clamp_negative, round_half_up


# The columns of a forecast beside the category, and the sentence below.
OUTPUT_COLUMNS = ("date", "prediction")


def finish(predicted: DataFrame, by: str | None, clamp: bool) -> DataFrame:
    """``Date, [<by>], prediction``: rounded first, then clamped if asked."""
    value: Column = round_half_up(F.col("prediction"))
    if clamp:
        value = clamp_negative(value)
    category = [] if by is None else [F.col("category").alias(by)]
    return predicted.select(F.col("month").alias("Date"), *category, value.alias("prediction"))


def preview(forecast: DataFrame, rows: int) -> DataFrame:
    """First rows in order of date and category; a top-k, not a full sort."""
    return forecast.orderBy(*[c for c in forecast.columns if c != "prediction"]).limit(rows)


def forecast_lines(forecast: DataFrame) -> DataFrame:
    """One sentence per forecast row, column ``line``."""
    return forecast.select(
        F.format_string(
            "Prediction for %d-%d is %d",
            F.month("Date"),
            F.year("Date"),
            F.col("prediction").cast("bigint"),
        ).alias("line")
    )
