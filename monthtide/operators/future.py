"""Months to predict, and predictions as training rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_horizon(horizon: int) -> int:
    if horizon < 1:
        raise ValueError("the horizon must be at least one month")
    return horizon


def future_frame(
    start: DataFrame,
    last_month: dt.date,
    last_id: int,
    horizon: int,
    first_step: int = 1,
) -> DataFrame:
    """``id, month`` of the next months, for every row of ``start``.

    ``start`` is one row per category, or one empty row for the overall series. Each row
    is exploded in place, so the product of categories and months needs no join.
    """
    steps = F.sequence(F.lit(first_step), F.lit(first_step + check_horizon(horizon) - 1))
    return start.select("*", F.explode(steps).alias("step")).select(
        *start.columns,
        (F.lit(last_id) + F.col("step")).cast("double").alias("id"),
        F.add_months(F.lit(last_month), F.col("step")).alias("month"),
    )


def feedback_union(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """History plus predictions as training rows: label and id become doubles."""
    columns = [c for c in ("month", "category", "category_idx", "id") if c in history.columns]
    label = F.col("n").cast("double").alias("n")
    typed = [F.col(c).cast("double").alias(c) if c == "id" else F.col(c) for c in columns]
    return history.select(*typed, label).unionByName(
        predicted.withColumnRenamed("prediction", "n").select(*typed, label)
    )
