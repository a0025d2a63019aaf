"""From dated rows to numbered monthly counts.

Every frame here uses the columns ``month``, ``category`` (when grouped), ``n``, ``id``.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.functions.calendar import UTC, event_date, month_start
from monthtide.functions.names import column_named


def monthly_counts(
    df: DataFrame, date_col: str, by: str | None = None, time_zone: str = UTC
) -> DataFrame:
    """Rows per month, or per month and category.

    By category only rows with a category are counted, so a null category makes a
    group with n = 0. The count is combined before the shuffle: at most months x
    categories rows leave a task, whatever the size or skew of the input.
    """
    month = month_start(event_date(df, date_col, time_zone)).alias("month")
    if by is None:
        return df.select(month).groupBy("month").agg(F.count("month").alias("n"))
    category = column_named(by).alias("category")
    if not isinstance(df.schema[by].dataType, T.IntegralType):
        category = category.cast("string").alias("category")
    counts = (
        df.select(month, category)
        .groupBy("month", "category")
        .agg(F.count("category").alias("n"))
    )
    # Whole numbers are grouped as such and only the groups turned into text.
    return counts.withColumn("category", F.col("category").cast("string"))


def number_months(counts: DataFrame) -> DataFrame:
    """Number the months 1, 2, ... in which the (sub)series has rows.

    Runs on counts, so a window holds at most one row per calendar month.
    """
    if "category" in counts.columns:
        window = Window.partitionBy("category").orderBy("month")
    else:
        window = Window.orderBy("month")
    return counts.withColumn("id", F.row_number().over(window))


def holdout(
    series: DataFrame,
    test_after: dt.date,
    train_before: dt.date | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training months before one cut, test months after another.

    The cuts are independent: they may overlap, and without ``train_before`` the
    whole series trains. Filter after numbering, or the months would be renumbered.
    """
    test = series.where(F.col("month") > F.lit(test_after))
    if train_before is None:
        return series, test
    return series.where(F.col("month") < F.lit(train_before)), test


def categories(series: DataFrame, *extra: str) -> DataFrame:
    """Each category once. Month number 1 exists once per category: no shuffle."""
    return series.where(F.col("id") == 1).select("category", *extra)


class Bounds(NamedTuple):
    last_month: dt.date
    last_id: int
    rows: int
    categories: int
    null_categories: int


def bounds_frame(series: DataFrame) -> DataFrame:
    """Last month, highest month number and sizes in one aggregate."""
    return series.agg(*bounds_columns(series))


def bounds_columns(series: DataFrame) -> list[Column]:
    """The aggregates of ``Bounds``, which may also be observed while a table is written."""
    grouped = "category" in series.columns
    first = F.col("id") == 1
    return [
        F.max("month").alias("last_month"),
        F.max("id").cast("int").alias("last_id"),
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(first, 1)).alias("categories"),
        (F.count(F.when(F.col("category").isNull(), 1)) if grouped else F.lit(0).cast("bigint"))
        .alias("null_categories"),
    ]


def series_bounds(series: DataFrame) -> Bounds:
    row = bounds_frame(series).first()
    return Bounds(*row)
