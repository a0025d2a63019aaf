"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def months(first: dt.date, count: int) -> list[dt.date]:
    at = first.year * 12 + first.month - 1
    return [dt.date(k // 12, k % 12 + 1, 1) for k in range(at, at + count)]


def events(spark: SparkSession, counts: dict[tuple[str | None, dt.date], int]) -> DataFrame:
    """One row per event: ``removal_date`` within the month, ``doctor``."""
    rows = [
        (month + dt.timedelta(days=i % 28), category)
        for (category, month), n in counts.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "removal_date date, doctor string")


def ramp(spark: SparkSession, first: dt.date, counts: list[int]) -> DataFrame:
    return events(spark, {("x", m): n for m, n in zip(months(first, len(counts)), counts)})
