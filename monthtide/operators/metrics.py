"""Errors of a prediction, all in one aggregate."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Metrics(NamedTuple):
    mae: float
    rmse: float
    r2: float


def mae(label: Column, prediction: Column) -> Column:
    return F.avg(F.abs(label - prediction))


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(label - prediction, F.lit(2))))


def r2(label: Column, prediction: Column) -> Column:
    squared_error = F.sum(F.pow(label - prediction, F.lit(2)))
    return 1 - squared_error / (F.count(label) * F.var_pop(label))


def metrics_frame(predicted: DataFrame, label: str = "n") -> DataFrame:
    """One row ``mae, rmse, r2`` over rows with ``prediction``."""
    y, p = F.col(label), F.col("prediction")
    return predicted.agg(mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), r2(y, p).alias("r2"))


def metrics(predicted: DataFrame, label: str = "n") -> Metrics:
    return Metrics(*metrics_frame(predicted, label).first())
