"""Helpers that all operators share: column names, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthtide.shared import settle

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["Sealed", "ascii_lower", "batches_of", "seal", "settle", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written inside sends that many rows at a time to Python: for rows that are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass(frozen=True)
class Sealed:
    """A table under internal column names, so that no column of the caller can clash.

    ``frame`` has the columns ``_c0``, ``_c1``, ... in the caller's order.
    """

    frame: DataFrame
    names: list[str]

    def column(self, name: str) -> str:
        """The internal name of a column, by its exact name or else by its name in any case."""
        for same in (lambda x: x == name, lambda x: x.lower() == name.lower()):
            for i, x in enumerate(self.names):
                if same(x):
                    return f"_c{i}"
        raise ValueError(f"no column {name!r} among {self.names}")

    def restore(self, frame: DataFrame) -> DataFrame:
        """The caller's columns of a frame that still has the internal ones."""
        kept = frame.select(*[f"_c{i}" for i in range(len(self.names))])
        return kept.toDF(*self.names)


def seal(frame: DataFrame) -> Sealed:
    return Sealed(frame.toDF(*[f"_c{i}" for i in range(len(frame.columns))]), list(frame.columns))
