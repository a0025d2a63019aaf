"""Columns by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
