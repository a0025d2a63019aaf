"""Finishing of predicted numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column) -> Column:
    return F.round(value, 0)


def clamp_negative(value: Column) -> Column:
    """Negative and null to 0.0; NaN stays NaN."""
    return F.greatest(F.lit(0.0), value)
