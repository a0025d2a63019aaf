"""Dates and months as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.functions.names import column_named

# The day/month/year layout of date texts.
DATE_TEXT_FORMAT = "d/M/yyyy"
DATE_TEXT_PATTERN = r"^\d{1,2}/\d{1,2}/\d{4}$"

UTC = "UTC"


def try_date_text(text: Column) -> Column:
    """``dd/MM/yyyy`` text to a date, null if it is none."""
    return F.when(text.rlike(DATE_TEXT_PATTERN), F.try_to_date(text, DATE_TEXT_FORMAT))


def parse_date_text(text: Column) -> Column:
    """``dd/MM/yyyy`` text to a date; one-digit days and months are accepted.

    Anything else, null and empty text included, raises.
    """
    problem = F.concat(
        F.lit("not a dd/MM/yyyy date: "), F.coalesce(text, F.lit("null"))
    )
    return F.coalesce(try_date_text(text), F.raise_error(problem).cast("date"))


def event_date(df: DataFrame, name: str, time_zone: str = UTC) -> Column:
    """Date of each row, from a text, date or timestamp column. Null raises.

    A timestamp that is a point in time has its date in ``time_zone``, whatever the zone
    of the session; one without a zone has its own.
    """
    column = column_named(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_date_text(column)
    if isinstance(kind, T.TimestampType):
        there = F.from_utc_timestamp(column, time_zone)
        column = F.date_from_unix_date(F.floor(F.unix_seconds(there) / 86_400).cast("int"))
    return F.coalesce(
        column.cast("date"), F.raise_error(F.lit(f"null in date column {name}")).cast("date")
    )


def month_key(day: Column) -> Column:
    """Date to the integer yyyyMM."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_key_to_date(key: Column) -> Column:
    """Integer yyyyMM to the first day of that month."""
    return F.make_date(F.floor(key / 100).cast("int"), (key % 100).cast("int"), F.lit(1))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")
