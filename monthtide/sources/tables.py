"""Reading dated records and finding their columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.functions.calendar import try_date_text
from monthtide.functions.names import column_named

OVERALL = "overall"


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, every column text.

    With ``columns`` (the header's names, in order) the schema is given and no job is needed to
    read the header; else that of one file is read. A file with another header, or the same names
    in another order, raises when it is read.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by its suffix, CSV otherwise."""
    if is_parquet(path):
        return spark.read.parquet(path)
    return read_csv(spark, path)


def is_parquet(path: str) -> bool:
    return path.rstrip("/").endswith(".parquet")


@dataclass(frozen=True)
class Records:
    """Rows that can be counted, and the others: ``reason, file, record``."""

    good: DataFrame
    bad: DataFrame


# Fixed value: why a record cannot be counted.
MALFORMED, NO_DATE, NOT_A_DATE = "malformed row", "no date", "not a date"


def read_records(spark: SparkSession, path: str, date_col: str | None = None) -> Records:
    """The rows of a table, those set aside that would stop a forecast.

    These are lines that have not as many fields as the header, and rows whose date is missing
    or, as text, not ``dd/MM/yyyy``. Each is kept as text, with its file.
    """
    text, place = "_monthtide_line", "_monthtide_file"
    df = read_table(spark, path)
    names = df.columns
    if not is_parquet(path):
        fields = [T.StructField(c, T.StringType()) for c in [*names, text]]
        reader = spark.read.option("header", True).option("enforceSchema", False)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", text)
        # a line is judged by all its fields, whichever are asked for
        reader = reader.option("columnPruning", False)
        df = reader.schema(T.StructType(fields)).csv(path)
    else:
        df = df.withColumn(text, F.lit(None).cast("string"))
    day = require_date_column(df.select(*map(column_named, names)), date_col)
    value = column_named(day)
    if isinstance(df.schema[day].dataType, T.StringType):
        missing = value.isNull() | (F.trim(value) == "")
        wrong = try_date_text(value).isNull()
    else:
        missing, wrong = value.isNull(), F.lit(False)
    reason = (
        F.when(F.col(text).isNotNull(), MALFORMED)
        .when(missing, NO_DATE)
        .when(wrong, NOT_A_DATE)
    )
    judged = df.withColumn(place, F.col("_metadata.file_path")).withColumn("_monthtide_reason", reason)
    own = [column_named(c) for c in names]
    good = judged.where("_monthtide_reason is null").select(*own)
    as_is = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    record = F.coalesce(F.col(text), F.to_csv(F.struct(*own), as_is))
    bad = judged.where("_monthtide_reason is not null").select(
        F.col("_monthtide_reason").alias("reason"), F.col(place).alias("file"), record.alias("record")
    )
    return Records(good, bad)


def find_date_column(columns: Iterable[str]) -> str:
    """First column whose name contains ``date`` in any case; '' if there is none."""
    return next((c for c in columns if "date" in c.lower()), "")


def require_date_column(df: DataFrame, override: str | None = None) -> str:
    if override is not None:
        return resolve_column(df, override)
    found = find_date_column(df.columns)
    if not found:
        raise ValueError("no column name contains the word 'date'")
    return found


def resolve_column(df: DataFrame, name: str) -> str:
    """The table's own spelling of ``name``, matched in any case."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"{name!r} is not one of the columns {df.columns}")


def resolve_dimension(
    df: DataFrame, by: str | None, allowed: Iterable[str] | None = None
) -> str | None:
    """Column to forecast by, or None for the overall count.

    ``allowed`` limits the choice (any case); by default every column may be used.
    """
    if allowed is not None:
        choices = [a.lower() for a in allowed]
        if (by or OVERALL).lower() not in choices:
            raise ValueError(f"unknown dimension {by!r}, expected one of {choices}")
    if by is None or by.lower() == OVERALL:
        return None
    return resolve_column(df, by)
