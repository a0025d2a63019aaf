"""Replacing a file by a new one that is known to be whole.

A table is written beside its target, read back and counted, and only then put in the
target's place. A write that fails leaves the target as it was. Between taking the old one
away and putting the new one there, the old one waits under a name of its own; should the
job end right then, the next one finds it there. Renames are whole on file systems; on object
stores, where they copy, readers should wait for the job.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthtide.shared import hadoop

# Readers skip names that begin with an underscore.
STAGED, REPLACED = "_staged-", "_replaced-"


def publish(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write ``df`` with a header, if its format has one, replacing ``path``."""
    spark = df.sparkSession
    recover(spark, path)
    file_system, target = hadoop(spark, path)
    staged = _beside(target, STAGED)
    written = Observation()
    try:
        counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.format(fmt).option("header", True).save(staged)
        # values may hold line ends
        reader = spark.read.format(fmt).option("header", True).option("multiLine", True)
        found = reader.schema(df.schema).load(staged).count()
        if found != written.get["rows"]:
            raise OSError(f"{staged} has {found} rows, not the {written.get['rows']} written")
        _swap(spark, staged, path)
    finally:
        file_system.delete(hadoop(spark, staged)[1], True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back what a job took away from ``path`` and didn't replace. Was there any?"""
    file_system, target = hadoop(spark, path)
    parent = target.getParent()
    if file_system.exists(target) or parent is None or not file_system.exists(parent):
        return False
    prefix = f"{REPLACED}{target.getName()}-"
    left = [f.getPath() for f in file_system.listStatus(parent) if f.getPath().getName().startswith(prefix)]
    if not left:
        return False
    last = max(left, key=lambda p: file_system.getFileStatus(p).getModificationTime())
    return file_system.rename(last, target)


def _beside(target, prefix: str) -> str:
    name = f"{prefix}{target.getName()}-{uuid.uuid4().hex}"
    parent = target.getParent()
    return f"{parent.toString().rstrip('/')}/{name}" if parent is not None else name


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    file_system, target = hadoop(spark, path)
    _, new = hadoop(spark, staged)
    old = None
    if file_system.exists(target):
        _, old = hadoop(spark, _beside(target, REPLACED))
        if not file_system.rename(target, old):
            raise OSError(f"{path} cannot be replaced")
    if not file_system.rename(new, target):
        if old is not None:
            file_system.rename(old, target)
        raise OSError(f"{staged} cannot be renamed to {path}")
    if old is not None:
        file_system.delete(old, True)
