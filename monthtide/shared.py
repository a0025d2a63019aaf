"""Durable intermediate results in the folder the cluster shares."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The scope that tables settled from here on belong to.
_scope: ContextVar[Workspace | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession, work_dir: str | None = None) -> str:
    """Folder all executors can reach: ``work_dir``, or what ``spark.checkpoint.dir`` names.

    Only a local-mode session without that setting uses a temporary folder, one for the
    whole process and gone with it. The session's settings are left as they are.
    """
    sc = spark.sparkContext
    folder = work_dir or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_dir()
    return folder


@functools.cache
def _local_dir() -> str:
    folder = tempfile.mkdtemp(prefix="monthtide-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str, work_dir: str | None = None) -> str:
    """A new path in the shared folder.

    What is written there is removed at the end of the scope it was made in, see ``scratch``,
    and of the application at the latest.
    """
    path = f"{shared_dir(spark, work_dir).rstrip('/')}/monthtide/{name}-{uuid.uuid4().hex}"
    file_system, at = hadoop(spark, path)
    file_system.deleteOnExit(at)
    scope = _scope.get()
    if scope is not None:
        scope.paths.append(path)
    return path


def hadoop(spark: SparkSession, path: str):
    """A path's file system and the path itself, whatever kind of store it is in."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def settle(df: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Compute ``df`` once, as a table in the shared folder, and read that from here on.

    Used right after the scan of the raw rows, so that neither the many fits that
    follow nor the loss of an executor scans them again.
    """
    path = scratch_path(df.sparkSession, "settled", work_dir)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Settled tables that go together once nothing reads them any more."""

    def __init__(self, spark: SparkSession, work_dir: str | None = None):
        self.spark, self.paths = spark, []
        self.work_dir = work_dir

    def settle(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "settled", self.work_dir)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Remove the tables, on whatever file system they are."""
        while self.paths:
            file_system, at = hadoop(self.spark, self.paths.pop())
            file_system.delete(at, True)
            file_system.cancelDeleteOnExit(at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Workspace]:
    """All tables settled inside go at the end, whoever settled them.

    A result that is to outlive them is written inside, or settled with the scope's ``keep``.
    Scopes may be nested. Tables that other threads settle belong to no scope.
    """
    scope = _Scope(spark, _scope.get())
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        scope.remove()


class _Scope(Workspace):
    def __init__(self, spark: SparkSession, outer: Workspace | None):
        super().__init__(spark)
        self.outer = outer

    def keep(self, df: DataFrame, work_dir: str | None = None) -> DataFrame:
        """``df`` as a table that belongs to the scope around this one, if there is one."""
        token = _scope.set(self.outer)
        try:
            return settle(df, work_dir)
        finally:
            _scope.reset(token)
