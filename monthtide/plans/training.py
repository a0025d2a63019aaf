"""Training series: counted, numbered, indexed and laid out for the fits."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation

from monthtide.functions.calendar import UTC
from monthtide.functions.names import column_named
from monthtide.operators.features import (
    add_category_index,
    assemble,
    category_index,
    with_active_months,
)
from monthtide.operators.series import Bounds, bounds_columns, monthly_counts, number_months
from monthtide.operators.tuning import add_fold
from monthtide.plans.finish import OUTPUT_COLUMNS
from monthtide.shared import Workspace
from monthtide.sources.tables import require_date_column, resolve_dimension

ROWS_PER_PARTITION = 20_000


@dataclass
class MonthlySeries:
    """The numbered, indexed monthly counts and their bounds.

    ``rows`` has ``month, [category], n, id, [category_idx]``. ``starts`` is what a forecast
    starts from: each category with its index once, or one empty row. ``by`` is the table's
    name of the category column, None overall. Used as a context, the series removes its
    tables from the shared folder at the end; nothing derived from it may be read later.
    """

    rows: DataFrame
    starts: DataFrame
    by: str | None
    bounds: Bounds
    work: Workspace
    rows_per_partition: int = ROWS_PER_PARTITION

    @cached_property
    def frame(self) -> DataFrame:
        """``rows`` laid out for fits, with ``features`` and ``fold``.

        Laid out once, as a table: fits and predictions read that.
        """
        placed = self.work.settle(lay_out(self.rows, self.bounds.rows, self.rows_per_partition))
        return add_fold(assemble(placed))

    def __enter__(self) -> MonthlySeries:
        return self

    def __exit__(self, *_: object) -> None:
        self.work.remove()

    @contextmanager
    def cached(self) -> Iterator[MonthlySeries]:
        """Keep the frames in memory while fits read them."""
        self.frame.persist()
        self.starts.persist()
        try:
            yield self
        finally:
            self.frame.unpersist()
            self.starts.unpersist()


def build_series(
    df: DataFrame,
    by: str | None = None,
    date_col: str | None = None,
    null_category: str = "error",
    time_zone: str = UTC,
    work_dir: str | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> MonthlySeries:
    """One scan of the raw rows; everything after it works on the counts.

    ``null_category`` "error" raises on rows without a category, "drop" leaves them out.
    ``time_zone`` gives points in time their date. ``work_dir`` is a folder all executors
    share, by default that of ``spark.checkpoint.dir``.
    """
    if null_category not in ("error", "drop"):
        raise ValueError(f"null_category must be 'error' or 'drop', not {null_category!r}")
    column = resolve_dimension(df, by)
    day = require_date_column(df, date_col)
    if column == day:
        raise ValueError(f"{day!r} is the date column, not a dimension")
    if column is not None and column.lower() in OUTPUT_COLUMNS:
        raise ValueError(f"rename {column!r}: the forecast has a column of that name itself")
    if column is not None and null_category == "drop":
        df = df.where(column_named(column).isNotNull())
    numbered = number_months(monthly_counts(df, day, column, time_zone))
    if column is not None:
        numbered = with_active_months(numbered)
    # The bounds are taken while the table is written.
    work, seen = Workspace(df.sparkSession, work_dir), Observation()
    counted = work.settle(numbered.observe(seen, *bounds_columns(numbered)))
    bounds = Bounds(**seen.get)
    if not bounds.rows:
        raise ValueError("the table has no rows to count")
    if column is None:
        starts = df.sparkSession.range(1, numPartitions=1).select()
        indexed = counted
    else:
        starts = category_index(counted, bounds, work)
        indexed = add_category_index(counted, starts, bounds)
    return MonthlySeries(indexed, starts, column, bounds, work, rows_per_partition)


def lay_out(series: DataFrame, rows: int, rows_per_partition: int) -> DataFrame:
    """Same rows in the same partitions and order, however the input was partitioned.

    Forests sample per partition, and sums of doubles depend on their order. The keys
    are unique, so no partition is larger than the others.
    """
    keys = ["category_idx", "id"] if "category_idx" in series.columns else ["id"]
    partitions = 1 + rows // rows_per_partition
    return series.repartition(partitions, *keys).sortWithinPartitions(*keys)
