"""Category index, feature vector and bin count."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthtide.operators.series import Bounds, categories
from monthtide.shared import Workspace

# Fixed value: the fewest bins a tree uses.
MIN_BINS = 32
# Rows of the series that one task joins with the index.
JOINED_ROWS = 200_000


def rank_rows(
    df: DataFrame, order: list[Column], name: str, work: Workspace | None = None
) -> DataFrame:
    """Add the 0-based position in ``order``, which must have no ties.

    Range-partitioned sort, settled so that the positions cannot change; then each
    partition starts where the ones before it end.
    """
    work = work or Workspace(df.sparkSession)
    placed = work.settle(
        df.orderBy(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition, so at most spark.sql.shuffle.partitions rows.
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    position = F.col("_start") + F.col("_at") - F.shiftleft("_part", 33)
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, position)
        .drop("_at", "_part", "_start")
    )


def with_active_months(series: DataFrame) -> DataFrame:
    """Add the number of months of each category, in the window of the month number."""
    return series.withColumn(
        "active_months", F.count(F.lit(1)).over(Window.partitionBy("category"))
    )


def nominal(column: Column, name: str, n_values: int) -> Column:
    """Mark a column as a category index, so that trees split it as a set."""
    attribute = {"ml_attr": {"type": "nominal", "name": name, "num_vals": max(n_values, 1)}}
    return column.alias(name, metadata=attribute)


def category_index(series: DataFrame, bounds: Bounds, work: Workspace | None = None) -> DataFrame:
    """``category, category_idx``: 0 for the category active in most months.

    Ties are in category order; a null category raises. ``series`` has
    ``active_months``. No category passes through the driver.
    """
    if bounds.null_categories:
        raise ValueError("the category column has nulls; drop them or fill them first")
    ranked = rank_rows(
        categories(series, "active_months"),
        [F.desc("active_months"), F.asc("category")],
        "category_idx",
        work,
    )
    index = F.col("category_idx").cast("double")
    return ranked.select("category", nominal(index, "category_idx", bounds.categories))


def add_category_index(series: DataFrame, index: DataFrame, bounds: Bounds) -> DataFrame:
    """Join the index onto the series, both dealt by category.

    A category has at most one row a month, so no part is hot. The parts are as many as the rows
    ask for: by the size of its files, which are packed, Spark would take the whole series for
    small, broadcast it and pass its rows on in one task.
    """
    parts = 1 + bounds.rows // JOINED_ROWS
    dealt = series.drop("active_months").repartition(parts, "category")
    return dealt.join(index.repartition(parts, "category").hint("merge"), "category")


def index_range(indexed: DataFrame, low: float, high: float) -> DataFrame:
    """Rows of the categories with ``low <= category_idx < high``.

    The index is marked anew with the fewer values left, as a tree needs a row for each.
    """
    index = F.col("category_idx")
    others = [c for c in indexed.columns if c not in ("category_idx", "features")]
    kept = indexed.where((index >= low) & (index < high)).select(
        *others, nominal(index, "category_idx", math.ceil(high))
    )
    return assemble(kept)


def assemble(df: DataFrame) -> DataFrame:
    """Add ``features``: [id], or [id, category_idx] by category."""
    inputs = ["id", "category_idx"] if "category_idx" in df.columns else ["id"]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)


def bin_count(max_id: int, n_categories: int) -> int:
    """Bins a tree needs to tell all month numbers and all categories apart.

    A series has at most months x categories rows, so never more than the square of this,
    up to which Spark looks for splits in all rows and not in a sample.
    """
    if max(max_id, n_categories) <= MIN_BINS:
        return MIN_BINS
    return max(max_id, n_categories - 1) + 1
