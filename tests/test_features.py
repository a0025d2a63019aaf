import datetime as dt

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from data import events, months
from monthtide.operators import features
from monthtide.operators.features import (
    assemble,
    bin_count,
    category_index,
    index_range,
    rank_rows,
    with_active_months,
)
from monthtide.operators.future import feedback_union, future_frame
from monthtide.operators.models import tree
from monthtide.operators.series import monthly_counts, number_months, series_bounds
from monthtide.plans.training import build_series

JAN = dt.date(2015, 1, 1)


def gappy(spark, n_categories):
    ms = months(JAN, 6)
    return events(
        spark,
        {(f"c{k:02d}", m): 1 + k % 3 for k in range(n_categories) for m in ms[: 1 + k % 6]},
    )


def test_index_equals_string_indexer(spark):
    numbered = number_months(monthly_counts(gappy(spark, 40), "removal_date", "doctor"))
    series = with_active_months(numbered)
    index = category_index(series, series_bounds(series))
    want = StringIndexer(inputCol="category", outputCol="i").fit(numbered).transform(numbered)
    assert {(r.category, r.category_idx) for r in index.collect()} == {
        (r.category, r.i) for r in want.select("category", "i").collect()
    }


def test_distributed_rank(spark):
    value = F.hash("id").cast("long") * 8192 + F.col("id")
    df = spark.range(5000, numPartitions=7).select(value.alias("v"))
    ranked = rank_rows(df, [F.col("v").desc()], "rank")
    rows = sorted(ranked.collect(), key=lambda r: -r.v)
    assert [r["rank"] for r in rows] == list(range(5000))


def metadata(df):
    return df.schema["category_idx"].metadata.get("ml_attr")


def test_index_stays_nominal(spark):
    """Losing the mark would make trees split the index as a number."""
    series = build_series(gappy(spark, 8), "doctor")
    want = {"type": "nominal", "name": "category_idx", "num_vals": 8}
    assert metadata(series.frame) == want
    future = future_frame(series.starts, series.bounds.last_month, series.bounds.last_id, 1)
    assert metadata(future) == want
    fed_back = feedback_union(series.frame, future.withColumn("prediction", F.lit(1.5)))
    assert metadata(fed_back) == want
    assert metadata(fed_back.checkpoint()) == want
    model = tree(assemble(fed_back), 3, 32)
    assert "in {" in model.toDebugString
    assert metadata(index_range(series.frame, 0, 3))["num_vals"] == 3


@pytest.mark.parametrize(
    ("max_id", "n", "bins"),
    [(10, 31, 32), (10, 32, 32), (10, 33, 33), (10, 34, 34), (32, 1, 32), (33, 1, 34), (80, 5, 81)],
)
def test_bin_count(max_id, n, bins):
    assert bin_count(max_id, n) == bins


@pytest.mark.parametrize("n", [32, 33, 34])
def test_trees_at_the_bin_boundary(spark, n):
    series = build_series(gappy(spark, n), "doctor")
    model = tree(series.frame, 3, bin_count(series.bounds.last_id, n))
    assert model.transform(series.frame).count() == series.bounds.rows


@pytest.mark.parametrize("last", [dt.date(2015, 12, 1), dt.date(2016, 1, 1)])
def test_future_months_roll_over(spark, last):
    start = spark.range(1).select()
    rows = sorted(future_frame(start, last, 5, 36).collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [float(5 + i) for i in range(1, 37)]
    assert [r.month for r in rows] == months(last, 37)[1:]


def test_the_series_is_indexed_in_as_many_parts_as_its_rows_ask_for(spark, monkeypatch):
    """Its files are small, so Spark would broadcast the series and index it in one task."""
    monkeypatch.setattr(features, "JOINED_ROWS", 20, raising=False)
    series = build_series(gappy(spark, 60), "doctor")
    assert series.bounds.rows > 100
    parts = series.rows.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(parts) > 4 and max(r["count"] for r in parts) < series.bounds.rows / 2
