import datetime as dt

import pytest
from pyspark.sql import functions as F

from data import events, months, ramp
from monthtide.operators.series import (
    categories,
    holdout,
    monthly_counts,
    number_months,
    series_bounds,
)
from monthtide.plans.direct import forecast_direct
from monthtide.plans.training import build_series
from monthtide.shared import scratch_path, settle, shared_dir

JAN = dt.date(2015, 1, 1)


def test_null_category_is_a_group_of_zero(spark):
    df = events(spark, {("a", JAN): 2, (None, JAN): 3})
    rows = {r.category: r.n for r in monthly_counts(df, "removal_date", "doctor").collect()}
    assert rows == {"a": 2, None: 0}


def test_months_are_numbered_by_occurrence(spark):
    ms = months(JAN, 6)
    df = events(spark, {("a", ms[0]): 1, ("a", ms[4]): 1, ("b", ms[3]): 2})
    numbered = number_months(monthly_counts(df, "removal_date", "doctor"))
    got = {(r.category, r.month): r.id for r in numbered.collect()}
    assert got == {("a", ms[0]): 1, ("a", ms[4]): 2, ("b", ms[3]): 1}
    bounds = series_bounds(numbered)
    assert bounds == (ms[4], 2, 3, 2, 0)
    assert sorted(r.category for r in categories(numbered).collect()) == ["a", "b"]


def test_holdout_cuts_are_independent(spark):
    series = number_months(monthly_counts(ramp(spark, JAN, [1] * 12), "removal_date"))
    train, test = holdout(series, dt.date(2015, 8, 2), dt.date(2015, 10, 2))
    assert train.count() == 10 and test.count() == 4
    assert sorted(r.id for r in test.collect()) == [9, 10, 11, 12]
    train, test = holdout(series, dt.date(2015, 8, 2))
    assert train.count() == 12 and test.count() == 4


def test_a_category_with_most_rows(spark):
    """One key holding nearly all rows is combined before the shuffle."""
    df = spark.range(200_000, numPartitions=8).select(
        F.expr("date_add(date'2015-01-01', cast(id % 700 as int))").alias("removal_date"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("d"), F.col("id") % 1000))
        .otherwise("hot").alias("doctor"),
    )
    counts = monthly_counts(df, "removal_date", "doctor")
    total = counts.groupBy("category").agg(F.sum("n").alias("n"))
    assert total.where("category = 'hot'").first().n == 196_000
    assert total.agg(F.sum("n")).first()[0] == 200_000
    assert build_series(df, "doctor").frame.agg(F.sum("n")).first()[0] == 200_000


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint"])
def test_whole_number_categories_become_text(spark, kind):
    df = ramp(spark, JAN, [2, 1]).withColumn("ward", F.lit(7).cast(kind))
    rows = monthly_counts(df, "removal_date", "ward").collect()
    assert {r.category for r in rows} == {"7"}


def test_odd_column_names(spark):
    names = {"removal_date": "Removal Date", "doctor": "a.b (c, `d)"}
    series = build_series(ramp(spark, JAN, [2, 1] * 4).withColumnsRenamed(names), "A.B (C, `D)")
    assert series.frame.agg(F.sum("n")).first()[0] == 12
    forecast = settle(forecast_direct(series, 2))
    assert forecast.columns == ["Date", "a.b (c, `d)", "prediction"] and forecast.count() == 2


def test_null_category_raises_or_is_dropped(spark):
    df = events(spark, {("a", JAN): 2, (None, JAN): 3})
    with pytest.raises(ValueError, match="nulls"):
        build_series(df, "doctor")
    assert build_series(df, "doctor", null_category="drop").bounds.rows == 1
    with pytest.raises(ValueError):
        build_series(df, "doctor", null_category="keep")


def test_empty_table_raises(spark):
    with pytest.raises(ValueError, match="no rows"):
        build_series(ramp(spark, JAN, [1]).where("false"))


def test_shared_folder_is_the_sessions(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
