"""Registered queries against their SQL, and the plans they run."""

import pytest
from oracle_check import connect, difference

import __spark_entry__ as contract
from monthtide.functions.names import column_named
from monthtide.operators.series import monthly_counts
from monthtide.plans.training import build_series
from monthtide.registry.queries import category_series, table

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert difference(spark, QUERIES[name], SQL[name], tables, SF_DIR) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["Date", "prediction"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_it_counts(spark):
    df = QUERIES["month_index_by_category"](spark, SF_DIR)
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan(df)
    df = QUERIES["csv_monthly_counts_by_priority"](spark, SF_DIR)
    assert "ReadSchema: struct<removal_date:string,priority:string>" in plan(df)


@pytest.mark.parametrize("by", [None, "l_suppkey"])
def test_plans_have_no_python_and_no_cross_join(spark, by):
    series = build_series(table(spark, SF_DIR, "lineitem"), by, "l_shipdate")
    for df in (series.frame, series.starts):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_raw_rows_are_scanned_once(spark):
    """Everything after the counts reads the settled series."""
    series = category_series(spark, SF_DIR, "supplier")
    for df in (series.frame, series.starts):
        assert "lineitem" not in plan(df) and "monthtide/settled" in plan(df)


def test_dropping_nulls_reaches_the_scan(spark):
    df = table(spark, SF_DIR, "orders")
    kept = df.where(column_named("o_orderpriority").isNotNull())
    counts = monthly_counts(kept, "o_orderdate", "o_orderpriority")
    assert "PushedFilters: [IsNotNull(o_orderpriority)]" in plan(counts)


def test_preview_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["forecast_preview"](spark, SF_DIR))
