"""The registered queries: every operator over the whole given tables.

``orders.o_orderdate`` and ``lineitem.l_shipdate`` are the event dates; priority,
status, return flag and supplier are the categories.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthtide.functions.calendar import (
    event_date,
    month_key,
    month_key_to_date,
    month_start,
    parse_date_text,
)
from monthtide.functions.numeric import clamp_negative, round_half_up
from monthtide.operators import models
from monthtide.operators.features import (
    add_category_index,
    bin_count,
    category_index,
    index_range,
    with_active_months,
)
from monthtide.operators.future import feedback_union, future_frame
from monthtide.operators.metrics import mae, metrics_frame, r2, rmse
from monthtide.operators.moments import ElasticNet
from monthtide.operators.series import (
    bounds_frame,
    holdout,
    monthly_counts,
    number_months,
    series_bounds,
)
from monthtide.operators.tuning import tune_generalized_linear, tune_linear, tune_tree
from monthtide.operators.wide_trees import wide_forest, wide_tree
from monthtide.plans.direct import forecast_direct
from monthtide.plans.finish import forecast_lines, preview
from monthtide.plans.job import run_forecast_job
from monthtide.plans.recursive import forecast_recursive
from monthtide.plans.training import MonthlySeries, build_series
from monthtide.shared import scratch_path, settle
from monthtide.sources.forecast_files import (
    direct_name,
    recursive_name,
    recursive_name_from_input,
    write_forecast,
    write_parts,
)
from monthtide.sources.tables import read_csv, read_records

Query = Callable[[SparkSession, str], DataFrame]

HORIZON = 3
TEST_AFTER = dt.date(2000, 4, 2)
TRAIN_BEFORE = dt.date(2000, 6, 2)
RIDGE_PENALTIES = (0.0, 0.01, 1.0, 100.0)

# category role -> table, date column, category column
ROLES = {
    "priority": ("orders", "o_orderdate", "o_orderpriority"),
    "status": ("orders", "o_orderdate", "o_orderstatus"),
    "returnflag": ("lineitem", "l_shipdate", "l_returnflag"),
    "supplier": ("lineitem", "l_shipdate", "l_suppkey"),
}

_REGISTERED: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _REGISTERED[name] = function
        return function

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def overall_series(spark: SparkSession, sf_dir: str) -> MonthlySeries:
    return build_series(table(spark, sf_dir, "orders"), None, "o_orderdate")


def category_series(spark: SparkSession, sf_dir: str, role: str) -> MonthlySeries:
    name, day, column = ROLES[role]
    return build_series(table(spark, sf_dir, name), column, day)


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


def tree_bins(series: MonthlySeries) -> int:
    return bin_count(series.bounds.last_id, series.bounds.categories)


# --- sources and sinks -------------------------------------------------------------


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text columns with dd/MM/yyyy dates."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("removal_date"),
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.col("o_orderstatus").alias("specialty"),
        F.col("o_orderpriority").alias("priority"),
    )


def orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_texts(spark, sf_dir)
    path = scratch_path(spark, "orders-csv")
    write_parts(texts, path)
    return read_csv(spark, path, texts.columns)


@query("csv_scan")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_csv(spark, sf_dir)


@query("csv_reordered_header")
def csv_reordered_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns in another order, found by the file's own header."""
    texts = order_texts(spark, sf_dir)
    path = scratch_path(spark, "orders-csv")
    write_parts(texts.select(*reversed(texts.columns)), path)
    return read_csv(spark, path).select(texts.columns)


def torn_orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """A file in which some lines lack fields, and some dates are missing or no dates."""
    kind = F.col("order_key").cast("long") % 50
    day = F.when(kind == 0, "31/02/1999").when(kind == 1, "").otherwise(F.col("removal_date"))
    whole = F.concat_ws(",", day, "order_key", "specialty", "priority")
    line = F.when(kind == 2, F.concat_ws(",", day, "order_key")).otherwise(whole)
    texts = order_texts(spark, sf_dir)
    path = f"{scratch_path(spark, 'torn')}/orders.csv"
    lines = texts.select(line.alias("value")).repartition(1)
    header = spark.range(1, numPartitions=1).select(F.lit(",".join(texts.columns)).alias("value"))
    header.union(lines).coalesce(1).write.text(path)
    return path


@query("csv_quarantine")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records can be counted, and how many cannot for which reason."""
    records = read_records(spark, torn_orders_csv(spark, sf_dir))
    good = records.good.select(F.lit("good").alias("kind"))
    return good.union(records.bad.select("reason")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("csv_monthly_counts_by_priority")
def csv_monthly_counts_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_counts(orders_csv(spark, sf_dir), "removal_date", "priority")


@query("csv_sink_roundtrip")
def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = ols_forecast_overall(spark, sf_dir)
    path = scratch_path(spark, "forecast-csv")
    write_forecast(forecast, path)
    return spark.read.schema(forecast.schema).option("header", True).csv(path)


@query("generic_sink_roundtrip")
def generic_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = monthly_counts_by_supplier(spark, sf_dir)
    path = scratch_path(spark, "counts-csv")
    write_parts(counts, path)
    return spark.read.schema(counts.schema).option("header", True).csv(path)


# --- scalar functions --------------------------------------------------------------


@query("parse_month_key")
def parse_month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_texts(spark, sf_dir).select(
        "order_key", month_key(parse_date_text(F.col("removal_date"))).alias("month_key")
    )


@query("month_key_to_date")
def month_key_to_first_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = month_key(event_date(orders, "o_orderdate"))
    return orders.select("o_orderkey", month_key_to_date(key).alias("month"))


@query("truncate_to_month")
def truncate_to_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", month_start(event_date(lines, "l_shipdate")).alias("month")
    )


@query("round_half_up")
def round_to_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        round_half_up(balance).alias("whole"),
        round_half_up(F.floor(balance) + 0.5).alias("whole_of_half"),
    )


@query("clamp_negative")
def clamp_negative_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        clamp_negative(F.col("c_acctbal")).alias("clamped"),
        clamp_negative(F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal"))).alias(
            "clamped_or_zero"
        ),
    )


# --- counts, numbering, bounds -----------------------------------------------------


@query("monthly_counts")
def monthly_counts_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_counts(table(spark, sf_dir, "orders"), "o_orderdate")


def counts_by(role: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    name, day, column = ROLES[role]
    return monthly_counts(table(spark, sf_dir, name), day, column)


@query("monthly_counts_by_priority")
def monthly_counts_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by("priority", spark, sf_dir)


@query("monthly_counts_by_status")
def monthly_counts_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by("status", spark, sf_dir)


@query("monthly_counts_by_returnflag")
def monthly_counts_by_returnflag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by("returnflag", spark, sf_dir)


@query("monthly_counts_by_supplier")
def monthly_counts_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by("supplier", spark, sf_dir)


@query("monthly_counts_null_category")
def monthly_counts_null_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of status P have no category here: their months appear with n = 0."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return monthly_counts(orders, "o_orderdate", "status")


@query("month_index_overall")
def month_index_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_months(monthly_counts_overall(spark, sf_dir))


@query("month_index_by_category")
def month_index_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_months(monthly_counts_by_supplier(spark, sf_dir))


@query("sparse_month_index_by_customer")
def sparse_month_index_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many categories, each missing from most months."""
    orders = table(spark, sf_dir, "orders")
    return number_months(monthly_counts(orders, "o_orderdate", "o_custkey"))


@query("series_bounds")
def bounds_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounds_frame(month_index_overall(spark, sf_dir))


@query("series_bounds_by_category")
def bounds_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounds_frame(month_index_by_category(spark, sf_dir))


@query("distinct_categories")
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_series(spark, sf_dir, "supplier").starts


@query("bin_count")
def bin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("overall", tree_bins(overall_series(spark, sf_dir)))]
    rows += [(role, tree_bins(category_series(spark, sf_dir, role))) for role in ROLES]
    return spark.createDataFrame(rows, "series string, bins int")


@query("holdout_split")
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping cuts: months between them are in both parts."""
    series = month_index_overall(spark, sf_dir)
    train, test = holdout(series, TEST_AFTER, TRAIN_BEFORE)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("index_range_filter")
def index_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "supplier")
    return index_range(series.rows, 0.0, 2.0).select(
        "month", "category", "n", "id", "category_idx"
    )


# --- features and future frames ----------------------------------------------------


@query("category_index")
def category_index_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_series(spark, sf_dir, "supplier").rows.select(
        "month", "category", "n", "id", "category_idx"
    )


@query("category_index_by_customer")
def category_index_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    sparse = settle(with_active_months(sparse_month_index_by_customer(spark, sf_dir)))
    bounds = series_bounds(sparse)
    index = category_index(sparse, bounds)
    return add_category_index(sparse, index, bounds).select("month", "category", "id", "category_idx")


@query("feature_vector")
def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = vector_to_array("features")
    return category_series(spark, sf_dir, "priority").frame.select(
        "month", "category", features[0].alias("f_id"), features[1].alias("f_category")
    )


@query("future_frame_overall")
def future_frame_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = overall_series(spark, sf_dir)
    return future_frame(series.starts, series.bounds.last_month, series.bounds.last_id, 36)


@query("future_frame_by_category")
def future_frame_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "supplier")
    return future_frame(series.starts, series.bounds.last_month, series.bounds.last_id, 12)


@query("feedback_union")
def feedback_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and one month of predictions; here each predicts its last month number."""
    series = category_series(spark, sf_dir, "priority")
    future = future_frame(series.starts, series.bounds.last_month, series.bounds.last_id, 1)
    return feedback_union(series.frame, future.withColumn("prediction", F.col("id") + 0.25))


# --- regressions -------------------------------------------------------------------


def rounded_coefficients(series: MonthlySeries, fit: Callable[[DataFrame], object]) -> DataFrame:
    with series.cached():
        fitted = models.coefficients(series.frame, fit(series.frame))
    return fitted.select(*(rounded(c) for c in fitted.columns))


@query("ols_fit")
def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        overall_series(spark, sf_dir), lambda df: models.linear(df, 0.0, 1.0, 1000)
    )


@query("ridge_fit")
def ridge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        overall_series(spark, sf_dir), lambda df: models.linear(df, 0.01, 0.0, 1000)
    )


@query("lasso_fit")
def lasso_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        overall_series(spark, sf_dir), lambda df: models.linear(df, 0.01, 1.0, 100)
    )


@query("glr_gaussian")
def glr_gaussian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        overall_series(spark, sf_dir), lambda df: models.generalized_linear(df, "gaussian")
    )


@query("glr_poisson")
def glr_poisson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        overall_series(spark, sf_dir), lambda df: models.generalized_linear(df, "poisson")
    )


@query("ols_fit_by_supplier")
def ols_fit_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        category_series(spark, sf_dir, "supplier"), lambda df: models.linear(df, 0.0, 1.0, 1000)
    )


@query("ridge_fit_by_supplier")
def ridge_fit_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        category_series(spark, sf_dir, "supplier"), lambda df: models.linear(df, 0.01, 0.0, 1000)
    )


@query("ridge_fit_by_status")
def ridge_fit_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        category_series(spark, sf_dir, "status"), lambda df: models.linear(df, 0.01, 0.0, 1000)
    )


@query("glr_poisson_by_priority")
def glr_poisson_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_coefficients(
        category_series(spark, sf_dir, "priority"),
        lambda df: models.generalized_linear(df, "poisson"),
    )


def fitted_rows(
    series: MonthlySeries,
    fit: Callable[[DataFrame], object],
    train: DataFrame | None = None,
    test: DataFrame | None = None,
) -> DataFrame:
    """Fit on the training rows, predict the test rows; the whole series by default."""
    with series.cached():
        model = fit(series.frame if train is None else train)
    predicted = model.transform(series.frame if test is None else test)
    category = ["category"] if series.by else []
    return predicted.select("month", *category, "id", "n", "prediction")


@query("isotonic_fit")
def isotonic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = fitted_rows(overall_series(spark, sf_dir), models.isotonic)
    return predicted.withColumn("prediction", rounded("prediction"))


@query("isotonic_by_supplier")
def isotonic_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = fitted_rows(category_series(spark, sf_dir, "supplier"), models.isotonic)
    return predicted.withColumn("prediction", rounded("prediction"))


@query("isotonic_by_status")
def isotonic_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = fitted_rows(category_series(spark, sf_dir, "status"), models.isotonic)
    return predicted.withColumn("prediction", rounded("prediction"))


@query("lasso_holdout")
def lasso_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = overall_series(spark, sf_dir)
    train, test = holdout(series.frame, TEST_AFTER, TRAIN_BEFORE)
    predicted = fitted_rows(series, lambda df: models.linear(df, 0.01, 1.0, 100), train, test)
    return predicted.withColumn("prediction", rounded("prediction"))


def tree_rows(
    series: MonthlySeries, depth: int, train: DataFrame | None = None, test: DataFrame | None = None
) -> DataFrame:
    bins = tree_bins(series)
    return fitted_rows(series, lambda df: models.tree(df, depth, bins), train, test)


@query("tree_fit_predict")
def tree_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth 3, overall, trained on earlier and tested on later months."""
    series = overall_series(spark, sf_dir)
    train, test = holdout(series.frame, TEST_AFTER, TRAIN_BEFORE)
    return tree_rows(series, 3, train, test).withColumn("prediction", rounded("prediction"))


@query("tuned_tree_holdout")
def tuned_tree_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth chosen by cross-validation on the earlier months."""
    series = overall_series(spark, sf_dir)
    train, test = holdout(series.frame, TEST_AFTER, TRAIN_BEFORE)
    predicted = fitted_rows(
        series, lambda df: tune_tree(df, series.bounds.last_id, 1).model, train, test
    )
    return predicted.withColumn("prediction", rounded("prediction"))


@query("tree_by_returnflag")
def tree_by_returnflag(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "returnflag")
    return tree_rows(series, 5).withColumn("prediction", rounded("prediction"))


@query("tree_by_status")
def tree_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "status")
    return tree_rows(series, 3).withColumn("prediction", rounded("prediction"))


@query("tree_by_supplier")
def tree_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth 3, disjoint cuts."""
    series = category_series(spark, sf_dir, "supplier")
    train, test = holdout(series.frame, TEST_AFTER, TEST_AFTER)
    return tree_rows(series, 3, train, test).withColumn("prediction", rounded("prediction"))


@query("deep_tree_two_categories")
def deep_tree_two_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As deep as trees go, on the two most active categories only."""
    series = category_series(spark, sf_dir, "supplier")
    train = index_range(series.frame, 0.0, 2.0)
    test = train.where(F.col("month") > F.lit(TEST_AFTER))
    bins = bin_count(series.bounds.last_id, 2)
    predicted = fitted_rows(
        series, lambda df: models.tree(df, models.MAX_DEPTH, bins), train, test
    )
    return predicted.withColumn(
        "prediction", rounded("prediction")
    )


def whole_forest_rows(series: MonthlySeries) -> DataFrame:
    """A forest of all rows and all features: each of its trees is the single tree."""
    bins = tree_bins(series)
    train, test = holdout(series.frame, TEST_AFTER, TEST_AFTER)
    predicted = fitted_rows(
        series, lambda df: models.forest(df, 10, 3, bins, False, "all"), train, test
    )
    return predicted.withColumn("prediction", rounded("prediction"))


@query("whole_forest_overall")
def whole_forest_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_forest_rows(overall_series(spark, sf_dir))


@query("whole_forest_by_supplier")
def whole_forest_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_forest_rows(category_series(spark, sf_dir, "supplier"))


def forest_rows(series: MonthlySeries, trees: int, depth: int) -> DataFrame:
    """Trees on rows weighted by hash, disjoint cuts."""
    train, test = holdout(series.frame, TEST_AFTER, TEST_AFTER)
    return fitted_rows(series, lambda df: wide_forest(df, trees, depth), train, test)


@query("forest_fit_predict")
def forest_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = forest_rows(overall_series(spark, sf_dir), 3, 5)
    return predicted.withColumn("prediction", rounded("prediction"))


@query("forest_by_supplier")
def forest_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = forest_rows(category_series(spark, sf_dir, "supplier"), 10, 3)
    return predicted.withColumn("prediction", rounded("prediction"))


def wide_tree_rows(series: MonthlySeries) -> DataFrame:
    train, test = holdout(series.frame, TEST_AFTER, TEST_AFTER)
    predicted = fitted_rows(series, lambda df: wide_tree(df, 3), train, test)
    return predicted.withColumn("prediction", rounded("prediction"))


@query("wide_tree_by_supplier")
def wide_tree_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``tree_by_supplier``, grown without a bin for each supplier."""
    return wide_tree_rows(category_series(spark, sf_dir, "supplier"))


@query("wide_tree_by_customer")
def wide_tree_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Very many categories, each missing from most months."""
    series = build_series(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")
    return wide_tree_rows(series)


@query("wide_tree_recursive_by_priority")
def wide_tree_recursive_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "priority")
    return forecast_recursive(series, 2, fit=lambda training: wide_tree(training, 4))


# --- evaluation and tuning ---------------------------------------------------------


def ols_tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = overall_series(spark, sf_dir)
    train, test = holdout(series.frame, TEST_AFTER, TEST_AFTER)
    return fitted_rows(series, lambda df: models.linear(df, 0.0, 1.0, 1000), train, test)


@query("metric_mae")
def metric_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = mae(F.col("n"), F.col("prediction"))
    return ols_tested(spark, sf_dir).agg(F.round(value, 6).alias("mae"))


@query("metric_rmse")
def metric_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = rmse(F.col("n"), F.col("prediction"))
    return ols_tested(spark, sf_dir).agg(F.round(value, 6).alias("rmse"))


@query("metric_r2")
def metric_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = r2(F.col("n"), F.col("prediction"))
    return ols_tested(spark, sf_dir).agg(F.round(value, 6).alias("r2"))


def rounded_metrics(predicted: DataFrame) -> DataFrame:
    scores = metrics_frame(predicted)
    return scores.select(*(rounded(c) for c in scores.columns))


@query("ridge_metrics_by_supplier")
def ridge_metrics_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "supplier")
    train, test = holdout(series.frame, TEST_AFTER)
    return rounded_metrics(
        fitted_rows(series, lambda df: models.linear(df, 0.01, 0.0, 1000), train, test)
    )


@query("tree_metrics_by_priority")
def tree_metrics_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "priority")
    train, test = holdout(series.frame, TEST_AFTER)
    return rounded_metrics(tree_rows(series, 3, train, test))


@query("isotonic_metrics_by_status")
def isotonic_metrics_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "status")
    train, test = holdout(series.frame, TEST_AFTER)
    return rounded_metrics(fitted_rows(series, models.isotonic, train, test))


@query("tree_metrics_by_returnflag")
def tree_metrics_by_returnflag(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = category_series(spark, sf_dir, "returnflag")
    train, test = holdout(series.frame, TEST_AFTER)
    return rounded_metrics(tree_rows(series, 5, train, test))


@query("forest_metrics_by_supplier")
def forest_metrics_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_metrics(forest_rows(category_series(spark, sf_dir, "supplier"), 10, 3))


@query("cv_model_choice")
def cv_model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated RMSE of each family of the generalized linear regression."""
    with overall_series(spark, sf_dir).cached() as series:
        tuned = tune_generalized_linear(series.frame)
    rows = [
        (str(next(iter(params.values()))), round(score, 6), params == tuned.best)
        for params, score in zip(tuned.grid, tuned.rmse)
    ]
    return spark.createDataFrame(rows, "family string, rmse double, chosen boolean")


def linear_choice(series: MonthlySeries, grid: list[ElasticNet]) -> DataFrame:
    tuned = tune_linear(series.frame, grid)
    rows = [
        (net.reg_param, net.elastic_net, round(score, 6), net == tuned.best)
        for net, score in zip(tuned.grid, tuned.rmse)
    ]
    spark = series.frame.sparkSession
    return spark.createDataFrame(
        rows, "reg_param double, elastic_net double, rmse double, chosen boolean"
    )


@query("cv_penalty_choice")
def cv_penalty_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated RMSE of plain, ridge and lasso fits."""
    grid = [ElasticNet(p, kind) for p in RIDGE_PENALTIES for kind in (0.0, 1.0)]
    return linear_choice(overall_series(spark, sf_dir), grid)


@query("cv_penalty_choice_by_supplier")
def cv_penalty_choice_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = [ElasticNet(p) for p in RIDGE_PENALTIES]
    return linear_choice(category_series(spark, sf_dir, "supplier"), grid)


@query("cv_depth_choice")
def cv_depth_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated RMSE of each tree depth."""
    with category_series(spark, sf_dir, "priority").cached() as series:
        tuned = tune_tree(series.frame, series.bounds.last_id, series.bounds.categories)
    rows = [
        (next(v for p, v in params.items() if p.name == "maxDepth"), round(score, 6),
         params == tuned.best)
        for params, score in zip(tuned.grid, tuned.rmse)
    ]
    return spark.createDataFrame(rows, "max_depth int, rmse double, chosen boolean")


# --- forecasts ---------------------------------------------------------------------


@query("ols_forecast_overall")
def ols_forecast_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_direct(overall_series(spark, sf_dir), HORIZON, models.linear)


@query("glr_forecast_overall")
def glr_forecast_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_direct(overall_series(spark, sf_dir), HORIZON)


@query("glr_forecast_by_category")
def glr_forecast_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_direct(category_series(spark, sf_dir, "priority"), HORIZON)


@query("glr_forecast_by_supplier")
def glr_forecast_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_direct(category_series(spark, sf_dir, "supplier"), 12)


@query("tree_forecast_overall")
def tree_forecast_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_recursive(overall_series(spark, sf_dir), HORIZON)


@query("tree_forecast_by_category")
def tree_forecast_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_recursive(category_series(spark, sf_dir, "priority"), HORIZON)


@query("tree_forecast_six_months")
def tree_forecast_six_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_recursive(overall_series(spark, sf_dir), 6)


@query("tree_forecast_by_supplier")
def tree_forecast_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many bins as suppliers, one more category set each step."""
    return forecast_recursive(category_series(spark, sf_dir, "supplier"), 2)


@query("ols_recursive_overall")
def ols_recursive_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_recursive(overall_series(spark, sf_dir), HORIZON, fit=ElasticNet())


@query("ols_recursive_by_supplier")
def ols_recursive_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_recursive(category_series(spark, sf_dir, "supplier"), 6, fit=ElasticNet())


@query("ridge_recursive_by_priority")
def ridge_recursive_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A penalty that counts: the last coefficient is a tenth of the plain one's and less."""
    series = category_series(spark, sf_dir, "priority")
    return forecast_recursive(series, 12, fit=ElasticNet(RIDGE_PENALTIES[-1]))


def orders_csv_job(
    spark: SparkSession, sf_dir: str, by: str, method: str, null_status: str = "", **options
) -> DataFrame:
    """From CSV file to CSV file: the forecast as written, read back.

    Orders of the status ``null_status`` have none in the file.
    """
    texts = order_texts(spark, sf_dir).withColumn(
        "specialty", F.when(F.col("specialty") != null_status, F.col("specialty"))
    )
    path = f"{scratch_path(spark, 'job')}/records.csv"
    write_parts(texts, path)
    out = scratch_path(spark, "job")
    forecast = run_forecast_job(spark, path, by, HORIZON, out, method, **options)
    if options.get("name_from_input"):
        name = recursive_name_from_input(by, HORIZON, path, out)
    else:
        name = (recursive_name if method == "recursive" else direct_name)(by, HORIZON, out)
    return spark.read.schema(forecast.schema).option("header", True).csv(name)


@query("forecast_job_named_after_input")
def forecast_job_named_after_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_csv_job(
        spark, sf_dir, "Overall", "recursive", name_from_input=True, fit=models.linear
    )


@query("forecast_job_with_quarantine")
def forecast_job_with_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that cannot be counted are set aside."""
    path = torn_orders_csv(spark, sf_dir)
    aside = scratch_path(spark, "aside")
    return run_forecast_job(spark, path, "overall", HORIZON, fit=ElasticNet(), quarantine=aside)


@query("forecast_job_without_nulls")
def forecast_job_without_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a category are left out."""
    return orders_csv_job(
        spark, sf_dir, "specialty", "direct", null_status="P", null_category="drop"
    )


@query("forecast_job_allowed_dimension")
def forecast_job_allowed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date column named, the dimension from a list, several sorted files."""
    return orders_csv_job(
        spark, sf_dir, "priority", "direct",
        date_col="removal_date", allowed=["overall", "priority"], files=2,
    )


@query("forecast_job_direct")
def forecast_job_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_csv_job(spark, sf_dir, "Priority", "direct")


@query("forecast_job_recursive")
def forecast_job_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_csv_job(spark, sf_dir, "Overall", "recursive")


@query("forecast_preview")
def forecast_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = forecast_direct(overall_series(spark, sf_dir), 12, models.linear)
    return preview(forecast, 5)


@query("forecast_lines")
def forecast_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_lines(ols_forecast_overall(spark, sf_dir))
