import datetime as dt
import glob
import random

import pytest

from data import events, months, ramp
from monthtide import build_series, forecast_direct, forecast_recursive, run_forecast_job
from monthtide.operators import models
from monthtide.plans.finish import forecast_lines, preview

JAN = dt.date(2015, 1, 1)


@pytest.fixture(scope="module")
def records(spark):
    """Three doctors, one missing from some months and one seen once; history ends in December."""
    rng = random.Random(1)
    counts = {}
    for i, m in enumerate(months(JAN, 12)):
        counts[("a", m)] = 20 + rng.randint(0, 5)
        if i % 3:
            counts[("b", m)] = 5 + rng.randint(0, 5)
    counts[("c", months(JAN, 12)[4])] = 2
    return events(spark, counts)


def check_whole(forecast, horizon, categories, last):
    rows = forecast.collect()
    want = {(m, c) for m in months(last, horizon + 1)[1:] for c in categories}
    assert len(rows) == len(want)
    assert {(r.Date, r.doctor if "doctor" in r else None) for r in rows} == want
    assert all(r.prediction == int(r.prediction) for r in rows)
    return rows


def test_direct_by_category(records):
    forecast = forecast_direct(build_series(records, "doctor"), 36)
    rows = check_whole(forecast, 36, ["a", "b", "c"], dt.date(2015, 12, 1))
    assert all(r.prediction >= 0 for r in rows)
    assert forecast.columns == ["Date", "doctor", "prediction"]


def test_recursive_by_category(records):
    forecast = forecast_recursive(build_series(records, "doctor"), 2)
    check_whole(forecast, 2, ["a", "b", "c"], dt.date(2015, 12, 1))


@pytest.mark.parametrize("forecast", [forecast_direct, forecast_recursive])
def test_overall_one_month(records, forecast):
    got = forecast(build_series(records), 1)
    check_whole(got, 1, [None], dt.date(2015, 12, 1))
    assert got.columns == ["Date", "prediction"]


@pytest.mark.parametrize("forecast", [forecast_direct, forecast_recursive])
@pytest.mark.parametrize("horizon", [0, -1])
def test_no_horizon(records, forecast, horizon):
    with pytest.raises(ValueError, match="horizon"):
        forecast(build_series(records), horizon)


def test_falling_series_is_clamped(spark):
    series = build_series(ramp(spark, JAN, [110 - 10 * i for i in range(1, 11)]))
    assert [r.prediction for r in forecast_direct(series, 3, models.linear).collect()] == [0.0] * 3
    loose = forecast_direct(series, 3, models.linear, clamp=False)
    assert [r.prediction for r in loose.collect()] == [0.0, -10.0, -20.0]


def test_only_the_last_prediction_joins_the_next_fit(spark):
    """A constant history predicts itself, whatever is fed back."""
    series = build_series(ramp(spark, JAN, [7] * 9))
    assert [r.prediction for r in forecast_recursive(series, 3).collect()] == [7.0] * 3


def test_preview_and_lines(spark):
    series = build_series(ramp(spark, JAN, [3 + 2 * i for i in range(1, 13)]))
    forecast = forecast_direct(series, 4, models.linear)
    assert [r.prediction for r in preview(forecast, 2).collect()] == [29.0, 31.0]
    lines = sorted(r.line for r in forecast_lines(forecast).collect())
    assert lines[0] == "Prediction for 1-2016 is 29"


@pytest.fixture(scope="module")
def csv_path(spark, records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "records.2015.csv")
    texts = records.selectExpr(
        "date_format(removal_date, 'dd/MM/yyyy') as `Removal Date`", "doctor as Doctor"
    )
    texts.coalesce(1).write.option("header", True).csv(path)
    return path


def test_job_writes_what_it_returns(spark, csv_path, tmp_path):
    out = str(tmp_path)
    forecast = run_forecast_job(spark, csv_path, "doctor", 2, out)
    assert forecast.columns == ["Date", "Doctor", "prediction"]
    path = f"{out}/Prediction_doctor_2.csv"
    assert len(glob.glob(f"{path}/part-*.csv")) == 1
    written = spark.read.schema(forecast.schema).option("header", True).csv(path)
    assert sorted(written.collect()) == sorted(forecast.collect())
    direct = run_forecast_job(spark, csv_path, "Overall", 6, out, method="direct")
    assert spark.read.option("header", True).csv(f"{out}/prediction_Overall_6").count() == 6
    assert direct.count() == 6
    run_forecast_job(spark, csv_path, "Overall", 1, out, name_from_input=True)
    assert glob.glob(f"{out}/Prediction_overall_records_1.csv/part-*.csv")


@pytest.mark.parametrize(
    ("arguments", "message"),
    [
        ({"by": "ward"}, "not one of the columns"),
        ({"by": "doctor", "allowed": ["overall", "ward"]}, "unknown dimension"),
        ({"by": "removal date"}, "is the date column"),
        ({"horizon": 0}, "horizon"),
        ({"method": "other"}, "method"),
        ({"required_in_path": ["csv", "other"]}, "must contain"),
        ({"date_col": "when"}, "not one of the columns"),
    ],
)
def test_job_checks_its_arguments(spark, csv_path, arguments, message):
    with pytest.raises(ValueError, match=message):
        run_forecast_job(spark, csv_path, **arguments)


def test_job_leaves_nothing_behind(spark, csv_path, tmp_path):
    work, before = tmp_path / "work", spark.sparkContext.getCheckpointDir()
    run_forecast_job(
        spark, csv_path, "doctor", 2, str(tmp_path / "out"), work_dir=str(work), fit=models.linear
    ).collect()
    assert not [p for p in work.rglob("*") if p.is_file()]
    kept = run_forecast_job(
        spark, csv_path, "doctor", 2, work_dir=str(work), fit=models.linear, parallelism=2
    )
    assert kept.count() == 6
    assert len({p.parent for p in work.rglob("*.parquet")}) == 1
    assert spark.sparkContext.getCheckpointDir() == before


@pytest.mark.parametrize("name", ["Prediction", "date"])
def test_dimension_called_like_an_output_column(spark, name):
    df = events(spark, {("a", JAN): 2}).withColumnRenamed("doctor", name)
    with pytest.raises(ValueError, match="rename"):
        build_series(df, name, "removal_date")


def test_points_in_time_have_the_date_of_the_given_zone(spark):
    df = spark.sql("select timestamp'2020-01-31T23:30:00Z' as at union all select timestamp'2020-02-10T00:00:00Z'")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            for zone, want in (("UTC", 2), ("Asia/Tokyo", 1)):
                series = build_series(df, date_col="at", time_zone=zone)
                assert series.rows.count() == want, (session, zone)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_recursion_with_another_model(records):
    series = build_series(records, "doctor")
    forecast = forecast_recursive(series, 2, fit=models.linear)
    check_whole(forecast, 2, ["a", "b", "c"], dt.date(2015, 12, 1))


def test_partitioning_does_not_change_the_recursion(records):
    got = [
        sorted(forecast_recursive(build_series(records.repartition(n), "doctor"), 2).collect())
        for n in (1, 13)
    ]
    assert got[0] == got[1]
