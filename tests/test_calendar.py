import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthtide.functions.calendar import (
    event_date,
    month_key,
    month_key_to_date,
    month_start,
    parse_date_text,
)
from monthtide.functions.numeric import clamp_negative, round_half_up


def parse(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return [r[0] for r in df.select(parse_date_text(F.col("s"))).collect()]


def test_accepted_texts(spark):
    april = dt.date(2015, 4, 1)
    assert parse(spark, "01/04/2015", "1/4/2015") == [april, april]
    assert parse(spark, "29/02/2016") == [dt.date(2016, 2, 29)]


@pytest.mark.parametrize(
    "text",
    ["31/02/2015", "29/02/2015", "01/04/15", "", "2015-04-01", "01/04/2015 10:00", None,
     "001/4/2015", "1/004/2015", " 01/04/2015", "01/04/2015 ", "0/1/2015", "1/13/2015"],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_other_texts_raise(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a dd/MM/yyyy date"):
            parse(spark, text)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1000, 1, 1), dt.date(9999, 12, 31)), min_size=1, max_size=50))
def test_text_round_trip(spark, days):
    texts = [f"{d.day:02d}/{d.month}/{d.year:04d}" for d in days]
    assert parse(spark, *texts) == days


def test_month_key_there_and_back(spark):
    days = [dt.date(2015, 1, 1), dt.date(2015, 12, 31), dt.date(2016, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        month_key(F.col("d")).alias("k"),
        month_key_to_date(month_key(F.col("d"))).alias("m"),
        month_start(F.col("d")).alias("s"),
    )
    assert [r.k for r in df.collect()] == [201501, 201512, 201602]
    assert all(r.m == r.s and r.m.day == 1 for r in df.collect())


def test_null_date_raises(spark):
    df = spark.createDataFrame([(None,)], "d date")
    with pytest.raises(Exception, match="null in date column"):
        df.select(event_date(df, "d")).collect()


def test_round_and_clamp(spark):
    values = [2.5, -2.5, -0.3, 1.49, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_up(F.col("v"))).collect()]
    assert got[:4] == [3.0, -3.0, 0.0, 1.0]
    clamped = [r[0] for r in df.select(clamp_negative(F.col("v"))).collect()]
    assert clamped[:4] == [2.5, 0.0, 0.0, 1.49]
    assert clamped[4] != clamped[4] and clamped[5] == 0.0
