import datetime as dt
import glob

import pytest

from data import ramp
from monthtide.sources.forecast_files import (
    direct_name,
    recursive_name,
    recursive_name_from_input,
    write_forecast,
    write_parts,
)
from monthtide.sources.tables import (
    find_date_column,
    read_csv,
    read_records,
    read_table,
    require_date_column,
    resolve_dimension,
)


@pytest.mark.parametrize(
    ("columns", "found"),
    [(["a", "date"], "date"), (["Removal Date", "x"], "Removal Date"),
     (["Updated", "Removal Date"], "Updated"), (["when"], "")],
)
def test_date_column(spark, columns, found):
    assert find_date_column(columns) == found
    df = spark.createDataFrame([tuple("x" for _ in columns)], columns)
    if found:
        assert require_date_column(df) == found
    else:
        with pytest.raises(ValueError, match="date"):
            require_date_column(df)
    assert require_date_column(df, columns[-1].upper()) == columns[-1]


def test_dimension(spark):
    df = spark.createDataFrame([("a", "b")], ["Removal Date", "DocTor"])
    assert resolve_dimension(df, "doctor") == "DocTor"
    assert resolve_dimension(df, "Overall") is None and resolve_dimension(df, None) is None
    with pytest.raises(ValueError, match="not one of the columns"):
        resolve_dimension(df, "ward")
    assert resolve_dimension(df, "DOCTOR", allowed=["overall", "doctor"]) == "DocTor"
    with pytest.raises(ValueError, match="unknown dimension"):
        resolve_dimension(df, "removal date", allowed=["overall", "doctor"])


def test_names():
    assert recursive_name("Overall", 3) == "Prediction_overall_3.csv"
    assert recursive_name("Doctor", 12, "/out") == "/out/Prediction_Doctor_12.csv"
    by_input = recursive_name_from_input
    assert by_input("overall", 3, "./in/a.b.csv") == "Prediction_overall_a_3.csv"
    assert by_input("doctor", 3, "/in/a.csv", "o") == "o/Prediction_a_doctor_3.csv"
    assert direct_name("Overall", 6) == "prediction_Overall_6"


def test_csv_is_all_text(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    (tmp_path / "x.csv").write_text("Removal Date,Doctor,n\n01/04/2015,a,1\n2/4/2015,,2\n")
    for df in (read_table(spark, path), read_csv(spark, path, ["Removal Date", "Doctor", "n"])):
        assert [t for _, t in df.dtypes] == ["string"] * 3
        assert sorted(r.n for r in df.collect()) == ["1", "2"]
        assert df.where("Doctor is null").count() == 1


def test_parquet_by_suffix(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    ramp(spark, dt.date(2015, 1, 1), [1, 2]).write.parquet(path)
    assert read_table(spark, path).count() == 3


def test_forecast_files(spark, tmp_path):
    forecast = spark.range(10, numPartitions=4).selectExpr(
        "date'2015-01-01' as Date", "cast(id as double) as prediction"
    )
    one, many, free, parts = (str(tmp_path / n) for n in ("one", "many", "free", "parts"))
    for _ in range(2):  # the second write replaces the first
        write_forecast(forecast, one)
    write_forecast(forecast, many, files=3)
    write_forecast(forecast, free, files=None)
    write_parts(forecast, parts, "csv")
    assert len(glob.glob(f"{one}/part-*.csv")) == 1
    assert len(glob.glob(f"{parts}/part-*.csv")) == 4
    for path in (one, many, free, parts):
        rows = spark.read.option("header", True).csv(path)
        assert rows.columns == ["Date", "prediction"] and rows.count() == 10


def test_other_headers_raise(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("date,doctor\n01/04/2015,a\n")
    (folder / "b.csv").write_text("doctor,date\nb,02/04/2015\n")
    for df in (read_csv(spark, str(folder)), read_csv(spark, str(folder), ["date", "doctor"])):
        with pytest.raises(Exception, match="(?i)header"):
            df.collect()
    one = str(folder / "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, one, ["date", "doctor"]).collect()
    assert read_csv(spark, one).select("date", "doctor").first() == ("02/04/2015", "b")


def test_records_that_cannot_be_counted_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "Removal Date,Doctor\n01/04/2015,a\n31/02/2015,b\n2015-04-01,b\n,c\n  ,c\n"
        "01/04/2015\n01/04/2015,a,x\n01/04/2015 10:00,a\n1/4/2015,\n"
    )
    records = read_records(spark, str(folder))
    assert records.good.columns == ["Removal Date", "Doctor"]
    assert sorted(map(tuple, records.good.collect()), key=str) == [("01/04/2015", "a"), ("1/4/2015", None)]
    bad = sorted((r.reason, r.record) for r in records.bad.collect())
    assert bad == [
        ("malformed row", "01/04/2015"), ("malformed row", "01/04/2015,a,x"),
        ("no date", "  ,c"), ("no date", ",c"),
        ("not a date", "01/04/2015 10:00,a"), ("not a date", "2015-04-01,b"), ("not a date", "31/02/2015,b"),
    ]
    assert all(r.file.endswith("a.csv") for r in records.bad.collect())


def test_records_of_parquet(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    rows = [(dt.date(2015, 1, 2), "a"), (None, "b")]
    spark.createDataFrame(rows, "`the.date` date, k string").write.parquet(path)
    records = read_records(spark, path, "THE.DATE")
    assert [r.k for r in records.good.collect()] == ["a"]
    assert [(r.reason, r.record) for r in records.bad.collect()] == [("no date", ",b")]
