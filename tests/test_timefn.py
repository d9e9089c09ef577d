import datetime as dt

from pyspark.sql import functions as F

from parcelscope.functions.timefn import days_between, hours_between, month_start, parse_ts, zfill

from conftest import ts


def test_hour_and_day_boundaries(spark):
    rows = [
        ("10:59 -> 11:01", ts("2018-01-01 10:59:00"), ts("2018-01-01 11:01:00"), 1, 0),
        ("same hour", ts("2018-01-01 10:01:00"), ts("2018-01-01 10:59:59"), 0, 0),
        ("23:00 -> 01:00", ts("2018-01-01 23:00:00"), ts("2018-01-02 01:00:00"), 2, 1),
        ("23:59 -> 00:01", ts("2018-01-01 23:59:00"), ts("2018-01-02 00:01:00"), 1, 1),
        ("reversed", ts("2018-01-02 01:00:00"), ts("2018-01-01 23:00:00"), -2, -1),
        ("leap day", ts("2020-02-28 12:00:00"), ts("2020-03-01 12:00:00"), 48, 2),
        ("null", ts("2018-01-01 10:00:00"), None, None, None),
    ]
    df = spark.createDataFrame(rows, "name string, a timestamp, b timestamp, h long, d int")
    out = df.select("name", "h", "d", hours_between("a", "b").alias("gh"), days_between("a", "b").alias("gd")).collect()
    for r in out:
        assert r.gh == r.h, r.name
        assert r.gd == r.d, r.name


def test_month_start_is_a_date(spark):
    df = spark.createDataFrame([(ts("2020-02-29 23:59:59"),), (ts("2018-12-31 00:00:00"),)], "a timestamp")
    got = [r[0] for r in df.select(month_start("a")).collect()]
    assert got == [dt.date(2020, 2, 1), dt.date(2018, 12, 1)]


def test_parse_ts_is_lenient(spark):
    df = spark.createDataFrame([("2018-01-02 03:04:05",), ("",), ("garbage",), ("2018-01-02",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_ts("s")).collect()]
    assert got == [ts("2018-01-02 03:04:05"), None, None, None, None]


def test_zfill_never_truncates(spark):
    df = spark.createDataFrame([("",), ("1",), ("1234",), ("01234",), ("123456",), (None,)], "z string")
    got = [r[0] for r in df.select(zfill("z")).collect()]
    assert got == ["00000", "00001", "01234", "01234", "123456", "00000"]


def test_zfill_of_numbers(spark):
    df = spark.createDataFrame([(1234,)], "z long")
    assert df.select(zfill(F.col("z"))).first()[0] == "01234"
