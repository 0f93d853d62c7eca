"""Hand goldens for scalar functions and the NULL / ANSI rules."""

import datetime as dt
import math

from pyspark.sql import functions as F

from martlake.functions import scalars as S


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.5,), (5.0,)], "x double")
    got = [r.r for r in df.select(S.clip("x", 1.0, 3.0).alias("r")).collect()]
    assert got == [None, 1.0, 3.0]


def test_log_features_golden(spark):
    df = spark.createDataFrame([(-3, 0.0), (4, 2.5)], "q long, p double")
    r = df.select(S.log_quantity("q").alias("lq"), S.log_unit_price("p").alias("lp"),
                  S.log_total_sum("q", "p").alias("lt")).collect()
    assert r[0].lq == 0.0 and abs(r[0].lp - math.log1p(1e-6)) < 1e-15 and r[0].lt == 0.0
    assert abs(r[1].lq - math.log1p(4)) < 1e-12 and abs(r[1].lt - math.log1p(10.0)) < 1e-12


def test_safe_ratio_zero_is_null(spark):
    assert one(spark, S.safe_ratio(F.col("a"), F.lit(0.0)), 1.0, "a double") is None


def test_percent_error_capped(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 10.0), (4.0, 3.0)], "y double, p double")
    got = [r.r for r in df.select(S.percent_error("y", "p").alias("r")).collect()]
    assert got == [None, 100.0, 25.0]


def test_time_of_day_parse(spark):
    df = spark.createDataFrame([("7:8:9",), ("25:00:00",), ("12:30:01",), (None,)], "t string")
    got = [r.r for r in df.select(S.parse_time_of_day("t").alias("r")).collect()]
    assert got == ["07:08:09", None, "12:30:01", None]


def test_weekday_and_flags(spark):
    # 2011-11-25 is a Friday (Black Friday window), 2011-11-27 a Sunday, 2011-11-30 month end
    df = spark.createDataFrame([(dt.datetime(2011, 11, 25, 10),), (dt.datetime(2011, 11, 27),),
                                (dt.datetime(2011, 11, 30, 23, 59),), (dt.datetime(2011, 12, 1, 8),)], "ts timestamp_ntz")
    r = df.select(S.weekday_1_7("ts").alias("wd"), S.is_weekend("ts").alias("we"),
                  S.black_friday("ts").alias("bf"), S.is_month_end("ts").alias("me"),
                  S.is_month_start("ts").alias("ms"), S.holiday_season("ts").alias("hs")).collect()
    assert [x.wd for x in r] == [5, 7, 3, 4]
    assert [x.we for x in r] == [0, 1, 0, 0]
    assert [x.bf for x in r] == [True, False, False, False]
    assert [x.me for x in r] == [0, 0, 1, 0]
    assert [x.ms for x in r] == [0, 0, 0, 1]
    assert [x.hs for x in r] == [1, 1, 1, 1]


def test_week_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 12, 7, 15),), (dt.datetime(2011, 12, 11),)], "ts timestamp_ntz")
    r = df.select(S.week_start_monday("ts").alias("m"), S.week_end_sunday("ts").alias("s")).collect()
    assert r[0].m == dt.date(2011, 12, 5) and r[0].s == dt.date(2011, 12, 11)
    assert r[1].m == dt.date(2011, 12, 5) and r[1].s == dt.date(2011, 12, 11)


def test_whole_days_not_calendar_days(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 1, 1, 23), dt.datetime(2011, 1, 3, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(S.whole_days_between("a", "b").alias("d")).first().d == 1


def test_age_category_and_short_model(spark):
    df = spark.createDataFrame([(2015.0, "Ford F-150 XL"), (2000.0, None), (None, "RAV4")], "year double, model string")
    r = df.select(S.age_category("year").alias("a"), S.first_word_lower("model").alias("m")).collect()
    assert [x.a for x in r] == ["new", "old", "average"]
    assert [x.m for x in r] == ["ford", None, "rav4"]


def test_half_even(spark):
    df = spark.createDataFrame([(1995.5,), (1996.5,), (-0.5,)], "x double")
    assert [r.r for r in df.select(S.half_even_round("x").alias("r")).collect()] == [1996.0, 1996.0, -0.0]


def test_hit_key_and_suffix(spark):
    df = spark.createDataFrame([("s1", 3, "2024-01-01.json")], "s string, n int, f string")
    r = df.select(S.hit_key("s", "n").alias("k"), S.replace_suffix("f", ".json", ".pkl").alias("f")).first()
    assert r.k == "s1_3" and r.f == "2024-01-01.pkl"
