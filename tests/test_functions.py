import datetime as dt

from conftest import at
from pyspark.sql import functions as F

from shelfstream import functions as fn


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expr("c")).collect()]


def test_strip_braces_cuts_two_characters_blindly(spark):
    got = column(spark, ["{A-1}", "ab", "{}", "xyz", None], "string", fn.strip_braces)
    assert got == ["A-1", "", "", "y", None]


def test_store_label_has_a_default_for_unknown_and_null(spark):
    got = column(spark, [1, 0, 7, None], "int", fn.store_label)
    assert got == ["Store_01", "Online_01", "Something_new", "Something_new"]


def test_second_text_drops_the_fraction(spark):
    got = column(spark, [at("00:00:07.179575"), None], "timestamp", fn.as_second_text)
    assert got == ["2021-01-01 00:00:07", None]


def test_document_time(spark):
    got = column(spark, ["2021-01-01T00:00:15.000Z", "x", None], "string", fn.as_document_time)
    assert got == [at("00:00:15"), None, None]


def test_or_zero(spark):
    assert column(spark, [3, None], "int", fn.or_zero) == [3, 0]


def test_item_struct(spark):
    row = spark.sql("SELECT 1 AS a, -2 AS b").select(fn.item_struct("a", "b").alias("i")).first()
    assert row.i.asDict() == {"item_id": 1, "quantity": -2}


def test_literal_conversions_of_the_session(spark):
    row = spark.sql(
        """SELECT to_date('2019-11-07T23:59:01.500+0000') AS d,
             timestamp('2022-08-17 06:03:44.9') AS t"""
    ).first()
    assert row.d == dt.date(2019, 11, 7)
    assert row.t == at("2022-08-17 06:03:44.900000")


def test_greatest_skips_null(spark):
    row = spark.createDataFrame([(at("01:00:00"), None)], "a timestamp, b timestamp")
    assert row.select(F.greatest("a", "b")).first()[0] == at("01:00:00")
