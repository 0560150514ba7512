from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docsync.functions import text, times


def one(spark, df):
    return df.first()[0]


def test_naive_times_are_utc():
    east = timezone(timedelta(hours=2))
    assert times.as_utc("2024-01-01 02:00:00+02:00") == datetime(2024, 1, 1)
    assert times.as_utc(datetime(2024, 1, 1, 2, tzinfo=east)) == datetime(2024, 1, 1)
    assert times.sql_time("2024-01-01 00:00:00.000001") == (
        "TIMESTAMP '2024-01-01 00:00:00.000001Z'")
    assert times.window_start("2024-01-01", timedelta(seconds=1)) == datetime(
        2023, 12, 31, 23, 59, 59)


def test_afternoon_keeps_its_hour(spark):
    at = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-01 13:05:06.789123' AS t")
    row = at.select(times.strict_date_time("t"), times.second_date_time("t"),
                    times.iso_date("t")).first()
    assert tuple(row) == ("2024-03-01T13:05:06.789Z", "2024-03-01T13:05:06.000Z", "2024-03-01")


def test_tokens_drop_blanks(spark):
    df = spark.createDataFrame([(",2,,3",), ("",), (None,)], "u string")
    got = [r[0] for r in df.select(text.comma_tokens(F.col("u"))).collect()]
    assert got == [["2", "3"], [], None]


@pytest.mark.parametrize("value, expected", [
    ("1.00", "1"), ("100.00", "100"), ("1.50", "1.5"), ("0.05", "0.05"), ("-2.10", "-2.1")])
def test_decimal_key_text(spark, value, expected):
    df = spark.createDataFrame([(Decimal(value),)], "d decimal(18,2)")
    assert df.select(text.column_text(df, "d")).first()[0] == expected


def test_scale_zero_keeps_zeros(spark):
    df = spark.createDataFrame([(Decimal(100),)], "d decimal(18,0)")
    assert df.select(text.column_text(df, "d")).first()[0] == "100"


def test_typed_value_takes_the_first_variant(spark):
    df = spark.sql("SELECT 's' AS s, DATE '2024-01-02' AS d, 5.50BD AS n UNION ALL "
                   "SELECT null, DATE '2024-01-02', 5.50BD UNION ALL SELECT null, null, 5.50BD "
                   "UNION ALL SELECT null, null, null")
    got = [r[0] for r in df.select(text.typed_value(df, "s", "d", "n")).collect()]
    assert got == ["s", "2024-01-02", "5.5", None]


def test_doc_id(spark):
    df = spark.createDataFrame([("1-2", "3"), ("1", "2-3"), (None, "5")], "a string, b string")
    assert [r[0] for r in df.select(text.doc_id(df, ("a", "b"))).collect()] == ["1-2-3", "1-2-3", None]
    assert df.select(text.doc_id(df, ("a", "b"), "|")).first()[0] == "1-2|3"
    assert df.select(text.doc_id(df, ("b",))).first()[0] == "3"


def test_null_value_is_written_as_a_word(spark):
    df = spark.createDataFrame([("k", None), ("k", "v")], "k string, v string")
    got = [r[0] for r in df.select(text.pair_text(F.col("k"), F.col("v"))).collect()]
    assert got == ["k null ", "k v "]


def test_decimal_ids_are_written_as_their_join_keys(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(38, 10)) AS a, CAST(1.50 AS DECIMAL(18, 2)) AS b, 7 AS c")
    assert df.select(text.doc_id(df, ("a", "b", "c"))).first()[0] == "1-1.5-7"
    assert df.select(text.doc_id(df, ("a",))).first()[0] == "1"
