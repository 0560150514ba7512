import pytest
from pyspark.sql import functions as F

from docsync.functions.times import iso_date, second_date_time, strict_date_time


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_text_of_times_is_utc_in_any_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(1).select(
            F.timestamp_seconds(F.lit(0)).alias("epoch"),
            F.timestamp_micros(F.lit(1710053999123456).cast("long")).alias("near_a_clock_change"),
            F.expr("TIMESTAMP_NTZ '2024-03-10 02:30:00.5'").alias("naive"),
            F.expr("DATE '2024-02-29'").alias("day"), F.lit(None).cast("timestamp").alias("none"))
        assert tuple(df.select(*map(strict_date_time, df.columns)).first()) == (
            "1970-01-01T00:00:00.000Z", "2024-03-10T06:59:59.123Z", "2024-03-10T02:30:00.500Z",
            "2024-02-29T00:00:00.000Z", None)
        assert df.select(second_date_time(F.col("naive"))).first()[0] == "2024-03-10T02:30:00.000Z"
        assert df.select(iso_date("near_a_clock_change")).first()[0] == "2024-03-10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
