"""Naive timestamps never pass through the session time zone."""

import datetime as dt

from pyspark.sql import functions as F

from airspark.functions.time import floor_hour, parse_timestamp, to_local_time


def test_results_do_not_depend_on_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # 2024-03-10 02:xx does not exist there
        df = spark.createDataFrame([("2024-03-10 02:30:00", "2024-03-10T02:30", "2024-03-10T10:30:00Z",
                                     "2024-03-10T12:30:00+05:00", "2024-03-10 02:30:00")],
                                   "a string, b string, c string, d string, e string")
        r = df.select(floor_hour(F.col("a").cast("timestamp_ntz")).alias("fh"), parse_timestamp("b").alias("p"),
                      to_local_time("c", "Asia/Karachi").alias("lc"), to_local_time("d", "Asia/Karachi").alias("ld"),
                      to_local_time("e", "Asia/Karachi").alias("le")).first()
        assert r.fh == dt.datetime(2024, 3, 10, 2, 0)
        assert r.p == dt.datetime(2024, 3, 10, 2, 30)
        assert r.lc == dt.datetime(2024, 3, 10, 15, 30)
        assert r.ld == dt.datetime(2024, 3, 10, 12, 30)
        assert r.le == dt.datetime(2024, 3, 10, 2, 30)   # naive text is already local
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_time_split_under_other_session_zone(spark):
    from airspark.operators.split import time_split
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(f"c{c}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for h in range(10) for c in range(2)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r.split: r["count"] for r in time_split(df).groupBy("split").count().collect()}
        assert got == {"train": 16, "test": 4}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
