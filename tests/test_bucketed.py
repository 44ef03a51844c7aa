"""Bucketed sources: no exchange under the join, nor under the dedupe that follows it."""

import datetime as dt

from pyspark.sql import functions as F

from airspark.operators.clean import dedupe_keep_last
from airspark.plans.features import join_air_weather
from airspark.sources.bucketed import buckets_for, join_bucketed, write_bucketed

T0 = dt.datetime(2024, 1, 1)


def side(spark, name, hours, run):
    rows = [(c, T0 + dt.timedelta(hours=h), float(h), T0 + dt.timedelta(days=run)) for c in ("a", "b", None) for h in hours]
    return spark.createDataFrame(rows, f"city string, timestamp timestamp_ntz, {name} double, ingestion_timestamp timestamp_ntz")


def test_join_and_dedupe_move_no_row(spark):
    air = [side(spark, "pm25", range(50), 1), side(spark, "pm25", range(40, 60), 2)]
    weather = side(spark, "rain", range(5, 55), 1)
    try:
        write_bucketed(air[0], "t_air", 4)
        write_bucketed(air[1], "t_air", 4, mode="append")
        write_bucketed(weather, "t_weather", 4)
        joined = join_bucketed(spark, "t_air", "t_weather")
        last = dedupe_keep_last(joined)
        plan = last._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = dedupe_keep_last(join_air_weather(air[0].union(air[1]), weather))
        assert last.count() == want.count() == 100
        assert last.exceptAll(want).count() == 0
        assert joined.where(F.col("city").isNull()).count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS t_air")
        spark.sql("DROP TABLE IF EXISTS t_weather")


def test_bucket_counts_are_powers_of_two():
    assert [buckets_for(n) for n in (0, 10 ** 7, 10 ** 9)] == [8, 8, 256]
