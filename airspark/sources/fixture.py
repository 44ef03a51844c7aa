"""Hourly observation series derived from the given tables.

The test tables hold no air-quality data, so the observation series is
derived from them with order-independent aggregates (see FIXTURES.md):

* ``events`` variant: one series per ``event_type`` (the "city"), one row
  per hour;
* ``lineitem`` variant (bench scale): one series per supplier, one row per
  ship day.

Both are plain grouped aggregates with partial (map-side) aggregation, so
the work grows with the input and no key is ever collected into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.time import floor_hour
from ..session import read_table

AS_OF = "2024-01-25 00:00:00"
RUN_TIMESTAMPS = {1: "2024-01-25 00:00:00", 2: "2024-01-25 01:00:00"}
CITY_TIMEZONE = "Asia/Karachi"


def as_of_lit():
    return F.lit(AS_OF).cast("timestamp_ntz")


def hourly_seed(spark: SparkSession, sf_dir: str, variant: str = "events") -> DataFrame:
    if variant == "events":
        ev = read_table(spark, sf_dir, "events")
        return (ev.groupBy(F.col("event_type").alias("city"), floor_hour("ts").alias("timestamp"))
                .agg(F.min_by("value", "event_id").alias("v1"),
                     F.max_by("value", "event_id").alias("v2"),
                     F.max("event_id").alias("emax")))
    if variant == "lineitem":
        li = read_table(spark, sf_dir, "lineitem")
        return (li.groupBy(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("city"),
                           floor_hour("l_shipdate").alias("timestamp"))
                .agg((F.min("l_quantity") * F.lit(2.0)).alias("v1"),
                     (F.max("l_quantity") * F.lit(2.0)).alias("v2"),
                     F.max("l_orderkey").alias("emax")))
    raise ValueError(f"unknown fixture variant: {variant}")


def _null_when(cond, value):
    return F.when(~cond, value)


def air_rows(h: DataFrame) -> DataFrame:
    e = F.col("emax")
    return h.select(
        "city", "timestamp", "emax",
        _null_when(e % 11 == 0, F.col("v1")).alias("pm25"),
        _null_when(e % 13 == 0, F.col("v1") + F.col("v2")).alias("pm10"),
        (F.col("v1") * F.lit(300.0)).alias("carbon_monoxide"),
        _null_when(e % 17 == 0, F.col("v2") * F.lit(20.0)).alias("nitrogen_dioxide"),
        (F.col("v2") * F.lit(5.0)).alias("ozone"),
        (F.col("v1") + F.col("v2") + (e % 100) * F.lit(3.0)).alias("us_aqi"),
    )


def weather_rows(h: DataFrame) -> DataFrame:
    e = F.col("emax")
    return h.filter(e % 19 != 0).select(
        "city", "timestamp",
        ((e % 140) / F.lit(2.0) - F.lit(12.0)).alias("temperature_2m"),
        ((e % 111) * F.lit(1.0)).alias("relative_humidity_2m"),
        F.when(e % 5 == 0, F.col("v2")).otherwise(F.lit(0.0)).alias("precipitation"),
        (F.col("v1") / F.lit(2.0)).alias("windspeed_10m"),
        (F.lit(880.0) + (e % 240)).alias("surface_pressure"),
        (F.col("v1") * F.lit(10.0)).alias("shortwave_radiation"),
        (F.col("v2") / F.lit(5.0)).alias("et0_fao_evapotranspiration"),
    )


def fixture_air(spark, sf_dir, variant="events") -> DataFrame:
    return air_rows(hourly_seed(spark, sf_dir, variant))


def fixture_weather(spark, sf_dir, variant="events") -> DataFrame:
    return weather_rows(hourly_seed(spark, sf_dir, variant))


def fixture_runs(raw: DataFrame) -> DataFrame:
    """Two ingestion runs: run 1 = all rows, run 2 = a corrected subset.

    One pass over ``raw``: rows with ``emax % 7 == 0`` are emitted twice by
    an ``explode`` (no union that would derive ``raw`` a second time).
    """
    run = F.explode(F.when(F.col("emax") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    out = raw.withColumn("run", run)
    out = out.withColumn("pm25", F.when(F.col("run") == 2, F.col("pm25") + F.lit(1.0)).otherwise(F.col("pm25")))
    run_ts = F.when(F.col("run") == 1, F.lit(RUN_TIMESTAMPS[1])).otherwise(F.lit(RUN_TIMESTAMPS[2]))
    return out.withColumns({
        "ingestion_timestamp": run_ts.cast("timestamp_ntz"),
        "forecast_run_timestamp": run_ts.cast("timestamp_ntz"),
    })
