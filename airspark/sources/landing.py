"""Upstream hourly responses (parallel arrays) <-> keyed rows; landed files.

A response is ``{city, chunk_start, hourly: {time: [...], <var>: [...]}}``.
Responses are bounded by construction: one per (city, chunk of days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas as S
from ..functions.numeric import nan_to_null
from ..functions.time import parse_timestamp
from ..session import checkpoint, scratch_path

TIME_TEXT = "yyyy-MM-dd'T'HH:mm"

# Upstream variable name -> table column (historical flavour).
AIR_RENAME = {"pm2_5": "pm25", "pm10": "pm10", "carbon_monoxide": "carbon_monoxide",
              "nitrogen_dioxide": "nitrogen_dioxide", "ozone": "ozone", "us_aqi": "us_aqi"}
# Forecast flavour: the provider's AQI is a reference, not the target.
FORECAST_AIR_RENAME = {**AIR_RENAME, "us_aqi": S.REFERENCE_COLUMN}
WEATHER_RENAME = {v: v for v in S.WEATHER_RESPONSE_VARIABLES}


def chunk_start(ts_col, chunk_days: int):
    """First day of the ``chunk_days`` block (counted from 1970-01-01) holding ``ts``."""
    d = F.to_date(ts_col)
    k = F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / F.lit(chunk_days)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), k * F.lit(chunk_days))


def responses_from_rows(rows: DataFrame, rename: dict, chunk_days: int = 30, key: str = "city") -> DataFrame:
    """Keyed rows -> one response per (city, chunk): arrays sorted by time."""
    variables = list(rename)
    packed = F.struct(F.date_format("timestamp", TIME_TEXT).alias("time"),
                      *[F.col(rename[v]).cast("double").alias(v) for v in variables])
    grouped = (rows.groupBy(key, chunk_start("timestamp", chunk_days).alias("chunk_start"))
               .agg(F.array_sort(F.collect_list(packed)).alias("_h")))
    def field(name):
        return lambda x: x[name]

    hourly = F.struct(F.transform("_h", field("time")).alias("time"),
                      *[F.transform("_h", field(v)).alias(v) for v in variables])
    return grouped.select(key, "chunk_start", hourly.alias("hourly"))


def rows_from_responses(responses: DataFrame, rename: dict, key: str = "city",
                        validate: bool = True, extra=()) -> DataFrame:
    """Parallel arrays -> rows; ``time`` -> ``timestamp``; variables renamed.

    A response without ``hourly`` (or with empty ``time``) is an error, as
    upstream: checked with one aggregate when ``validate``.
    """
    if validate:
        bad = responses.filter(F.col("hourly").isNull() | (F.coalesce(F.size("hourly.time"), F.lit(0)) <= 0))
        if not bad.isEmpty():
            raise ValueError("Response has no hourly data.")
    # Zipped inside the response: the arrays are not copied onto each exploded row.
    zipped = F.arrays_zip(F.col("hourly.time").alias("time"), *[F.col(f"hourly.{v}").alias(v) for v in rename])
    names = [f"_{i}" for i in range(len(rename))]
    rows = responses.select(key, *extra, F.inline(zipped).alias("_time", *names))
    return rows.where(F.col("_time").isNotNull()).select(
        key, *extra, parse_timestamp("_time").alias("timestamp"),
        *[nan_to_null(F.col(n).cast("double")).alias(col) for n, col in zip(names, rename.values())])


def land_responses(responses: DataFrame, path: str | None = None, name: str = "landing") -> str:
    """Write responses as JSON files, one folder per city and first day of the chunk (landing layout)."""
    path = path or scratch_path(responses.sparkSession, name)
    responses.write.mode("append").partitionBy("city", "chunk_start").json(path)
    return path


BAD_RECORD = "_bad_record"


def read_landed(spark: SparkSession, path: str, schema: T.StructType, start=None, end=None, chunk_days: int = 30,
                bad_path: str | None = None) -> DataFrame:
    """Read landed JSON with an explicit schema (no inference).

    ``start`` and ``end`` (dates) read only the folders of chunks, of ``chunk_days`` days at most, that can hold such
    days.  A record that does not parse, cut off or of other types, is not read; with ``bad_path`` it is set apart
    there (file, record), and the parsed records are written once, so the files are read a single time.
    """
    reader = spark.read.option("ignoreCorruptFiles", True)
    if bad_path:
        reader = reader.schema(T.StructType([*schema, T.StructField(BAD_RECORD, T.StringType())])).option("columnNameOfCorruptRecord", BAD_RECORD)
    else:
        reader = reader.schema(schema).option("mode", "DROPMALFORMED")
    df = reader.json(path)
    if start is not None:
        df = df.filter(F.col("chunk_start") > F.date_sub(F.lit(start).cast("date"), chunk_days))
    if end is not None:
        df = df.filter(F.col("chunk_start") <= F.lit(end).cast("date"))
    if not bad_path:
        return df.select(*schema.names)
    df = checkpoint(df.withColumn("_file", F.input_file_name()), "landed")
    bad = df.filter(F.col(BAD_RECORD).isNotNull()).select(F.col("_file").alias("file"), F.col(BAD_RECORD).alias("record"))
    bad.write.mode("append").parquet(bad_path)
    return df.filter(F.col(BAD_RECORD).isNull()).select(*schema.names)


def backfill_chunks(spans: DataFrame, chunk_days: int, key: str = "city") -> DataFrame:
    """[start, end] per key -> closed chunks of ``chunk_days`` days, last one truncated."""
    if chunk_days <= 0:
        raise ValueError("chunk_days must be positive")
    step = F.expr(f"INTERVAL {int(chunk_days)} DAYS")
    ch = spans.select(key, "start_date", "end_date",
                      F.posexplode(F.sequence("start_date", "end_date", step)).alias("_i", "chunk_start"))
    return ch.select(key, (F.col("_i") + 1).cast("bigint").alias("chunk_index"), "chunk_start",
                     F.least(F.date_add("chunk_start", chunk_days - 1), F.col("end_date")).alias("chunk_end"))


def backfill_range(as_of_date, days: int):
    """end = as_of - 1 day, start = end - (days - 1)."""
    end = F.date_sub(as_of_date, 1)
    return F.date_sub(end, days - 1).alias("start_date"), end.alias("end_date")
