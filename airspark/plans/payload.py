"""Nested prediction documents: build one per city, read back into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.numeric import try_double
from ..functions.time import parse_timestamp
from ..sources.store import daily_records, hourly_records

HOURLY_FIELDS = ["timestamp STRING", "predicted_aqi DOUBLE", "aqi_category STRING",
                 f"{S.REFERENCE_COLUMN} DOUBLE"] + [f"{c} DOUBLE" for c in S.POLLUTANT_FEATURE_COLUMNS] + [
    "temperature_2m DOUBLE", "relative_humidity_2m DOUBLE", "precipitation DOUBLE", "windspeed_10m DOUBLE",
    "surface_pressure DOUBLE"]
DAILY_FIELDS = ["forecast_day BIGINT", "predicted_aqi DOUBLE", "start_time STRING", "end_time STRING",
                f"{S.REFERENCE_COLUMN} DOUBLE"] + [f"{c} DOUBLE" for c in S.POLLUTANT_FEATURE_COLUMNS] + [
    "aqi_category STRING", "advice STRING"]
POLLUTANT_FIELDS = ["name STRING", "`column` STRING", "description STRING", "value DOUBLE", "unit STRING",
                    "level STRING"]
SUMMARY_FIELDS = ["current_aqi DOUBLE", "current_category STRING", "current_advice STRING", "average_aqi_72h DOUBLE",
                  "average_category STRING", "peak_aqi_72h DOUBLE", "peak_category STRING", "forecast_hours BIGINT",
                  "start_time STRING", "end_time STRING"]
MODEL_FIELDS = ["model_name STRING", "model_version BIGINT", "best_model_name STRING", "feature_count BIGINT"]


def _names(fields):
    return [f.split(" ")[0].strip("`") for f in fields]


def prediction_payload(hourly: DataFrame, daily: DataFrame, pollutants: DataFrame, headline: DataFrame,
                       model: dict, country: str, timezone: str, max_hours: int = S.MAX_HORIZON_HOURS) -> DataFrame:
    """One JSON document per city.  Arrays are per-city horizon rows (<= 168)."""
    if not 1 <= max_hours <= S.MAX_HORIZON_HOURS:
        raise ValueError("hours must be within 1..168")
    if "forecast_hour" in hourly.columns:  # the hourly array holds at most the hours asked for
        hourly = hourly.filter(F.col("forecast_hour") <= max_hours)
    hr = hourly_records(hourly)
    hnames = [c for c in _names(HOURLY_FIELDS) if c in hr.columns]
    h = hr.groupBy("city").agg(F.array_sort(F.collect_list(F.struct(*hnames))).alias("hourly"))
    dr = daily_records(daily)
    dnames = [c for c in _names(DAILY_FIELDS) if c in dr.columns]
    d = dr.groupBy("city").agg(F.array_sort(F.collect_list(F.struct(*dnames))).alias("daily"))
    order = F.create_map(*[x for i, (_, c, _, _) in enumerate(S.POLLUTANT_COLUMNS) for x in (F.lit(c), F.lit(i))])
    p = (pollutants.withColumn("_o", order[F.col("column")])
         .groupBy("city").agg(F.array_sort(F.collect_list(F.struct("_o", *_names(POLLUTANT_FIELDS)))).alias("_p"))
         .select("city", F.transform("_p", lambda x: x.dropFields("_o")).alias("pollutants")))
    summary = F.struct(*[F.col(c) for c in headline.columns if c != "city"])
    model_struct = F.struct(F.lit(model.get("model_name")).cast("string").alias("model_name"),
                            F.lit(model.get("model_version")).cast("bigint").alias("model_version"),
                            F.lit(model.get("best_model_name")).cast("string").alias("best_model_name"),
                            F.lit(len(model.get("feature_columns", []))).cast("bigint").alias("feature_count"),
                            F.array(*[F.lit(c) for c in model.get("feature_columns", [])]).alias("feature_columns"))
    def part(name, df):  # a city without days or pollutants still has its document
        return F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)).alias(name)

    doc = (headline.join(d, "city", "left").join(h, "city", "left").join(p, "city", "left")
           .select("city", F.struct(F.lit("success").alias("status"),
                                    F.struct(F.col("city"), F.lit(country).alias("country"),
                                             F.lit(timezone).alias("timezone")).alias("location"),
                                    summary.alias("summary"), model_struct.alias("model"),
                                    part("daily", d), part("hourly", h), part("pollutants", p)).alias("doc")))
    return doc.select("city", F.to_json("doc").alias("payload"))


def _field(variant: str, path: str, kind: str):
    """One value of a document, whatever it was written as: a number may be text, and what does not parse is NULL."""
    text = F.try_variant_get(F.col(variant), path, "string")
    if kind == "DOUBLE":
        return try_double(text)
    return text.try_cast(kind)


def _documents(payloads: DataFrame, payload: str = "payload", key: str = "city") -> DataFrame:
    """(city, v): the parsed documents.  Text that is no JSON, or a status other than success, raises."""
    doc = payloads.select(key, F.try_parse_json(F.col(payload)).alias("v"))
    status = F.try_variant_get("v", "$.status", "string")
    bad = doc.where(status.isNull() | (status != "success")).select(key, status.alias("status"))
    shown = bad.limit(5).collect()
    if shown:
        raise ValueError(f"Unsuccessful payload status, of them {[tuple(r) for r in shown]}")
    return doc


def _array(doc: DataFrame, name: str, fields) -> DataFrame:
    """The rows of one array of the documents, typed; a missing array has no rows, a missing field is NULL."""
    rows = doc.select("city", F.explode(F.try_variant_get("v", f"$.{name}", "array<variant>")).alias("x"))
    typed = [(f.rsplit(" ", 1)[0].strip("`"), f.rsplit(" ", 1)[1]) for f in fields]
    return rows.select("city", *[_field("x", f"$.{c}", kind).alias(c) for c, kind in typed])


def payload_read(payloads: DataFrame):
    """Payload JSON -> (hourly, daily, pollutants) tables with typed columns.

    Documents are read as VARIANT: numbers may be written as text, unparsable values become NULL, absent arrays and
    fields are allowed.  A status other than success raises, and so does a document without hourly rows.
    """
    doc = _documents(payloads)
    hours = F.coalesce(F.size(F.try_variant_get("v", "$.hourly", "array<variant>")), F.lit(0))
    if not doc.where(hours <= 0).isEmpty():
        raise ValueError("Payload has no hourly prediction rows.")
    hourly = _array(doc, "hourly", HOURLY_FIELDS).withColumn("timestamp", parse_timestamp("timestamp"))
    daily = _array(doc, "daily", DAILY_FIELDS).withColumns({c: parse_timestamp(c) for c in ("start_time", "end_time")})
    return hourly, daily, _array(doc, "pollutants", POLLUTANT_FIELDS)


def payload_head(payloads: DataFrame) -> DataFrame:
    """One row per document: status, location, summary and model parts, and the lengths of its arrays."""
    doc = _documents(payloads)
    parts = [("$.status", "status", "STRING"), ("$.location.country", "country", "STRING"), ("$.location.timezone", "timezone", "STRING")]
    for part, fields in (("summary", SUMMARY_FIELDS), ("model", MODEL_FIELDS)):
        parts += [(f"$.{part}.{c}", c, kind) for c, kind in (f.split(" ") for f in fields)]
    sizes = {"hours": "$.hourly", "days": "$.daily", "pollutants": "$.pollutants", "features": "$.model.feature_columns"}
    return doc.select("city", *[_field("v", path, kind).alias(c) for path, c, kind in parts],
                      *[F.size(F.try_variant_get("v", path, "array<variant>")).cast("bigint").alias(c) for c, path in sizes.items()])
