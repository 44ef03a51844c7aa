"""Incremental ingestion and scoring as Structured Streaming jobs.

Landed response files (air and weather, several runs) are read with a file
``readStream``.  No watermark drops late files: a run that lands hours or
days late, or lands twice, is absorbed by the keyed upsert.  Each
micro-batch, in ``foreachBatch``:

1. its responses become rows, upserted into two keyed tables holding the
   newest air and the newest weather row per (city, timestamp) (upserts are
   idempotent, so a retried batch is harmless, and storage is bounded by
   the keys, not by the number of batches);
2. for the keys the batch touches, the two sides are joined and upserted
   into the observation table (an hour whose other side has not landed yet
   joins when it arrives);
3. optionally, forecast features of those cities are recomputed and
   scored into the prediction table.  The store's index of bucket summaries
   says from which bucket on the 24-row windows read and which values come
   before it, so neither a new nor a late row makes the job scan history,
   and the result equals a full recompute.

``trigger(availableNow=True)`` processes everything landed and stops; the
checkpoint folder lets a restarted job resume exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas as S
from ..plans.incremental import FeatureStore
from ..sources import landing as L
from ..sources.store import MONTH_PARTITION, keyed_upsert, month_range, read_keyed, stored_schema, table_exists

LANDED_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("chunk_start", T.DateType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in S.AIR_RESPONSE_VARIABLES + S.WEATHER_RESPONSE_VARIABLES])),
])


def landed_responses(responses: DataFrame, kind: str, run_ts: str) -> DataFrame:
    """Tag responses for landing: kind + run time; absent variables as NULL arrays."""
    hourly = F.struct(F.col("hourly.time").alias("time"), *[
        (F.col(f"hourly.{v}") if v in responses.schema["hourly"].dataType.fieldNames()
         else F.lit(None).cast("array<double>")).alias(v)
        for v in S.AIR_RESPONSE_VARIABLES + S.WEATHER_RESPONSE_VARIABLES])
    return responses.select(F.lit(kind).alias("kind"), "city", "chunk_start",
                            F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"), hourly.alias("hourly"))


def _rows(batch: DataFrame, kind: str, rename: dict) -> DataFrame:
    rows = L.rows_from_responses(batch.filter(F.col("kind") == kind), rename, validate=False, extra=["run_ts"])
    return rows.withColumnRenamed("run_ts", "ingestion_timestamp")


def _month_schema(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.schema, T.StructField(MONTH_PARTITION, T.DateType())])


def stream_ingest(spark: SparkSession, landing_path: str, store: FeatureStore, stage_path: str,
                  checkpoint_path: str, on_batch=None, max_files_per_trigger: int | None = None):
    """Run the ingestion stream into the store's observations (availableNow); returns the query."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing_path)

    def process(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            air = _rows(batch, "air", L.AIR_RENAME)
            weather = _rows(batch, "weather", L.WEATHER_RENAME)
            key = ["city", "timestamp"]
            keys = air.select(*key).union(weather.select(*key)).distinct()
            if keys.isEmpty():
                return
            # Newest row per key and kind: keyed tables, so a replayed batch
            # upserts the same rows again and storage is bounded by the keys.
            for kind, rows in (("air", air), ("weather", weather)):
                if not rows.isEmpty():
                    keyed_upsert(rows, f"{stage_path}/{kind}", month_partitions=True)
            months = month_range(keys.withColumn(MONTH_PARTITION, F.trunc(F.to_date("timestamp"), "month")))
            sides = {}
            for kind, rows in (("air", air), ("weather", weather)):
                path = f"{stage_path}/{kind}"
                if not table_exists(spark, path):
                    return  # that side has not arrived yet; its hours join when it does
                schema = stored_schema(spark, path, _month_schema(rows))
                sides[kind] = (read_keyed(spark, path, schema).filter(months).drop(MONTH_PARTITION)
                               .join(keys, key, "left_semi"))
            # A joined row is as new as the newer of its sides, so a correction of either one wins.
            weather_side = sides["weather"].withColumnRenamed("ingestion_timestamp", "_weather_run")
            joined = (sides["air"].join(weather_side, key, "inner")
                      .withColumn("ingestion_timestamp", F.greatest("ingestion_timestamp", "_weather_run"))
                      .drop("_weather_run"))
            store.observe(joined)
            if on_batch is not None:
                on_batch(keys.select("city").distinct(), batch_id)
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def score_touched(store: FeatureStore, predictions_path: str, as_of, scorer, horizon: int = 72):
    """Return an ``on_batch`` callback that rescores the touched cities from the store's index."""
    def on_batch(touched: DataFrame, batch_id: int):
        if store.table("index") is None:
            return  # no hour has both its sides yet
        fc = store.forecast_features(touched, as_of, horizon)
        keyed_upsert(scorer(fc), predictions_path, order=("forecast_run_timestamp", "ingestion_timestamp"),
                     month_partitions=True)

    return on_batch
