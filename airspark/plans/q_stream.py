"""Streaming queries: land the fixture's responses, stream them in, read the result."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from .. import schemas as S
from ..operators.forecast import predict_api, standin_score
from ..operators.clean import round_doubles
from ..session import scratch_path
from ..sources import fixture as FX
from ..sources import landing as L
from ..sources.store import MONTH_PARTITION, read_keyed, stored_schema
from ..streaming.ingest import landed_responses, score_touched, stream_ingest
from .catalog import register
from .incremental import FeatureStore
from .q_core import DD_CTES, RAW_DBL, sql
from .q_scoring import API, HR_COLS

INGEST_COLS = ["city", "timestamp"] + S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN, "ingestion_timestamp"]


def _land(spark, sf_dir, landing):
    """Run 1: every hour; run 2: corrected hours (emax % 7 == 0, pm25 + 1)."""
    h = FX.hourly_seed(spark, sf_dir)
    air, weather = FX.air_rows(h), FX.weather_rows(h)
    raw_keys = air.join(weather.select("city", "timestamp"), ["city", "timestamp"])
    air2 = raw_keys.filter(F.col("emax") % 7 == 0).withColumn("pm25", F.col("pm25") + F.lit(1.0))
    w2 = weather.join(air2.select("city", "timestamp"), ["city", "timestamp"], "left_semi")
    for kind, rows, rename, run in (("air", air, L.AIR_RENAME, 1), ("weather", weather, L.WEATHER_RENAME, 1),
                                    ("air", air2, L.AIR_RENAME, 2), ("weather", w2, L.WEATHER_RENAME, 2)):
        resp = L.responses_from_rows(rows, rename, chunk_days=7)
        landed_responses(resp, kind, FX.RUN_TIMESTAMPS[run]).write.mode("append").json(f"{landing}/run{run}-{kind}")


def _run(spark, sf_dir, scorer=None):
    base = scratch_path(spark, "stream")
    landing, stage, cp, preds = (f"{base}/{p}" for p in ("landing", "stage", "checkpoint", "preds"))
    store = FeatureStore(spark, f"{base}/store", grain="week")
    _land(spark, sf_dir, landing)
    on_batch = score_touched(store, preds, FX.AS_OF, scorer) if scorer else None
    stream_ingest(spark, f"{landing}/*", store, stage, cp, on_batch=on_batch, max_files_per_trigger=16)
    return store, preds


@register("stream_ingest", sql(DD_CTES, INGEST_COLS, "dd", RAW_DBL))
def q_stream_ingest(spark, sf_dir):
    store, _ = _run(spark, sf_dir)
    return round_doubles(store.table("observations").select(*INGEST_COLS))


@register("stream_score", sql(API, HR_COLS, "api", set(HR_COLS) - {"city", "timestamp", "aqi_category"}))
def q_stream_score(spark, sf_dir):
    _, preds = _run(spark, sf_dir, scorer=lambda fc: predict_api(fc, standin_score()))
    declared = T.StructType([T.StructField("city", T.StringType()), T.StructField(MONTH_PARTITION, T.DateType())])
    return round_doubles(read_keyed(spark, preds, stored_schema(spark, preds, declared)).select(*HR_COLS))
