"""Streamed ingestion equals the batch keep-newest result."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.plans.incremental import FeatureStore
from airspark.sources import landing as L
from airspark.streaming.ingest import landed_responses, stream_ingest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_stream_equals_batch(spark):
    from airspark.plans.q_core import q_dedupe_keep_last
    from airspark.plans.q_stream import INGEST_COLS, q_stream_ingest
    streamed = q_stream_ingest(spark, SF).select(*INGEST_COLS)
    batch = q_dedupe_keep_last(spark, SF).select(*INGEST_COLS)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


T0 = dt.datetime(2024, 1, 1)


def _land(spark, path, kind, run, hours, value):
    rename = L.AIR_RENAME if kind == "air" else L.WEATHER_RENAME
    cols = list(rename.values())
    rows = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h), *[float(value)] * len(cols)) for h in hours],
                                 "city string, timestamp timestamp_ntz, " + ", ".join(f"{c} double" for c in cols))
    resp = landed_responses(L.responses_from_rows(rows, rename, chunk_days=1), kind, run)
    resp.coalesce(1).write.mode("append").json(f"{path}/landing")


def test_late_runs_and_weather_only_corrections_land(spark):
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    store = FeatureStore(spark, f"{base}/store")
    args = (f"{base}/landing", store, f"{base}/stage", f"{base}/checkpoint")
    for kind in ("air", "weather"):
        _land(spark, base, kind, "2024-01-02 12:00:00", range(3), 1)
    stream_ingest(spark, *args)
    for kind in ("air", "weather"):  # a run eight hours older, with hours never seen before
        _land(spark, base, kind, "2024-01-02 04:00:00", range(2, 6), 2)
    stream_ingest(spark, *args)
    pm, temp = S.RAW_AIR_QUALITY_COLUMNS[0], S.RAW_WEATHER_COLUMNS[0]
    got = [(r[pm], r[temp]) for r in store.table("observations").orderBy("timestamp").collect()]
    assert got == [(1.0, 1.0)] * 3 + [(2.0, 2.0)] * 3
    _land(spark, base, "weather", "2024-01-03 00:00:00", [1], 7)
    stream_ingest(spark, *args)
    row = store.table("observations").where(F.col("timestamp") == F.lit(T0 + dt.timedelta(hours=1))).first()
    assert (row[pm], row[temp]) == (1.0, 7.0) and str(row["ingestion_timestamp"]) == "2024-01-03 00:00:00"
