"""Sources and sinks: chunks, response arrays, geocoding, upsert, registry, quality."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from airspark.operators.quality import quality_report
from airspark.sources import landing as L
from airspark.sources import store as ST
from airspark.sources.geo import geo_resolve

T0 = dt.datetime(2024, 1, 1)


def test_backfill_chunks(spark):
    spans = spark.createDataFrame([("a", dt.date(2024, 1, 1), dt.date(2024, 6, 28)),
                                   ("b", dt.date(2024, 1, 1), dt.date(2024, 1, 10))],
                                  "city string, start_date date, end_date date")
    a = L.backfill_chunks(spans.filter("city = 'a'"), 30).orderBy("chunk_index").collect()
    assert len(a) == 6 and a[-1].chunk_end == dt.date(2024, 6, 28)
    b = L.backfill_chunks(spans.filter("city = 'b'"), 3).orderBy("chunk_index").collect()
    assert [(r.chunk_start.day, r.chunk_end.day) for r in b] == [(1, 3), (4, 6), (7, 9), (10, 10)]
    with pytest.raises(ValueError):
        L.backfill_chunks(spans, 0)


def test_backfill_range(spark):
    df = spark.createDataFrame([(dt.date(2024, 7, 1),)], "d date")
    start, end = L.backfill_range(F.col("d"), 180)
    r = df.select(start, end).first()
    assert r.end_date == dt.date(2024, 6, 30) and (r.end_date - r.start_date).days == 179


def test_response_round_trip_and_empty_error(spark):
    rows = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h), float(h), None if h == 2 else 1.0)
                                  for h in range(5)], "city string, timestamp timestamp_ntz, pm25 double, ozone double")
    rename = {"pm2_5": "pm25", "ozone": "ozone"}
    back = L.rows_from_responses(L.responses_from_rows(rows, rename, chunk_days=1), rename)
    assert sorted(map(tuple, back.select("city", "timestamp", "pm25", "ozone").collect())) == \
        sorted(map(tuple, rows.collect()))
    empty = spark.createDataFrame([("a", dt.date(2024, 1, 1), None)], "city string, chunk_start date, "
                                  "hourly struct<time: array<string>, pm2_5: array<double>, ozone: array<double>>")
    with pytest.raises(ValueError):
        L.rows_from_responses(empty, rename)


def test_geo_resolve_match_fallback_and_configured(spark):
    req = spark.createDataFrame([(1, "riverton", "norland", "east", None, None),
                                 (2, "nowhere", "norland", "east", None, None),
                                 (3, "riverton", "norland", "east", 1.5, 2.5)],
                                "request_id int, name string, country string, admin1 string, latitude double, longitude double")
    cand = spark.createDataFrame([(1, "Riverton", "Southland", "West", 17.0, 78.0, 0),
                                  (1, "Riverton", "Norland", "East", 25.4, 68.4, 1),
                                  (2, "Elsewhere", "Norland", None, 10.0, 20.0, 5),
                                  (2, "Other", "Norland", None, 11.0, 21.0, 3),
                                  (3, "Riverton", "Norland", "East", 25.4, 68.4, 0)],
                                 "request_id int, name string, country string, admin1 string, latitude double, "
                                 "longitude double, position int")
    got = {r.request_id: r for r in geo_resolve(req, cand).collect()}
    with pytest.raises(ValueError):
        geo_resolve(req, cand.where("request_id <> 2")).collect()
    assert (got[1].latitude, got[1].matched, got[1].city) == (25.4, True, "riverton")
    assert (got[2].latitude, got[2].matched) == (11.0, False)   # first candidate by position
    assert (got[3].latitude, got[3].longitude) == (1.5, 2.5)     # configured coordinates win


def _obs(spark, rows):
    return spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, x double")


def test_keyed_upsert_newest_wins_and_idempotent(spark):
    path = tempfile.mkdtemp(prefix="upsert-", dir="/tmp") + "/t"
    first = _obs(spark, [("a", T0, T0, 1.0), ("b", T0, T0, 2.0)])
    ST.keyed_upsert(first, path)
    newer = _obs(spark, [("a", T0, T0 + dt.timedelta(hours=1), 9.0),
                         ("a", T0 + dt.timedelta(hours=1), T0, 3.0)])
    once = sorted(map(tuple, ST.keyed_upsert(newer, path).collect()))
    twice = sorted(map(tuple, ST.keyed_upsert(newer, path).collect()))
    assert once == twice
    assert {(r[0], r[1]): r[3] for r in once} == {("a", T0): 9.0, ("a", T0 + dt.timedelta(hours=1)): 3.0,
                                                  ("b", T0): 2.0}


def test_registry_latest_and_merge(spark):
    reg = spark.createDataFrame([("m", 1, 1.0), ("m", 3, 3.0), ("m", 2, 2.0), ("n", 1, 5.0)],
                                "name string, version bigint, mae double")
    latest = {r.name: (r.version, r.mae) for r in ST.registry_latest(reg).collect()}
    assert latest == {"m": (3, 3.0), "n": (1, 5.0)}
    assert ST.registry_latest(reg, "m", version=2).first().mae == 2.0
    docs = spark.createDataFrame(
        [("m", 1, "Random Forest", "x", None, [" A ", "B"], 10), ("m", 2, None, "y", [" C "], None, None)],
        "name string, doc_order int, best_model_name string, model_name string, file_feature_columns array<string>, "
        "bundle_feature_columns array<string>, training_rows int")
    r = ST.registry_metadata_merge(docs).first()
    assert (r.display_name, r.model_name, r.feature_columns, r.training_rows) == ("Random Forest", "y", ["c"], 10)


def test_quality_report_strict(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0, 2.0)], "city string, timestamp timestamp_ntz, pm25_24h double")
    rep = {(r.check, r.subject): r for r in quality_report(df, features=["pm25_24h"]).collect()}
    assert rep[("duplicate_keys", "table")].status == "error"
    assert rep[("missing_columns", "table")].status == "error"
    with pytest.raises(ValueError):
        quality_report(df, features=["pm25_24h"], strict=True)


def test_keyed_upsert_month_partitions_rewrite_only_touched(spark):
    import glob
    import os
    path = tempfile.mkdtemp(prefix="upsert-m-", dir="/tmp") + "/t"
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    ST.keyed_upsert(_obs(spark, [("a", jan, jan, 1.0), ("a", feb, feb, 2.0)]), path, month_partitions=True)
    jan_files = sorted(glob.glob(f"{path}/city=a/obs_month=2024-01-01/*.parquet"))
    jan_mtime = [os.path.getmtime(f) for f in jan_files]
    out = ST.keyed_upsert(_obs(spark, [("a", feb, feb + dt.timedelta(hours=1), 5.0)]), path, month_partitions=True)
    assert sorted((r.timestamp, r.x) for r in out.collect()) == [(jan, 1.0), (feb, 5.0)]
    assert "obs_month" not in out.columns
    assert sorted(glob.glob(f"{path}/city=a/obs_month=2024-01-01/*.parquet")) == jan_files
    assert [os.path.getmtime(f) for f in jan_files] == jan_mtime  # January untouched


def test_geo_missing_admin1_is_no_match_and_half_a_pair_is_none(spark):
    req = spark.createDataFrame([(1, "riverton", "norland", "east", 5.0, None), (2, "riverton", "norland", "east", 0.0, 6.0)],
                                "request_id int, name string, country string, admin1 string, latitude double, longitude double")
    cand = spark.createDataFrame([(i, "Riverton", "Norland", a, x, x, p) for i in (1, 2)
                                  for a, x, p in ((None, 1.0, 0), ("East", 2.0, 1))],
                                 "request_id int, name string, country string, admin1 string, latitude double, "
                                 "longitude double, position int")
    got = [(r.latitude, r.longitude, r.matched) for r in geo_resolve(req, cand).collect()]
    assert got == [(2.0, 2.0, True)] * 2
    plain = [(r.latitude, r.matched) for r in geo_resolve(req, cand.drop("admin1")).collect()]
    assert plain == [(1.0, True)] * 2


def test_upsert_keeps_rows_when_the_batch_has_a_new_column(spark):
    path = tempfile.mkdtemp(prefix="upsert-", dir="/tmp") + "/t"
    ST.keyed_upsert(_obs(spark, [("a", T0 + dt.timedelta(hours=h), T0, 1.0) for h in range(5)]), path)
    new = _obs(spark, [("a", T0, T0 + dt.timedelta(days=1), 2.0)]).withColumn("y", F.lit("new"))
    got = ST.keyed_upsert(new, path).orderBy("timestamp").collect()
    assert [(r.x, r.y) for r in got] == [(2.0, "new")] + [(1.0, None)] * 4
    old = ST.keyed_upsert(_obs(spark, [("a", T0 + dt.timedelta(hours=9), T0, 3.0)]), path)
    assert old.count() == 6 and old.where("y = 'new'").count() == 1
    with pytest.raises(ValueError):
        ST.keyed_upsert(new.withColumn("x", F.lit("text")), path)
    assert ST.read_keyed(spark, path, old.schema).count() == 6


def test_upsert_keeps_city_text(spark):
    path = tempfile.mkdtemp(prefix="upsert-", dir="/tmp") + "/t"
    ST.keyed_upsert(_obs(spark, [("007", T0, T0, 1.0), ("7", T0, T0, 2.0)]), path)
    got = ST.keyed_upsert(_obs(spark, [("007", T0, T0 + dt.timedelta(days=1), 3.0)]), path).collect()
    assert sorted((r.city, r.x) for r in got) == [("007", 3.0), ("7", 2.0)]


def test_upsert_reads_only_the_batch_months(spark, capsys):
    path = tempfile.mkdtemp(prefix="upsert-", dir="/tmp") + "/t"
    rows = [("a", dt.datetime(2024, m, 2), T0, float(m)) for m in range(1, 7)]
    ST.keyed_upsert(_obs(spark, rows), path, month_partitions=True)
    batch = _obs(spark, [("a", dt.datetime(2024, 3, 2), T0 + dt.timedelta(days=1), 9.0)])
    with_month = batch.withColumn(ST.MONTH_PARTITION, F.trunc(F.to_date("timestamp"), "month"))
    schema = ST.stored_schema(spark, path, with_month.schema)
    ST.read_keyed(spark, path, schema).filter(ST.month_range(with_month)).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "2024-03-01" in plan.split("PartitionFilters")[1].split("\n")[0]
    got = ST.keyed_upsert(batch, path, month_partitions=True).orderBy("timestamp").collect()
    assert [r.x for r in got] == [1.0, 2.0, 9.0, 4.0, 5.0, 6.0]


def test_training_table_keeps_city_text(spark):
    df = spark.createDataFrame([("007", T0, 1.0), ("7", T0, 2.0)], "city string, timestamp timestamp_ntz, x double")
    path = ST.write_table(df, "train", partition_by=["city"])
    got = ST.read_training_table(spark, path, ["city", "timestamp", "x"]).collect()
    assert sorted((r.city, r.x) for r in got) == [("007", 1.0), ("7", 2.0)]


def test_quality_lists_cities_without_future_rows(spark):
    context = spark.createDataFrame([("a", T0, 0), ("b", T0, 0), ("a", T0 + dt.timedelta(days=1), 1)],
                                    "city string, timestamp timestamp_ntz, is_future long")
    table = context.where("is_future = 1").withColumn("f", F.lit(1.0))
    got = {(r.check, r.subject): (r.value, r.status) for r in quality_report(
        table, context, features=["f"], horizon=1, expected_columns=["city", "timestamp", "f"]).collect()}
    assert got["horizon_rows", "a"] == (1, "ok") and got["horizon_rows", "b"] == (0, "error")
