"""The indexed store equals the full build after late and corrected rows, and does not read history."""

import datetime as dt
import pathlib

import numpy as np
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.plans.features import build_forecast_features, build_training_features
from airspark.plans.incremental import BUCKET, FeatureStore

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
          + ", ".join(f"{c} double" for c in S.RAW_FEATURE_COLUMNS) + ", us_aqi double")


def rows(cities, hours, run, seed, gaps=0.3):
    r = np.random.default_rng(seed)
    out = []
    for city in cities:
        for h in hours:
            vals = [None if r.random() < gaps else float(r.integers(0, 80)) for _ in S.RAW_FEATURE_COLUMNS]
            if city == "007" and 100 < h < 900:
                vals[0] = None  # a gap that spans several buckets
            if city == "7" and h < 400:
                vals[1] = None  # a leading gap, filled backward
            out.append((city, T0 + dt.timedelta(hours=int(h)), T0 + dt.timedelta(days=90, hours=run), *vals, float(h % 300)))
    return out


def same(a, b):
    a, b = a.select(*b.columns), b
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_updates_equal_the_full_build(spark, tmp_path):
    store = FeatureStore(spark, f"{tmp_path}/store", grain="week")
    first = [h for h in range(40, 1200) if h % 11 and not 300 < h < 420]
    runs = [
        rows(["007", "7"], first, 1, 1),
        rows(["7"], range(1200, 1230), 2, 2),                     # a new hour or more: the last buckets only
        rows(["007"], [h for h in range(305, 400, 7)], 3, 3),      # late rows
        rows(["007"], [120, 121], 4, 4, gaps=0.0),                 # a correction that ends a long gap
        rows(["7"], [10, 11, 12], 5, 5, gaps=0.0),                 # before the first row: back fill changes
        rows(["new"], range(600, 640), 6, 6),
        rows(["7"], [1229], 0, 7),                                 # an older run: loses
    ]
    since, seen = [], []
    for run in runs:
        seen += run
        batch = spark.createDataFrame(run, SCHEMA)
        changed = store.update(batch)
        since.append({r.city: r._since for r in changed.collect()})
        same(store.training_features(), build_training_features(spark.createDataFrame(seen, SCHEMA)))
    monday = lambda h: (T0 + dt.timedelta(hours=h) - dt.timedelta(days=(T0 + dt.timedelta(hours=h)).weekday())).date()
    assert since[1] == {"7": monday(1200)} and since[2] == {"007": monday(305)} and since[3] == {"007": monday(120)}
    assert since[4] == {"7": monday(10)} and since[5] == {"new": monday(600)}
    again = store.update(spark.createDataFrame(runs[2], SCHEMA))  # a repeated run changes nothing
    assert again.count() == 1
    same(store.training_features(), build_training_features(spark.createDataFrame(seen, SCHEMA)))
    assert store.update(spark.createDataFrame([], SCHEMA)) is None


def test_a_run_that_dies_before_its_index_is_repeated(spark, tmp_path, monkeypatch):
    store = FeatureStore(spark, f"{tmp_path}/store", grain="week")
    first, late = rows(["7"], range(60, 700), 1, 1), rows(["7"], [5, 6, 300], 2, 2, gaps=0.0)
    store.update(spark.createDataFrame(first, SCHEMA))

    def dies(entries):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_write_index", dies)
        try:
            store.update(spark.createDataFrame(late, SCHEMA))
        except RuntimeError:
            pass
    store.update(spark.createDataFrame(late, SCHEMA))
    same(store.training_features(), build_training_features(spark.createDataFrame(first + late, SCHEMA)))


def test_forecast_from_the_index_reads_no_history(spark, tmp_path):
    store = FeatureStore(spark, f"{tmp_path}/store", grain="week")
    every = rows(["007", "7"], range(0, 1500), 1, 8)
    store.observe(spark.createDataFrame(every, SCHEMA))
    as_of = T0 + dt.timedelta(hours=1400)
    want = build_forecast_features(spark.createDataFrame(every, SCHEMA), as_of, bounded=False)
    cities = spark.createDataFrame([("007",), ("7",)], "city string")
    same(store.forecast_features(cities, as_of), want)
    # A city that no longer reports, and one whose 23 rows lie far back.
    old = [h for h in range(700, 1000, 40)] + list(range(1401, 1410))
    sparse = rows(["far"], old, 1, 9)
    store.observe(spark.createDataFrame(sparse, SCHEMA))
    want = build_forecast_features(spark.createDataFrame(sparse, SCHEMA), as_of, bounded=False)
    same(store.forecast_features(spark.createDataFrame([("far",)], "city string"), as_of), want)
    # History is damaged beyond reading; the first folder stays, for the schema is read there.
    folders = sorted(pathlib.Path(f"{tmp_path}/store/observations/city=7").glob(f"{BUCKET}=*"))
    for folder in folders[1:-4]:
        for f in folder.glob("*.parquet"):
            f.write_bytes(b"no parquet")
    late = rows(["7"], [1390], 9, 10, gaps=0.0)  # a correction of a recent hour
    store.observe(spark.createDataFrame(late, SCHEMA))
    want = build_forecast_features(spark.createDataFrame(every + late, SCHEMA).where("city = '7'"), as_of, bounded=False)
    same(store.forecast_features(cities.where("city = '7'"), as_of), want)
    assert store.table("observations").where(F.col("city") == "007").count() == 1500
