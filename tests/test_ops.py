"""Edge tables for classification, cleaning, split, metrics and forecast ops."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airspark.functions.classify import aqi_advice, aqi_category, pollutant_level_for
from airspark.functions.numeric import clip, np_round, try_double
from airspark.operators.clean import dedupe_keep_last, normalize_columns
from airspark.operators.forecast import horizon_rows, latest_run
from airspark.operators.split import time_split
from airspark.operators.summarize import regression_metrics

T0 = dt.datetime(2024, 1, 1)


def test_aqi_category_edges(spark):
    vals = [None, 0.0, 50.0, 50.1, 100.0, 150.0, 200.0, 300.0, 300.1, 500.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(aqi_category("v")).collect()]
    assert got == ["Unknown", "Good", "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups",
                   "Unhealthy", "Very Unhealthy", "Hazardous", "Hazardous", "Unknown"]


def test_advice_fallback_and_dashboard(spark):
    df = spark.createDataFrame([("Good",), ("nope",)], "c string")
    api = [r[0] for r in df.select(aqi_advice("c")).collect()]
    dash = [r[0] for r in df.select(aqi_advice("c", dashboard=True)).collect()]
    assert api[1] == "AQI status unavailable." and api[0] != dash[0]


@pytest.mark.parametrize("col,edge,label,above", [
    ("pm25_24h", 9.0, "Good", "Moderate"), ("pm10_24h", 424, "Very Unhealthy", "Hazardous"),
    ("o3_8h_ppb", 70, "Moderate", "Unhealthy for Sensitive Groups"), ("co_8h_ppm", 15.4, "Unhealthy", "Very Unhealthy"),
    ("no2_1h_ppb", 360, "Unhealthy for Sensitive Groups", "Unhealthy")])
def test_pollutant_level_edges(spark, col, edge, label, above):
    df = spark.createDataFrame([(float(edge),), (float(edge) + 0.01,)], "v double")
    assert [r[0] for r in df.select(pollutant_level_for(col, "v")).collect()] == [label, above]


def test_pollutant_level_unknown_column(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(pollutant_level_for("temperature_2m", "v")).collect()] == ["Measured", "Unknown"]


def test_clip_keeps_null_and_round_half_even(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (700.0,), (0.25,), (0.35,)], "v double")
    assert [r[0] for r in df.select(clip("v", 0, 500)).collect()] == [None, 0.0, 500.0, 0.25, 0.35]
    assert [r[0] for r in df.select(np_round("v", 1)).collect()][3] == 0.2


def test_try_double(spark):
    df = spark.createDataFrame([("abc",), ("nan",), (" 5 ",), ("",), ("1e3",)], "s string")
    assert [r[0] for r in df.select(try_double("s")).collect()] == [None, None, 5.0, None, 1000.0]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` PM25 ` int, `Relative-Humidity 2m` int")
    assert normalize_columns(df).columns == ["pm25", "relative_humidity_2m"]


def test_dedupe_keep_last(spark):
    df = spark.createDataFrame([("a", T0, T0, 1.0), ("a", T0, T0 + dt.timedelta(hours=1), 2.0),
                                ("b", T0, T0, 3.0)], "city string, timestamp timestamp_ntz, "
                                                     "ingestion_timestamp timestamp_ntz, x double")
    got = {r.city: r.x for r in dedupe_keep_last(df).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def _ts_rows(spark, n, cities=("a",)):
    rows = [(c, T0 + dt.timedelta(hours=i)) for i in range(n) for c in cities]
    return spark.createDataFrame(rows, "city string, timestamp timestamp_ntz")


def test_time_split_sizes_and_errors(spark):
    with pytest.raises(ValueError):
        time_split(_ts_rows(spark, 1))
    got = time_split(_ts_rows(spark, 5)).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 4, "test": 1}
    two = time_split(_ts_rows(spark, 2, ("a", "b"))).orderBy("timestamp", "city").collect()
    assert [r.split for r in two] == ["train", "train", "train", "test"]


def test_regression_metrics_r2_edges(spark):
    perfect = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "y double, p double")
    off = spark.createDataFrame([(5.0, 5.0), (5.0, 6.0)], "y double, p double")
    one = spark.createDataFrame([(5.0, 4.0)], "y double, p double")
    assert regression_metrics(perfect, "y", "p").first()["r2"] == 1.0
    assert regression_metrics(off, "y", "p").first()["r2"] == 0.0
    r = regression_metrics(one, "y", "p").first()
    assert r["r2"] is None and r["rows"] == 1 and r["mae"] == 1.0


def test_latest_run_variants(spark):
    base = [("a", T0, T0, None, 1.0), ("a", T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=2), None, 2.0)]
    df = spark.createDataFrame(base, "city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
                                     "forecast_run_timestamp timestamp_ntz, x double")
    # forecast run column all NULL -> falls back to ingestion time
    assert [r.x for r in latest_run(df).collect()] == [2.0]
    # no run columns -> no filter
    assert latest_run(df.drop("ingestion_timestamp", "forecast_run_timestamp")).count() == 2


def test_horizon_rows_bounds(spark):
    df = _ts_rows(spark, 5, ("a", "b"))
    assert horizon_rows(df, 72).count() == 10
    assert horizon_rows(df, 3).count() == 6
    with pytest.raises(ValueError):
        horizon_rows(df, 169)
    _ = F


def test_nan_is_missing_in_clip_fill_prediction_and_scoring(spark):
    from airspark.operators.forecast import predict_api, prepare_scoring
    from airspark.operators.series import fill_gaps
    from airspark import schemas as S
    nan = float("nan")
    df = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h), v) for h, v in enumerate([nan, 2.0, nan, 900.0])],
                               "city string, timestamp timestamp_ntz, x double")
    assert [r[0] for r in df.select(clip("x", 0.0, 500.0)).collect()] == [None, 2.0, None, 500.0]
    assert [r.x for r in fill_gaps(df, ["x"]).orderBy("timestamp").collect()] == [2.0, 2.0, 2.0, 900.0]
    got = [(r.predicted_aqi, r.aqi_category) for r in predict_api(df, F.col("x")).orderBy("timestamp").collect()]
    assert got[0] == (None, "Unknown") and got[3] == (500.0, "Hazardous")
    store = df.select("city", "timestamp", F.lit(1).alias("is_future"), F.lit(T0).alias("ingestion_timestamp"),
                      *[F.col("x").alias(c) for c in S.BASE_MODEL_FEATURE_COLUMNS])
    out = prepare_scoring(store, S.BASE_MODEL_FEATURE_COLUMNS, timezone="UTC").orderBy("timestamp").collect()
    assert [r[S.BASE_MODEL_FEATURE_COLUMNS[0]] for r in out] == [451.0, 2.0, 451.0, 900.0]


def test_training_build_takes_nan_as_missing(spark):
    from airspark import schemas as S
    from airspark.plans.features import build_training_features
    nan = float("nan")
    cols = S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN]
    rows = [("a", T0 + dt.timedelta(hours=h), T0, *[nan if h == 2 else 10.0] * len(cols)) for h in range(4)]
    obs = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
                                + ", ".join(f"{c} double" for c in cols))
    got = build_training_features(obs.select("*", *[F.lit(None).cast("string").alias(c) for c in ("country",)
                                                    if c in S.TRAINING_OUTPUT_COLUMNS])).orderBy("timestamp").collect()
    assert len(got) == 4 and [r.pm25 for r in got] == [10.0] * 4 and [r.pm25_24h for r in got] == [10.0] * 4


def test_keep_last_ties_are_broken_by_values(spark):
    rows = [("a", T0, T0, float(i % 50)) for i in range(200)]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, x double")
        assert [r.x for r in dedupe_keep_last(df.repartition(parts)).collect()] == [49.0]
