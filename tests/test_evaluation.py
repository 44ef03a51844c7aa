"""The evaluation job writes what it computed, and says when there is nothing to evaluate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.plans import ml as M
from airspark.plans.evaluation import evaluate
from airspark.plans.features import build_forecast_features, build_training_features
from airspark.sources.store import read_csv, registry_latest

T0 = dt.datetime(2024, 1, 1)


def test_evaluation_from_registry_to_files(spark, tmp_path):
    rows = [(c, T0 + dt.timedelta(hours=h), T0 + dt.timedelta(days=9), *[float((h * (i + 3) + len(c)) % 41) for i in range(len(S.RAW_FEATURE_COLUMNS))],
             float((h * 3) % 41)) for c in ("a", "bb") for h in range(160)]
    obs = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
                                + ", ".join(f"{c} double" for c in S.RAW_FEATURE_COLUMNS) + ", us_aqi double")
    table = build_training_features(obs)
    model = M.estimators(table, only=(M.RIDGE,))[M.RIDGE].fit(table)
    registry = M.register_model(model, table, f"{tmp_path}/registry", "m", M.RIDGE, S.MODEL_FEATURE_COLUMNS)
    row = registry_latest(registry, "m").first()
    assert row.mae is None and row.training_rows == 320
    store = build_forecast_features(obs, "2024-01-05 12:00:00")
    done = evaluate(row, store, f"{tmp_path}/out")
    hours = read_csv(spark, done.paths["hourly"], done.hourly.schema)
    assert hours.count() == store.count() == 102 and read_csv(spark, done.paths["daily"], done.daily.schema).count() == 6
    got = {(r.city, r.level): r for r in read_csv(spark, done.paths["metrics"], done.metrics.schema).collect()}
    assert set(got) == {(c, level) for c in ("a", "bb") for level in ("hourly", "daily")}
    for city in ("a", "bb"):
        errors = [abs(r.predicted_aqi - r[S.REFERENCE_COLUMN]) for r in hours.where(F.col("city") == city).collect()]
        assert got[city, "hourly"].mae == pytest.approx(sum(errors) / len(errors), abs=1e-4)
    assert {"absolute_error", "forecast_day"} <= set(hours.columns) and not {"_x", "features", "prediction"} & set(hours.columns)
    nothing = evaluate(row, store.withColumn(S.REFERENCE_COLUMN, F.lit(None).cast("double")), f"{tmp_path}/none")
    assert nothing.metrics.count() == 0 and nothing.hourly.count() == 102
    with pytest.raises(ValueError, match="No future"):
        evaluate(row, store.withColumn("is_future", F.lit(0)), f"{tmp_path}/empty")
    with pytest.raises(ValueError, match="to evaluate against"):
        evaluate(row, store.drop(S.REFERENCE_COLUMN), f"{tmp_path}/without")
