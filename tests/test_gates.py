"""Empty results and faulty tables raise before they are written on; text input works; no name is defined twice."""

import ast
import datetime as dt
import pathlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.operators.clean import training_clean
from airspark.operators.forecast import prepare_scoring
from airspark.plans.features import build_forecast_features, build_training_features

ROOT = pathlib.Path(__file__).resolve().parents[1]
SCHEMA = ("city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
          + ", ".join(f"{c} double" for c in S.RAW_FEATURE_COLUMNS) + ", us_aqi double")
AS_OF = "2024-01-05 12:00:00"


def observations(spark, hours=150):
    rows = [(city, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), dt.datetime(2024, 1, 9),
             *[float((h * (i + 3)) % 50) for i in range(len(S.RAW_FEATURE_COLUMNS))], float(h)) for city in "ab" for h in range(hours)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("path", sorted(ROOT.glob("airspark/**/*.py")), ids=lambda p: p.name)
def test_no_module_defines_a_name_twice(path):
    names = Counter(n.name for n in ast.parse(path.read_text()).body if isinstance(n, (ast.FunctionDef, ast.ClassDef)))
    assert not [n for n, k in names.items() if k > 1]


def test_builds_take_text(spark):
    obs = observations(spark)
    text = obs.withColumns({c: F.when(F.hour("timestamp") == 3, F.lit("n/a")).otherwise(F.col(c).cast("string")) for c in S.RAW_FEATURE_COLUMNS})
    blank = obs.withColumns({c: F.when(F.hour("timestamp") != 3, F.col(c)) for c in S.RAW_FEATURE_COLUMNS})
    for build in (build_training_features, lambda df: build_forecast_features(df, AS_OF),
                  lambda df: build_forecast_features(df, AS_OF, bounded=False)):
        got, want = build(text), build(blank)
        assert want.count() and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_empty_results_raise(spark):
    obs = observations(spark, 30)
    with pytest.raises(ValueError, match="No future rows"):
        build_forecast_features(obs, AS_OF)
    with pytest.raises(ValueError, match="No rows left"):
        build_training_features(obs.filter(F.lit(False)))
    with pytest.raises(ValueError, match="No rows left"):
        build_training_features(obs.limit(0))
    table = build_training_features(obs)
    assert training_clean(table).count() == 60
    with pytest.raises(ValueError, match="No rows left"):
        training_clean(table.withColumn("us_aqi", F.lit(None).cast("double")))
    store = build_forecast_features(observations(spark), AS_OF)
    assert prepare_scoring(store, timezone="UTC").count() == store.count() > 0
    with pytest.raises(ValueError, match="No future forecast rows"):
        prepare_scoring(store.withColumn("is_future", F.lit(0)), timezone="UTC")


def test_the_forecast_build_validates(spark):
    obs = observations(spark).withColumn("pm10", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="feature_nulls.*pm10_24h"):
        build_forecast_features(obs, AS_OF)
    assert build_forecast_features(obs, AS_OF, validate=False).count() > 0
