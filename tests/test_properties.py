
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.functions.classify import aqi_category
from airspark.operators.clean import clip_bounds
from airspark.operators.split import time_split
from airspark.sources import landing as L

ORDER = [lab for _, lab in S.AQI_CATEGORY_EDGES] + [S.AQI_TOP_CATEGORY]
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.one_of(st.none(), st.floats(-1e4, 1e5, allow_nan=False)), min_size=1, max_size=30)


@SETTINGS
@given(values)
def test_clip_is_idempotent_and_keeps_nulls(spark, xs):
    df = spark.createDataFrame([(x, x) for x in xs], "pm25 double, ozone double")
    once = clip_bounds(df)
    twice = clip_bounds(once)
    assert once.collect() == twice.collect()
    assert [r.pm25 is None for r in once.collect()] == [x is None for x in xs]


@SETTINGS
@given(st.lists(st.floats(0, 600, allow_nan=False), min_size=2, max_size=30))
def test_categories_are_monotone(spark, xs):
    df = spark.createDataFrame([(x,) for x in sorted(xs)], "v double")
    ranks = [ORDER.index(r[0]) for r in df.select(aqi_category("v")).collect()]
    assert ranks == sorted(ranks)


@SETTINGS
@given(st.integers(2, 40), st.integers(1, 4))
def test_split_partitions_rows(spark, hours, cities):
    rows = [(f"c{c}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for h in range(hours) for c in range(cities)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz")
    n = len(rows)
    if int(n * 0.8) in (0, n):
        return
    out = time_split(df)
    got = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert got == {"train": int(n * 0.8), "test": n - int(n * 0.8)}
    last_train = out.filter(F.col("split") == "train").agg(F.max(F.struct("timestamp", "city"))).first()[0]
    first_test = out.filter(F.col("split") == "test").agg(F.min(F.struct("timestamp", "city"))).first()[0]
    assert tuple(last_train) < tuple(first_test)


def test_forecast_flavour_renames_reference(spark):
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
                                 "city string, timestamp timestamp_ntz, pm25 double, pm10 double, "
                                 "carbon_monoxide double, nitrogen_dioxide double, ozone double, us_aqi double")
    resp = L.responses_from_rows(rows, L.AIR_RENAME)
    back = L.rows_from_responses(resp, L.FORECAST_AIR_RENAME)
    assert S.REFERENCE_COLUMN in back.columns and "us_aqi" not in back.columns
    assert back.first()[S.REFERENCE_COLUMN] == 6.0
