"""Documents: tolerant reading, status, and parts that a city lacks."""

import json

import pytest

from airspark import schemas as S
from airspark.plans import payload as P


def frame(spark, *docs):
    rows = [(f"c{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "city string, payload string")


HOUR = {"timestamp": "2024-01-01 05:00:00", "predicted_aqi": 75.1, "aqi_category": "Moderate"}


def test_numbers_may_be_text(spark):
    docs = [{"status": "success", "hourly": [HOUR, {**HOUR, "predicted_aqi": "75.1", "pm25_24h": " 3e1 ", "precipitation": "n/a"},
                                             {**HOUR, "predicted_aqi": None, "pm25_24h": "NaN", "timestamp": "bad"}]},
            {"status": "success", "hourly": [HOUR], "daily": [{"forecast_day": "2", "predicted_aqi": "9", "start_time": "2024-01-01T00:00"}],
             "pollutants": [{"column": "pm25_24h", "value": "1.5", "level": "Good"}, {"column": "x", "value": {"odd": 1}}]}]
    hourly, daily, pollutants = (df.collect() for df in P.payload_read(frame(spark, *docs)))
    assert [(r.predicted_aqi, r.pm25_24h, r.precipitation, r.timestamp is None) for r in hourly if r.city == "c0"] == [
        (75.1, None, None, False), (75.1, 30.0, None, False), (None, None, None, True)]
    assert [(r.city, r.forecast_day, r.predicted_aqi, r.start_time.day, r.end_time) for r in daily] == [("c1", 2, 9.0, 1, None)]
    assert [(r["column"], r.value, r.level) for r in pollutants] == [("pm25_24h", 1.5, "Good"), ("x", None, None)]


@pytest.mark.parametrize("doc", [{"status": "error", "hourly": [HOUR]}, {"hourly": [HOUR]}, "no json", "[]", "null"])
def test_other_states_raise(spark, doc):
    with pytest.raises(ValueError, match="status"):
        P.payload_read(frame(spark, {"status": "success", "hourly": [HOUR]}, doc))


@pytest.mark.parametrize("hourly", [[], None, "text", {"a": 1}])
def test_documents_without_hours_raise(spark, hourly):
    with pytest.raises(ValueError, match="no hourly"):
        P.payload_read(frame(spark, {"status": "success", "hourly": hourly}))


def test_a_city_without_pollutants_keeps_its_document(spark):
    from airspark.operators import summarize as SU
    hourly = spark.createDataFrame([("a", i, i + 1, 1, 50.0 + i, "Good", 3.0) for i in range(3)],
                                   "city string, h int, forecast_hour int, forecast_day int, predicted_aqi double, aqi_category string, pm25_24h double")
    hourly = hourly.selectExpr("city", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h) AS timestamp", "forecast_hour",
                               "forecast_day", "predicted_aqi", "aqi_category", "pm25_24h")
    pollutants = SU.pollutant_summary(hourly)
    docs = P.prediction_payload(hourly, SU.daily_summary_api(hourly).limit(0), pollutants.limit(0), SU.headline_summary(hourly),
                                {"model_name": "m", "feature_columns": S.MODEL_FEATURE_COLUMNS}, "land", "UTC")
    head = P.payload_head(docs).first()
    assert (head.status, head.hours, head.days, head.pollutants, head.features) == ("success", 3, 0, 0, 19)
    assert (head.current_aqi, head.peak_aqi_72h, head.model_version) == (50.0, 52.0, None)
