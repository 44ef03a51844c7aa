"""Scoring path, summaries and metrics over the forecast store (oracle-checked).

The model is replaced by a deterministic stand-in score (FIXTURES.md §4)
so every aggregate can be compared with SQL; the Spark ML path is in
``q_ml``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.classify import aqi_advice, pollutant_level_for
from ..operators import forecast as FO
from ..operators import summarize as SU
from ..operators.clean import round_doubles
from ..sources import fixture as FX
from . import oracle as O
from .catalog import register
from ..sources.store import read_forecast_table, write_forecast_run
from .q_core import forecast_context, out, sql, training_table

REF = S.REFERENCE_COLUMN
FOUT = S.FORECAST_OUTPUT_COLUMNS
POLL = S.POLLUTANT_FEATURE_COLUMNS


def forecast_store(spark, sf_dir):
    """Two snapshots of the forecast table: an older run and the current one."""
    ctx = forecast_context(spark, sf_dir)
    cur = ctx.withColumn("forecast_run_timestamp", F.lit(FX.RUN_TIMESTAMPS[2]).cast("timestamp_ntz"))
    old = ctx.withColumns({"forecast_run_timestamp": F.lit(O.OLD_RUN).cast("timestamp_ntz"),
                           REF: F.col(REF) + F.lit(1.0)})
    return cur.unionByName(old)


def stored_forecast(spark, sf_dir, newest_days=None):
    """The snapshots in the run-date layout, read back."""
    path = write_forecast_run(forecast_store(spark, sf_dir))
    return read_forecast_table(spark, path, newest_days)


def prepared(spark, sf_dir):
    return FO.prepare_scoring(stored_forecast(spark, sf_dir, newest_days=0), horizon=72, timezone=FX.CITY_TIMEZONE)


def scored_api(spark, sf_dir):
    return FO.forecast_position(FO.predict_api(prepared(spark, sf_dir), FO.standin_score()))


def scored_eval(spark, sf_dir):
    return FO.predict_eval(prepared(spark, sf_dir), FO.standin_score())


SC = O.scoring_ctes()
API = O.api_ctes()
EV = O.eval_ctes()


@register("prepare_scoring", sql(SC, FOUT, "prep"))
def q_prepare_scoring(spark, sf_dir):
    return out(prepared(spark, sf_dir).select(*FOUT))


@register("src_forecast_table", sql(SC, FOUT, "store"))
def q_src_forecast_table(spark, sf_dir):
    """Forecast table written to the shared folder and read back whole."""
    return out(stored_forecast(spark, sf_dir).select(*FOUT))


CR_COLS = ["city", "timestamp", "raw_score", "predicted_aqi_api", "predicted_aqi_eval"]


@register("clip_round_prediction", sql(SC + [
    f"c AS (SELECT city, timestamp, {O.STANDIN_SQL} AS raw_score, "
    f"round_even({O.clip_sql(O.STANDIN_SQL, 0, 500)} * 1e1, 0) / 1e1 AS predicted_aqi_api, "
    f"round_even({O.clip_sql(O.STANDIN_SQL, 0, 500)} * 1e2, 0) / 1e2 AS predicted_aqi_eval FROM prep)"],
    CR_COLS, "c", {"raw_score", "predicted_aqi_api", "predicted_aqi_eval"}))
def q_clip_round_prediction(spark, sf_dir):
    p = prepared(spark, sf_dir)
    raw = FO.standin_score()
    return out(p.select("city", "timestamp", raw.alias("raw_score"),
                        FO.clip_round_prediction(raw, 1).alias("predicted_aqi_api"),
                        FO.clip_round_prediction(raw, 2).alias("predicted_aqi_eval")))


@register("aqi_category", sql(API, ["city", "timestamp", "predicted_aqi", "aqi_category"], "api", {"predicted_aqi"}))
def q_aqi_category(spark, sf_dir):
    return out(scored_api(spark, sf_dir).select("city", "timestamp", "predicted_aqi", "aqi_category"))


ADV_COLS = ["city", "timestamp", "aqi_category", "advice", "dashboard_advice"]


@register("aqi_advice", sql(API + [
    f"a AS (SELECT city, timestamp, aqi_category, {O.advice_sql('aqi_category')} AS advice, "
    f"{O.advice_sql('aqi_category', True)} AS dashboard_advice FROM api)"], ADV_COLS, "a", set()))
def q_aqi_advice(spark, sf_dir):
    s = scored_api(spark, sf_dir)
    return s.select("city", "timestamp", "aqi_category", aqi_advice("aqi_category").alias("advice"),
                    aqi_advice("aqi_category", dashboard=True).alias("dashboard_advice"))


LEVEL_SRC = POLL + ["temperature_2m"]
LEVEL_COLS = ["city", "timestamp"] + [f"{c}_level" for c in LEVEL_SRC]


@register("pollutant_level", sql(SC + [
    "l AS (SELECT city, timestamp, " + ", ".join(f"{O.level_sql(c, c)} AS {c}_level" for c in LEVEL_SRC)
    + " FROM prep)"], LEVEL_COLS, "l", set()))
def q_pollutant_level(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return p.select("city", "timestamp", *[pollutant_level_for(c, c).alias(f"{c}_level") for c in LEVEL_SRC])


PE_COLS = ["city", "timestamp", "predicted_aqi", REF, "absolute_error", "squared_error"]


@register("prediction_errors", sql(EV, PE_COLS, "evd", {"predicted_aqi", REF, "absolute_error", "squared_error"}))
def q_prediction_errors(spark, sf_dir):
    return out(scored_eval(spark, sf_dir).select(*PE_COLS))


@register("forecast_position", sql(EV, ["city", "timestamp", "forecast_hour", "forecast_day"], "evd", set()))
def q_forecast_position(spark, sf_dir):
    return scored_eval(spark, sf_dir).select("city", "timestamp", "forecast_hour", "forecast_day")


DAPI_COLS = ["city", "forecast_day", "predicted_aqi", "start_time", "end_time", REF] + POLL + ["aqi_category", "advice"]


def _daily_api_sql():
    avg = ", ".join(f"avg({c}) AS {c}" for c in [REF] + POLL)
    return API + [
        f"d0 AS (SELECT city, forecast_day, round_even(avg(predicted_aqi) * 1e1, 0) / 1e1 AS predicted_aqi, "
        f"min(timestamp) AS start_time, max(timestamp) AS end_time, {avg} FROM apid WHERE forecast_day <= 3 "
        "GROUP BY city, forecast_day)",
        f"d1 AS (SELECT *, {O.category_sql('predicted_aqi')} AS aqi_category FROM d0)",
        f"dapi AS (SELECT *, {O.advice_sql('aqi_category')} AS advice FROM d1)",
    ]


@register("daily_summary_api", sql(_daily_api_sql(), DAPI_COLS, "dapi", {"predicted_aqi", REF, *POLL}))
def q_daily_summary_api(spark, sf_dir):
    return out(SU.daily_summary_api(scored_api(spark, sf_dir)).select(*DAPI_COLS))


DEV_COLS = (["city", "forecast_day", "predicted_daily_avg_aqi", "start_time", "end_time", "openmeteo_daily_avg_aqi"]
            + [f"{c}_avg" for c in POLL] + ["absolute_error", "squared_error"])


def _daily_eval_sql(ctes=EV):
    avg = ", ".join(f"round_even(avg({c}) * 1e2, 0) / 1e2 AS {c}_avg" for c in POLL)
    return ctes + [
        "de0 AS (SELECT city, forecast_day, round_even(avg(predicted_aqi) * 1e2, 0) / 1e2 AS predicted_daily_avg_aqi, "
        f"min(timestamp) AS start_time, max(timestamp) AS end_time, round_even(avg({REF}) * 1e2, 0) / 1e2 AS "
        f"openmeteo_daily_avg_aqi, {avg} FROM evd GROUP BY city, forecast_day)",
        "deval AS (SELECT *, round_even(abs(openmeteo_daily_avg_aqi - predicted_daily_avg_aqi) * 1e2, 0) / 1e2 "
        "AS absolute_error, round_even((openmeteo_daily_avg_aqi - predicted_daily_avg_aqi) * "
        "(openmeteo_daily_avg_aqi - predicted_daily_avg_aqi) * 1e2, 0) / 1e2 AS squared_error FROM de0)",
    ]


@register("daily_summary_eval", sql(_daily_eval_sql(), DEV_COLS, "deval", set(DEV_COLS) - {"city", "forecast_day", "start_time", "end_time"}))
def q_daily_summary_eval(spark, sf_dir):
    return out(SU.daily_summary_eval(scored_eval(spark, sf_dir)).select(*DEV_COLS))


PS_COLS = ["city", "name", "column", "description", "value", "unit", "level"]


def _pollutant_sql():
    parts = [f"SELECT city, '{n}' AS name, '{c}' AS \"column\", '{d}' AS description, "
             f"round_even(avg({c}) * 1e3, 0) / 1e3 AS value, '{u}' AS unit, {O.level_sql(c, f'avg({c})')} AS level "
             f"FROM api GROUP BY city" for n, c, u, d in S.POLLUTANT_COLUMNS]
    return API + ["ps AS (" + " UNION ALL ".join(parts) + ")"]


@register("pollutant_summary", O.with_(_pollutant_sql(), "SELECT * FROM ps"))
def q_pollutant_summary(spark, sf_dir):
    return SU.pollutant_summary(scored_api(spark, sf_dir)).select(*PS_COLS)


HL_COLS = ["city", "current_aqi", "current_category", "current_advice", "average_aqi_72h", "average_category",
           "peak_aqi_72h", "peak_category", "forecast_hours", "start_time", "end_time"]


def _headline_sql():
    return API + [
        "h0 AS (SELECT city, min_by(predicted_aqi, timestamp) AS cur, avg(predicted_aqi) AS av, "
        "max(predicted_aqi) AS pk, count(*) AS n, min(timestamp) AS st, max(timestamp) AS en FROM api GROUP BY city)",
        "hl AS (SELECT city, round_even(cur * 1e1, 0) / 1e1 AS current_aqi, "
        f"{O.category_sql('cur')} AS current_category, {O.advice_sql(O.category_sql('cur'))} AS current_advice, "
        f"round_even(av * 1e1, 0) / 1e1 AS average_aqi_72h, {O.category_sql('av')} AS average_category, "
        f"round_even(pk * 1e1, 0) / 1e1 AS peak_aqi_72h, {O.category_sql('pk')} AS peak_category, "
        "CAST(n AS BIGINT) AS forecast_hours, strftime(st, '%Y-%m-%d %H:%M:%S') AS start_time, "
        "strftime(en, '%Y-%m-%d %H:%M:%S') AS end_time FROM h0)",
    ]


@register("headline_summary", O.with_(_headline_sql(), "SELECT * FROM hl"))
def q_headline_summary(spark, sf_dir):
    return SU.headline_summary(scored_api(spark, sf_dir)).select(*HL_COLS)


@register("alert_level", O.with_(_headline_sql(), "SELECT city, peak_aqi_72h, peak_category, CASE WHEN "
                                 "peak_aqi_72h > 150e0 THEN 'error' WHEN peak_aqi_72h > 100e0 THEN 'warning' "
                                 "ELSE 'ok' END AS alert_level FROM hl"))
def q_alert_level(spark, sf_dir):
    return SU.alert_summary(SU.headline_summary(scored_api(spark, sf_dir)))


def _chart_sql():
    pad = "greatest(8e0, (mx - mn) * 0.4e0)"
    return API + [
        f"v AS (SELECT city, predicted_aqi AS v FROM api UNION ALL SELECT city, {REF} FROM api)",
        "m AS (SELECT city, min(v) AS mn, max(v) AS mx FROM v GROUP BY city)",
        f"b AS (SELECT city, mn, greatest(0e0, mn - {pad}) AS lo, least(5e2, mx + {pad}) AS hi FROM m)",
        "cr AS (SELECT city, CASE WHEN mn IS NULL THEN 0e0 WHEN hi - lo < 3e1 THEN greatest(0e0, (lo + hi) / 2e0 - 15e0) "
        "ELSE lo END AS y_min, CASE WHEN mn IS NULL THEN 1e2 WHEN hi - lo < 3e1 THEN least(5e2, (lo + hi) / 2e0 + 15e0) "
        "ELSE hi END AS y_max FROM b)",
    ]


@register("chart_range", sql(_chart_sql(), ["city", "y_min", "y_max"], "cr", {"y_min", "y_max"}))
def q_chart_range(spark, sf_dir):
    return out(SU.chart_range(scored_api(spark, sf_dir)))


METRIC_COLS = ["city", "level", "rows", "mae", "mse", "rmse", "r2"]


def _metrics_sql(src, y, yhat, level):
    return (f"SELECT city, '{level}' AS level, CAST(count(*) AS BIGINT) AS rows, "
            f"round_even(avg(abs({y} - {yhat})) * 1e4, 0) / 1e4 AS mae, "
            f"round_even(avg(({y} - {yhat}) * ({y} - {yhat})) * 1e4, 0) / 1e4 AS mse, "
            f"round_even(sqrt(avg(({y} - {yhat}) * ({y} - {yhat}))) * 1e4, 0) / 1e4 AS rmse, "
            f"round_even((CASE WHEN count(*) < 2 THEN NULL WHEN var_pop({y}) * count(*) = 0 THEN "
            f"CASE WHEN sum(({y} - {yhat}) * ({y} - {yhat})) = 0 THEN 1e0 ELSE 0e0 END ELSE "
            f"1e0 - sum(({y} - {yhat}) * ({y} - {yhat})) / (var_pop({y}) * count(*)) END) * 1e4, 0) / 1e4 AS r2 "
            f"FROM {src} WHERE {y} IS NOT NULL AND {yhat} IS NOT NULL GROUP BY city")


@register("regression_metrics_hourly", O.with_(EV, _metrics_sql("evd", REF, "predicted_aqi", "hourly")))
def q_regression_metrics_hourly(spark, sf_dir):
    m = SU.regression_metrics(scored_eval(spark, sf_dir), REF, "predicted_aqi", group=["city"], level="hourly")
    return m.select(*METRIC_COLS)


@register("regression_metrics_daily", O.with_(_daily_eval_sql(), _metrics_sql(
    "deval", "openmeteo_daily_avg_aqi", "predicted_daily_avg_aqi", "daily")))
def q_regression_metrics_daily(spark, sf_dir):
    daily = SU.daily_summary_eval(scored_eval(spark, sf_dir))
    m = SU.regression_metrics(daily, "openmeteo_daily_avg_aqi", "predicted_daily_avg_aqi", group=["city"],
                              level="daily")
    return m.select(*METRIC_COLS)


HR_COLS = ["city", "timestamp", "predicted_aqi", "aqi_category", REF, *POLL, "temperature_2m",
           "relative_humidity_2m", "precipitation", "windspeed_10m", "surface_pressure"]


@register("hourly_records", sql(API + [
    "hr AS (SELECT * REPLACE (strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp) FROM api)"],
    HR_COLS, "hr", set(HR_COLS) - {"city", "timestamp", "aqi_category"}))
def q_hourly_records(spark, sf_dir):
    from ..sources.store import hourly_records
    return out(hourly_records(scored_api(spark, sf_dir)))


DR_COLS = DAPI_COLS


@register("daily_records", sql(_daily_api_sql() + [
    "dr AS (SELECT * REPLACE (strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, "
    "strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time) FROM dapi)"], DR_COLS, "dr", {"predicted_aqi", REF, *POLL}))
def q_daily_records(spark, sf_dir):
    from ..sources.store import daily_records
    return out(daily_records(SU.daily_summary_api(scored_api(spark, sf_dir))).select(*DR_COLS))


VIEW_SRC = ["city", "forecast_day", "start_time", "end_time", "predicted_aqi", "aqi_category", REF, *POLL]
VIEW_COLS = ["city"] + [S.DISPLAY_NAMES[c] for c in VIEW_SRC[1:]]


@register("forecast_table_view", O.with_(_daily_api_sql(), "SELECT city, forecast_day AS \"Forecast Day\", "
          "strftime(start_time, '%Y-%m-%d %H:%M') AS \"Start Time\", strftime(end_time, '%Y-%m-%d %H:%M') AS \"End Time\", "
          + O.r6("predicted_aqi") + " AS \"Predicted AQI\", aqi_category AS \"AQI Category\", "
          + ", ".join(f"{O.r6(c)} AS \"{S.DISPLAY_NAMES[c]}\"" for c in [REF, *POLL]) + " FROM dapi"))
def q_forecast_table_view(spark, sf_dir):
    from ..sources.store import display_table
    daily = SU.daily_summary_api(scored_api(spark, sf_dir))
    return round_doubles(display_table(daily.select(*VIEW_SRC)))


HOURLY_VIEW = [c for c in HR_COLS if c in ("city", *S.DISPLAY_NAMES)]


@register("forecast_table_view_hourly", O.with_(API, "SELECT city, strftime(timestamp, '%Y-%m-%d %H:%M') AS \"Time\", "
          + ", ".join(f"{c if c == 'aqi_category' else O.r6(c)} AS \"{S.DISPLAY_NAMES[c]}\"" for c in HOURLY_VIEW[2:])
          + " FROM api"))
def q_forecast_table_view_hourly(spark, sf_dir):
    from ..sources.store import display_table
    return round_doubles(display_table(scored_api(spark, sf_dir).select(*HOURLY_VIEW)))


SPLIT_COLS = ["city", "timestamp", "split"]


@register("time_split", O.with_(O.training_ctes(), "SELECT city, timestamp, CASE WHEN row_number() OVER "
                                "(ORDER BY timestamp, city) <= (SELECT CAST(floor(count(*) * 0.8e0) AS BIGINT) "
                                "FROM train) THEN 'train' ELSE 'test' END AS split FROM train"))
def q_time_split(spark, sf_dir):
    from ..operators.split import time_split
    return time_split(training_table(spark, sf_dir)).select(*SPLIT_COLS)
