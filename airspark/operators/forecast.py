"""Forecast-path operators: latest run, horizon, positions, scoring prep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .. import schemas as S
from ..functions.classify import aqi_category
from ..functions.numeric import clip, np_round, try_double
from .clean import (add_time_features, coerce_timestamp, dedupe_keep_last, localize_timestamps,
                    normalize_columns)
from .median import median_impute
from .quality import written_rows


RUN_COLUMNS = ("forecast_run_timestamp", "ingestion_timestamp")


def latest_run(df: DataFrame, run_col: str | None = None, key: str = "city") -> DataFrame:
    """Keep each city's rows of its newest run.

    The run column is ``forecast_run_timestamp`` when the city has any value
    in it, else ``ingestion_timestamp``; with neither, rows are kept.  Both
    maxima come from one grouped aggregate (partial aggregation); the join
    back is left to AQE, which broadcasts the per-city table once its
    measured size is small and otherwise splits skewed partitions.
    """
    cols = [run_col] if run_col else [c for c in RUN_COLUMNS if c in df.columns]
    if not cols:
        return df
    newest = df.groupBy(key).agg(*[F.max(c).alias(f"_newest_{i}") for i, c in enumerate(cols)])
    keep = None
    for i, c in enumerate(cols):
        cond = F.col(c) == F.col(f"_newest_{i}")
        keep = (F.when(F.col(f"_newest_{i}").isNotNull(), cond) if keep is None
                else keep.when(F.col(f"_newest_{i}").isNotNull(), cond))
    keep = keep.otherwise(F.lit(True))
    return df.join(newest, key).filter(keep).drop(*[f"_newest_{i}" for i in range(len(cols))])


def future_rows(df: DataFrame, as_of=None, ts: str = "timestamp") -> DataFrame:
    if "is_future" in df.columns:
        flag = F.coalesce(F.col("is_future").try_cast("double"), F.lit(0.0)).cast("int")
        return df.filter(flag == 1)
    from ..functions.time import floor_hour
    return df.filter(F.col(ts) > floor_hour(F.lit(as_of).cast("timestamp_ntz")))


def horizon_rows(df: DataFrame, n: int = S.DEFAULT_HORIZON_HOURS, key: str = "city",
                 ts: str = "timestamp") -> DataFrame:
    """First ``n`` rows per city in time order.

    ``row_number() <= n`` plans as WindowGroupLimit: each map task keeps at
    most n rows per city before the shuffle, so a hot city never ships more
    than n rows per task.
    """
    if not 1 <= n <= S.MAX_HORIZON_HOURS:
        raise ValueError(f"horizon must be within 1..{S.MAX_HORIZON_HOURS}")
    w = W.partitionBy(key).orderBy(ts)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def forecast_position(df: DataFrame, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """forecast_hour = 1..n in time order, forecast_day = (hour-1) div 24 + 1.

    Applied to horizon rows (at most 168 per city), so the window is bounded.
    """
    w = W.partitionBy(key).orderBy(ts)
    hour = F.row_number().over(w).cast("bigint")
    return df.withColumn("forecast_hour", hour).withColumn(
        "forecast_day", (F.floor((F.col("forecast_hour") - 1) / 24) + 1).cast("bigint"))


def prepare_scoring(store: DataFrame, feature_columns=None, horizon: int = S.DEFAULT_HORIZON_HOURS,
                    timezone: str = "Asia/Karachi", as_of=None, recompute_time: bool = True) -> DataFrame:
    """Forecast store rows -> the horizon rows a model scores.

    normalise names -> local time -> newest run per city -> future rows ->
    one row per (city, timestamp) -> first ``horizon`` per city -> per-city
    median fill of the features (groups of at most ``horizon`` rows).  The
    result is written once; without a future row it raises.
    """
    feature_columns = [str(c).strip().lower() for c in (feature_columns or S.MODEL_FEATURE_COLUMNS)]
    df = normalize_columns(store)
    if "timestamp" not in df.columns:
        raise ValueError("Forecast table must contain a timestamp column.")
    df = localize_timestamps(df, ["timestamp", "forecast_run_timestamp", "ingestion_timestamp"], timezone)
    df = coerce_timestamp(df, ["timestamp"])
    df = latest_run(df)
    df = future_rows(df, as_of)
    order = [c for c in (*RUN_COLUMNS, "timestamp") if c in df.columns]
    df = dedupe_keep_last(df, key=("city", "timestamp"), order=order)
    df = horizon_rows(df, horizon)
    missing = [c for c in feature_columns if c not in df.columns]
    if missing:
        raise ValueError(f"Forecast table is missing model features: {missing}")
    if recompute_time:
        df = add_time_features(df)
    df = df.withColumns({c: try_double(c) if c not in S.INT_TIME_COLUMNS else F.col(c)
                         for c in feature_columns})
    return written_rows(median_impute(df, feature_columns, by=["city"]), "scoring-rows", "No future forecast rows available.")


def clip_round_prediction(raw_prediction, digits: int):
    return np_round(clip(raw_prediction, *S.PREDICTION_BOUNDS), digits)


def standin_score(pm25_24h_col: str = "pm25_24h"):
    """Model stand-in for oracle checks: pm25_24h^2/20 on the 1e-6-rounded mean."""
    p = np_round(pm25_24h_col, 6)
    return p * p / F.lit(20.0)


def predict_api(df: DataFrame, raw_prediction) -> DataFrame:
    """Payload flavour: clip 0..500, round 1 digit, category."""
    out = df.withColumn("predicted_aqi", clip_round_prediction(raw_prediction, 1))
    return out.withColumn("aqi_category", aqi_category("predicted_aqi"))


def predict_eval(df: DataFrame, raw_prediction, reference: str = S.REFERENCE_COLUMN) -> DataFrame:
    """Evaluation flavour: round 2 digits, errors vs reference, positions."""
    out = df.withColumn("predicted_aqi", clip_round_prediction(raw_prediction, 2))
    if reference in out.columns:
        ref = F.col(reference).try_cast("double")
        out = out.withColumns({
            reference: ref,
            "absolute_error": np_round(F.abs(ref - F.col("predicted_aqi")), 2),
            "squared_error": np_round((ref - F.col("predicted_aqi")) * (ref - F.col("predicted_aqi")), 2),
        })
    else:
        out = out.withColumns({"absolute_error": F.lit(None).cast("double"),
                               "squared_error": F.lit(None).cast("double")})
    return forecast_position(out)
