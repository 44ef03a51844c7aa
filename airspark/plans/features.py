"""End-to-end feature tables: training and forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .. import schemas as S
from ..functions.time import floor_hour
from ..operators.clean import (add_time_features, clip_bounds, coerce_numeric, convert_units, dedupe_keep_last,
                               drop_incomplete, select_outputs)
from ..operators.forecast import horizon_rows
from ..operators.median import median_impute
from ..operators.quality import quality_report, written_rows
from ..operators.series import DEFAULT_BUCKET_ROWS, series_features
from ..session import checkpoint

ROLLS = [
    ("pm25_24h", "pm25", 24),
    ("pm10_24h", "pm10", 24),
    ("o3_8h", "ozone", 8),
    ("co_8h", "carbon_monoxide", 8),
]


def join_air_weather(air: DataFrame, weather: DataFrame, key=("city", "timestamp"),
                     require_rows: bool = False) -> DataFrame:
    """Inner equi-join of the two hourly sources on (city, timestamp)."""
    w = weather.drop(*[c for c in weather.columns if c in air.columns and c not in key])
    out = air.join(w, list(key), "inner")
    if require_rows and out.isEmpty():
        raise ValueError("Merged air/weather frame is empty.")
    return out


def derive_series(df: DataFrame, value_cols, bucket_rows: int = DEFAULT_BUCKET_ROWS,
                  prior: DataFrame | None = None) -> DataFrame:
    """Fill (per city) -> clip -> rolling means -> unit conversion -> time parts.

    ``prior``: last values before ``df`` starts, if it is the later part of a longer series.
    """
    bounds = {c: S.CLIP_BOUNDS[c] for c in value_cols if c in S.CLIP_BOUNDS}
    out = series_features(df, fill_cols=value_cols, clip_bounds=bounds, rolls=ROLLS,
                          bucket_rows=bucket_rows, prior=prior)
    out = convert_units(out)
    return add_time_features(out)


def build_training_features(observations: DataFrame, bucket_rows: int = DEFAULT_BUCKET_ROWS,
                            materialize: bool = True, median_by=None) -> DataFrame:
    """Keyed observation rows (possibly several runs) -> 31-column training table.

    dedupe (newest run per key) -> fill -> clip -> roll -> convert -> time
    parts -> median impute -> clip -> drop incomplete -> project.  Without a
    row to train on it raises (seen on the write, so not with
    ``materialize=False``).
    """
    df = coerce_numeric(observations, S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN])
    df = dedupe_keep_last(df, order=("ingestion_timestamp",))
    df = derive_series(df, S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN], bucket_rows)
    return finish_training(df.select(*S.TRAINING_OUTPUT_COLUMNS), materialize, median_by)


def finish_training(df: DataFrame, materialize: bool = True, median_by=None) -> DataFrame:
    """Whole-frame median imputation, clip and the last clean-up of rows with their windows."""
    required = S.RAW_FEATURE_COLUMNS + S.DERIVED_DIAGNOSTIC_COLUMNS + S.MODEL_FEATURE_COLUMNS + [S.TARGET_COLUMN]
    null_counts = None
    if materialize:
        # The whole-frame median needs more than one pass: cut the lineage
        # into the shared checkpoint folder instead of recomputing the windows.
        # NULL counts are observed during that write (no extra pass).
        seen = Observation("nulls")
        df = checkpoint(df.observe(seen, *[
            F.count(F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), 1)).alias(c) for c in required],
            F.count(F.lit(1)).alias("_rows")))
        null_counts = seen.get
        if not null_counts["_rows"]:
            raise ValueError("No rows left for the training table.")
    df = median_impute(df, required, by=median_by, null_counts=null_counts)
    df = clip_bounds(df)
    df = drop_incomplete(df, required)
    return select_outputs(df, S.TRAINING_OUTPUT_COLUMNS)


def flag_future(df: DataFrame, as_of, ts: str = "timestamp") -> DataFrame:
    """is_future = timestamp > floor_hour(as_of) (strict)."""
    cutoff = floor_hour(F.lit(as_of).cast("timestamp_ntz"))
    return df.withColumn("is_future", (F.col(ts) > cutoff).cast("bigint"))


def build_forecast_features(observations: DataFrame, as_of, horizon: int = S.DEFAULT_HORIZON_HOURS,
                            bucket_rows: int = DEFAULT_BUCKET_ROWS, context: bool = False,
                            prior: DataFrame | None = None, bounded: bool = True, validate: bool = True) -> DataFrame:
    """Past+future rows -> 33-column forecast table: first ``horizon`` future rows per city.

    Windows run over past and future together; only then the future rows
    are kept.
    ``bounded`` (default) windows only the future rows and the 23 past rows
    they read, with fill carried from the older rows, instead of the whole
    history; ``context=True`` returns every row with its features.
    ``validate`` (default) writes the result, at most ``horizon`` rows a city,
    and raises if it has no rows, NULL features or repeated keys.
    """
    df = observations
    if S.REFERENCE_COLUMN not in df.columns and S.TARGET_COLUMN in df.columns:
        df = df.withColumnRenamed(S.TARGET_COLUMN, S.REFERENCE_COLUMN)
    if prior is not None and S.REFERENCE_COLUMN not in prior.columns and S.TARGET_COLUMN in prior.columns:
        prior = prior.withColumnRenamed(S.TARGET_COLUMN, S.REFERENCE_COLUMN)
    if "forecast_run_timestamp" not in df.columns:
        df = df.withColumn("forecast_run_timestamp", F.col("ingestion_timestamp"))
    value_cols = S.RAW_FEATURE_COLUMNS + [S.REFERENCE_COLUMN]
    bounds = {c: S.CLIP_BOUNDS[c] for c in value_cols}
    df = flag_future(coerce_numeric(df, value_cols), as_of)
    order = ("forecast_run_timestamp", "ingestion_timestamp")
    if bounded and not context and prior is None:
        # Only the future rows are output: window future rows + the 23 hours
        # before them, with fill carried from the older rows (exact; see
        # forecast_context_rows).  The cut is on key columns, so it is made
        # before the dedupe and only its few rows are written.
        df, prior = forecast_context_rows(df, as_of, value_cols=value_cols, order=order)
        df = checkpoint(dedupe_keep_last(df, order=order), "forecast-rows")
    else:
        df = dedupe_keep_last(df, order=order)
    out = series_features(df, fill_cols=value_cols, clip_bounds=bounds, rolls=ROLLS,
                          bucket_rows=bucket_rows, keep_pos=True, prior=prior)
    out = add_time_features(convert_units(out))
    out = clip_bounds(out)
    if context:
        return out.drop("_pos")
    # A top-``horizon`` per city: map tasks send no more rows than that on.
    out = horizon_rows(out.filter(F.col("is_future") == 1), horizon).drop("_pos")
    out = select_outputs(out, S.FORECAST_OUTPUT_COLUMNS)
    if validate:
        out = written_rows(out, "forecast-features", "No future rows available for the forecast table.")
        quality_report(out, horizon=horizon, strict=True)
    return out


def forecast_context_rows(observations: DataFrame, as_of, value_cols=None, key: str = "city",
                          ts: str = "timestamp", order=()):
    """Bounded input for rescoring: future rows + the last 23 past hours per city,
    and the last non-NULL value of each column among the older past rows.

    ``build_forecast_features(rows, as_of, prior=prior)`` then equals the
    result over the whole series: the 24-row windows of every future row see
    the same rows, and forward fill continues from ``prior``.  The tail is a
    per-city top-23 of hours (WindowGroupLimit).  ``order`` names the run
    columns when rows may repeat a key: older rows are then deduped on their
    way into ``prior``, which is taken per (city, month) first, so a large
    city is combined before it meets in one place.
    """
    from pyspark.sql import Window as W
    value_cols = list(value_cols or S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN])
    cutoff = floor_hour(F.lit(as_of).cast("timestamp_ntz"))
    future = observations.filter(F.col(ts) > cutoff)
    past = observations.filter(F.col(ts) <= cutoff)
    halo = max(n for _, _, n in ROLLS) - 1
    ranked = past.withColumn("_r", F.dense_rank().over(W.partitionBy(key).orderBy(F.col(ts).desc())))
    tail = ranked.filter(F.col("_r") <= halo).drop("_r")
    start = tail.groupBy(key).agg(F.min(ts).alias("_start"))
    older = past.join(start, key).filter(F.col(ts) < F.col("_start"))
    if order:
        order = [c for c in order if c in older.columns]
        older = dedupe_keep_last(older.select(key, ts, *order, *value_cols), key=(key, ts), order=order)
    month = F.trunc(F.to_date(ts), "month").alias("_m")
    monthly = older.groupBy(key, month).agg(
        *[F.max_by(F.struct(F.col(ts).alias("t"), F.col(c).alias("v")), F.when(F.col(c).isNotNull(), F.col(ts)))
          .alias(c) for c in value_cols])
    prior = monthly.groupBy(key).agg(*[F.max_by(F.col(c)["v"], F.col(c)["t"]).alias(c) for c in value_cols])
    return future.unionByName(tail), prior
