"""Aggregations: daily, pollutant, headline, metrics, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.classify import aqi_advice, aqi_category, alert_level, pollutant_level
from ..functions.numeric import np_round
from .forecast import forecast_position

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def daily_summary_api(hourly: DataFrame, max_days: int = S.API_DAILY_MAX_DAYS,
                      key: str = "city") -> DataFrame:
    """Per 24-hour block: mean prediction (round 1) with category/advice, min/max
    time, mean reference and pollutant means; first ``max_days`` blocks."""
    df = hourly if "forecast_day" in hourly.columns else forecast_position(hourly, key)
    aggs = [F.avg("predicted_aqi").alias("predicted_aqi"),
            F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time")]
    if S.REFERENCE_COLUMN in df.columns:
        aggs.append(F.avg(F.col(S.REFERENCE_COLUMN).try_cast("double")).alias(S.REFERENCE_COLUMN))
    aggs += [F.avg(c).alias(c) for c in S.POLLUTANT_FEATURE_COLUMNS if c in df.columns]
    daily = df.filter(F.col("forecast_day") <= max_days).groupBy(key, "forecast_day").agg(*aggs)
    daily = daily.withColumn("predicted_aqi", np_round("predicted_aqi", 1))
    daily = daily.withColumn("aqi_category", aqi_category("predicted_aqi"))
    return daily.withColumn("advice", aqi_advice("aqi_category"))


def daily_summary_eval(hourly: DataFrame, key: str = "city",
                       reference: str = S.REFERENCE_COLUMN) -> DataFrame:
    """Per forecast day: means to 2 digits and daily absolute/squared error."""
    aggs = [F.avg("predicted_aqi").alias("predicted_daily_avg_aqi"),
            F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time")]
    if reference in hourly.columns:
        aggs.append(F.avg(reference).alias("openmeteo_daily_avg_aqi"))
    aggs += [F.avg(c).alias(f"{c}_avg") for c in S.POLLUTANT_FEATURE_COLUMNS if c in hourly.columns]
    daily = hourly.groupBy(key, "forecast_day").agg(*aggs)
    rounded = {c: np_round(c, 2) for c in daily.columns
               if c in ("predicted_daily_avg_aqi", "openmeteo_daily_avg_aqi") or c.endswith("_avg")}
    daily = daily.withColumns(rounded)
    if reference in hourly.columns:
        diff = F.col("openmeteo_daily_avg_aqi") - F.col("predicted_daily_avg_aqi")
        daily = daily.withColumns({"absolute_error": np_round(F.abs(diff), 2),
                                   "squared_error": np_round(diff * diff, 2)})
    return daily


def pollutant_summary(hourly: DataFrame, key: str = "city") -> DataFrame:
    """Per city and pollutant: horizon mean (round 3), level from the unrounded mean."""
    present = [(n, c, u, d) for n, c, u, d in S.POLLUTANT_COLUMNS if c in hourly.columns]
    means = hourly.groupBy(key).agg(*[F.avg(F.col(c).try_cast("double")).alias(c) for _, c, _, _ in present])
    long = means.unpivot([key], [c for _, c, _, _ in present], "column", "mean")
    meta = F.create_map(*[x for n, c, u, d in present for x in (F.lit(c), F.struct(
        F.lit(n).alias("name"), F.lit(u).alias("unit"), F.lit(d).alias("description")))])
    return long.select(
        key, meta[F.col("column")]["name"].alias("name"), "column",
        meta[F.col("column")]["description"].alias("description"),
        np_round("mean", 3).alias("value"), meta[F.col("column")]["unit"].alias("unit"),
        pollutant_level("column", "mean").alias("level"))


def headline_summary(hourly: DataFrame, key: str = "city") -> DataFrame:
    """Current (earliest hour), average, peak, count and time range per city."""
    s = hourly.groupBy(key).agg(
        F.min_by("predicted_aqi", "timestamp").alias("_current"),
        F.avg("predicted_aqi").alias("_avg"), F.max("predicted_aqi").alias("_peak"),
        F.count(F.lit(1)).alias("forecast_hours"),
        F.min("timestamp").alias("_start"), F.max("timestamp").alias("_end"))
    return s.select(
        key,
        np_round("_current", 1).alias("current_aqi"),
        aqi_category("_current").alias("current_category"),
        aqi_advice(aqi_category("_current")).alias("current_advice"),
        np_round("_avg", 1).alias("average_aqi_72h"),
        aqi_category("_avg").alias("average_category"),
        np_round("_peak", 1).alias("peak_aqi_72h"),
        aqi_category("_peak").alias("peak_category"),
        F.col("forecast_hours").cast("bigint").alias("forecast_hours"),
        F.date_format("_start", TS_FORMAT).alias("start_time"),
        F.date_format("_end", TS_FORMAT).alias("end_time"))


def alert_summary(headline: DataFrame, key: str = "city") -> DataFrame:
    return headline.select(key, "peak_aqi_72h", "peak_category",
                           alert_level("peak_aqi_72h").alias("alert_level"))


def regression_metrics(df: DataFrame, y: str, yhat: str, group=(), digits: int | None = 4,
                       level: str | None = None) -> DataFrame:
    """rows, MAE, MSE, RMSE, R² over rows with both values.

    R² = 1 - SSE/SST with SST = n·var_pop(y); constant truth gives 1.0 for a
    perfect fit and 0.0 otherwise; NULL below 2 rows.  One grouped
    aggregate (partial aggregation), no per-row collection.
    """
    group = list(group)
    both = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull() & ~F.isnan(F.col(y))
                     & ~F.isnan(F.col(yhat)))
    e = F.col(y) - F.col(yhat)
    agg = both.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_var"))
    sst = F.col("_var") * F.col("rows")
    r2 = (F.when(F.col("rows") < 2, F.lit(None).cast("double"))
          .when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / sst))
    out = agg.select(*group, F.col("rows").cast("bigint").alias("rows"), "mae", "mse",
                     F.sqrt("mse").alias("rmse"), r2.alias("r2"))
    if digits is not None:
        out = out.withColumns({c: np_round(c, digits) for c in ("mae", "mse", "rmse", "r2")})
    if level:
        out = out.withColumn("level", F.lit(level))
    return out.filter(F.col("rows") > 0)


def table_profile(df: DataFrame, ts: str = "timestamp", name: str | None = None) -> DataFrame:
    """Row count, time range, column count and per-column NULL count (one pass)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    if ts in cols:
        aggs += [F.min(ts).alias("_min_ts"), F.max(ts).alias("_max_ts")]
    aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"_null_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    nulls = one.select(
        "_rows", *(["_min_ts", "_max_ts"] if ts in cols else []),
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("null_count"))
                            for i, c in enumerate(cols)])).alias("s"))
    out = nulls.select(
        *( [F.lit(name).alias("table_name")] if name else []),
        F.col("s.column_name").alias("column_name"), F.col("s.null_count").cast("bigint").alias("null_count"),
        F.col("_rows").cast("bigint").alias("row_count"),
        *([F.col("_min_ts").alias("min_timestamp"), F.col("_max_ts").alias("max_timestamp")] if ts in cols else []),
        F.lit(len(cols)).cast("bigint").alias("column_count"))
    return out


def chart_range(hourly: DataFrame, key: str = "city") -> DataFrame:
    """Y range over predictions and reference: pad max(8, 0.4·range), bound
    0..500, widen to at least 30 around the centre; (0, 100) when empty."""
    vals = hourly.select(key, F.col("predicted_aqi").try_cast("double").alias("v"))
    if S.REFERENCE_COLUMN in hourly.columns:
        vals = vals.unionByName(hourly.select(key, F.col(S.REFERENCE_COLUMN).try_cast("double").alias("v")))
    r = vals.groupBy(key).agg(F.min("v").alias("_mn"), F.max("v").alias("_mx"))
    pad = F.greatest(F.lit(8.0), (F.col("_mx") - F.col("_mn")) * F.lit(0.40))
    r = r.withColumns({"_lo": F.greatest(F.lit(0.0), F.col("_mn") - pad),
                       "_hi": F.least(F.lit(500.0), F.col("_mx") + pad)})
    centre = (F.col("_lo") + F.col("_hi")) / F.lit(2.0)
    narrow = (F.col("_hi") - F.col("_lo")) < F.lit(30.0)
    return r.select(
        key,
        F.when(F.col("_mn").isNull(), F.lit(0.0)).when(narrow, F.greatest(F.lit(0.0), centre - F.lit(15.0)))
        .otherwise(F.col("_lo")).alias("y_min"),
        F.when(F.col("_mn").isNull(), F.lit(100.0)).when(narrow, F.least(F.lit(500.0), centre + F.lit(15.0)))
        .otherwise(F.col("_hi")).alias("y_max"))


def best_model(metrics: DataFrame) -> DataFrame:
    """Lowest test RMSE, then lowest test MAE."""
    return metrics.orderBy(F.col("test_RMSE").asc(), F.col("test_MAE").asc(), F.col("model_name")).limit(1)


def importance_rank(importance: DataFrame) -> DataFrame:
    """Features by importance, descending, with a 1-based rank (19 rows)."""
    from pyspark.sql import Window as W
    w = W.orderBy(F.col("importance").desc(), F.col("feature"))
    return importance.withColumn("rank", F.row_number().over(w).cast("bigint"))
