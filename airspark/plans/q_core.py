"""Core feature-table queries over the events-derived observation series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..operators.clean import round_doubles
from ..sources import fixture as FX
from . import oracle as O
from .catalog import register
from .features import build_training_features, join_air_weather

VARIANT = "events"


def observations(spark: SparkSession, sf_dir: str, variant: str = VARIANT) -> DataFrame:
    """Landed observation rows: air joined with weather, two ingestion runs."""
    h = FX.hourly_seed(spark, sf_dir, variant)
    raw = join_air_weather(FX.air_rows(h), FX.weather_rows(h))
    return FX.fixture_runs(raw)


def out(df: DataFrame) -> DataFrame:
    return round_doubles(df)


def training_table(spark: SparkSession, sf_dir: str, variant: str = VARIANT) -> DataFrame:
    """The training feature table (unrounded), input of every derived query."""
    obs = observations(spark, sf_dir, variant).drop("emax", "run", "forecast_run_timestamp")
    return build_training_features(obs)


@register("build_training_features",
          O.with_(O.training_ctes(), O.round_select(S.TRAINING_OUTPUT_COLUMNS,
                                                    O.doubles_of(S.TRAINING_OUTPUT_COLUMNS), "train")))
def q_build_training_features(spark, sf_dir):
    return out(training_table(spark, sf_dir))


# ---------------------------------------------------------------------------
# Shared Spark inputs
# ---------------------------------------------------------------------------

FILL = S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN]
RAW_OUT = ["city", "timestamp", "emax"] + O.AIR + O.WEATHER
RAW_DBL = set(O.AIR + O.WEATHER)
SMALL_BUCKET = 100  # operator-level queries cross many bucket boundaries on purpose


def raw_rows(spark, sf_dir, variant=VARIANT):
    h = FX.hourly_seed(spark, sf_dir, variant)
    return join_air_weather(FX.air_rows(h), FX.weather_rows(h))


def deduped(spark, sf_dir):
    from ..operators.clean import dedupe_keep_last
    return dedupe_keep_last(observations(spark, sf_dir), order=("ingestion_timestamp",))


def forecast_context(spark, sf_dir, variant=VARIANT):
    from .features import build_forecast_features
    return build_forecast_features(observations(spark, sf_dir, variant), FX.AS_OF, context=True)


def sql(ctes, cols, src, doubles=None, extra=""):
    doubles = O.doubles_of(cols) if doubles is None else doubles
    return O.with_(ctes, O.round_select(cols, doubles, src, extra))


FX_CTES = O.fixture_ctes()
DD_CTES = FX_CTES + [O.dedupe_cte("dd", "runs")]


@register("join_air_weather", sql(FX_CTES, RAW_OUT, "raw", RAW_DBL))
def q_join_air_weather(spark, sf_dir):
    return out(raw_rows(spark, sf_dir).select(*RAW_OUT))


@register("dedupe_keep_last", sql(DD_CTES, RAW_OUT + ["ingestion_timestamp"], "dd", RAW_DBL))
def q_dedupe_keep_last(spark, sf_dir):
    return out(deduped(spark, sf_dir).select(*RAW_OUT, "ingestion_timestamp"))


@register("fill_gaps", sql(DD_CTES + [O.fill_cte("filled", "dd", FILL)], RAW_OUT, "filled", RAW_DBL))
def q_fill_gaps(spark, sf_dir):
    from ..operators.series import fill_gaps
    return out(fill_gaps(deduped(spark, sf_dir), FILL, bucket_rows=SMALL_BUCKET).select(*RAW_OUT))


@register("clip_bounds", sql(FX_CTES + [O.clip_cte("c", "raw", FILL)], RAW_OUT, "c", RAW_DBL))
def q_clip_bounds(spark, sf_dir):
    from ..operators.clean import clip_bounds
    return out(clip_bounds(raw_rows(spark, sf_dir)).select(*RAW_OUT))


def _roll_query(name, src, n):
    ctes = DD_CTES + [O.fill_cte("filled", "dd", FILL), O.clip_cte("clipped", "filled", FILL),
                      f"r AS (SELECT city, timestamp, {src}, {O.roll_expr(src, n)} AS {name} FROM clipped)"]

    @register(f"roll_{name}", sql(ctes, ["city", "timestamp", src, name], "r", {src, name}))
    def q(spark, sf_dir):
        from ..operators.series import series_features
        bounds = {c: S.CLIP_BOUNDS[c] for c in FILL}
        df = series_features(deduped(spark, sf_dir), fill_cols=FILL, clip_bounds=bounds,
                             rolls=[(name, src, n)], bucket_rows=SMALL_BUCKET)
        return out(df.select("city", "timestamp", src, name))
    return q


for _name, _src, _n in O.ROLLS:
    _roll_query(_name, _src, _n)

CONV_COLS = ["city", "timestamp", "o3_8h", "co_8h", "no2_1h", "o3_8h_ppb", "co_8h_ppm", "no2_1h_ppb"]
TRAIN_CHAIN = DD_CTES + [O.fill_cte("filled", "dd", FILL), O.clip_cte("clipped", "filled", FILL),
                         O.roll_cte("rolled", "clipped"), O.convert_cte("conv", "rolled")]


@register("convert_units", sql(TRAIN_CHAIN, CONV_COLS, "conv", set(CONV_COLS[2:])))
def q_convert_units(spark, sf_dir):
    from .features import derive_series
    return out(derive_series(deduped(spark, sf_dir), FILL).select(*CONV_COLS))


TIME_COLS = ["city", "timestamp", "hour", "day_of_week", "is_weekend"]
CYC_COLS = TIME_COLS + ["hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos"]


@register("time_parts", sql(FX_CTES + [f"t AS (SELECT city, timestamp, {O.TIME_PARTS_SELECT} FROM raw)"],
                            TIME_COLS, "t", set()))
def q_time_parts(spark, sf_dir):
    from ..functions.time import time_part_columns
    return raw_rows(spark, sf_dir).withColumns(time_part_columns()).select(*TIME_COLS)


@register("cyclic_time", sql(FX_CTES + [O.time_cte("t", "raw")], CYC_COLS, "t", set(CYC_COLS[5:])))
def q_cyclic_time(spark, sf_dir):
    from ..operators.clean import add_time_features
    return out(add_time_features(raw_rows(spark, sf_dir)).select(*CYC_COLS))


@register("median_impute", sql(FX_CTES + [O.median_cte("m", "raw", O.AIR + O.WEATHER)], RAW_OUT, "m", RAW_DBL))
def q_median_impute(spark, sf_dir):
    from ..operators.median import median_impute
    return out(median_impute(raw_rows(spark, sf_dir), O.AIR + O.WEATHER).select(*RAW_OUT))


@register("drop_incomplete", sql(FX_CTES, RAW_OUT, "raw", RAW_DBL, f"WHERE {O.not_null(O.AIR + O.WEATHER)}"))
def q_drop_incomplete(spark, sf_dir):
    from ..operators.clean import drop_incomplete
    return out(drop_incomplete(raw_rows(spark, sf_dir), O.AIR + O.WEATHER).select(*RAW_OUT))


@register("round_to_int", sql(FX_CTES + [
    "r AS (SELECT city, timestamp, CAST(round_even(temperature_2m, 0) AS BIGINT) AS temperature_int, "
    "CAST(round_even(relative_humidity_2m / 4e0, 0) AS BIGINT) AS humidity_quarter_int FROM raw)"],
    ["city", "timestamp", "temperature_int", "humidity_quarter_int"], "r", set()))
def q_round_to_int(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..operators.clean import round_to_int
    df = raw_rows(spark, sf_dir).select(
        "city", "timestamp", F.col("temperature_2m").alias("temperature_int"),
        (F.col("relative_humidity_2m") / F.lit(4.0)).alias("humidity_quarter_int"))
    return round_to_int(df, ["temperature_int", "humidity_quarter_int"])


FCTX = O.forecast_context_ctes()
FC = O.forecast_ctes()
FOUT = S.FORECAST_OUTPUT_COLUMNS


@register("select_outputs", sql(FCTX, FOUT, "fctx"))
def q_select_outputs(spark, sf_dir):
    from ..operators.clean import select_outputs
    return out(select_outputs(forecast_context(spark, sf_dir), FOUT))


@register("horizon_rows", sql(FC, FOUT, "fc"))
def q_horizon_rows(spark, sf_dir):
    from ..operators.forecast import horizon_rows
    from pyspark.sql import functions as F
    ctx = forecast_context(spark, sf_dir)
    return out(horizon_rows(ctx.filter(F.col("is_future") == 1), 72).select(*FOUT))


@register("build_forecast_features", sql(FC, FOUT, "fc"))
def q_build_forecast_features(spark, sf_dir):
    from .features import build_forecast_features
    return out(build_forecast_features(observations(spark, sf_dir), FX.AS_OF, horizon=72))


TAG_COLS = RAW_OUT + ["country", "latitude", "longitude", "ingestion_timestamp"]


@register("tag_location", sql(FX_CTES + [
    f"t AS (SELECT *, 'norland' AS country, 25.5e0 AS latitude, 68.25e0 AS longitude, "
    f"TIMESTAMP '{FX.AS_OF}' AS ingestion_timestamp FROM raw)"], TAG_COLS, "t", RAW_DBL | {"latitude", "longitude"}))
def q_tag_location(spark, sf_dir):
    from ..operators.clean import tag_location
    df = raw_rows(spark, sf_dir)
    # The operator tags one city's rows; each row's own city is put back for the comparison.
    tagged = (tag_location(df.withColumnRenamed("city", "_city"), "any", "norland", 25.5, 68.25, FX.AS_OF)
              .drop("city").withColumnRenamed("_city", "city"))
    return out(tagged.select(*TAG_COLS))


@register("flag_future", sql(FX_CTES + [
    f"t AS (SELECT *, CAST(CASE WHEN timestamp > date_trunc('hour', TIMESTAMP '{FX.AS_OF}') THEN 1 ELSE 0 END AS BIGINT) "
    f"AS is_future FROM raw)"], RAW_OUT + ["is_future"], "t", RAW_DBL))
def q_flag_future(spark, sf_dir):
    from .features import flag_future
    return out(flag_future(raw_rows(spark, sf_dir), FX.AS_OF).select(*RAW_OUT, "is_future"))


LR_COLS = RAW_OUT + ["forecast_run_timestamp"]


@register("latest_run", sql(FX_CTES + [
    "lr AS (SELECT r.* FROM runs r WHERE r.forecast_run_timestamp = "
    "(SELECT max(r2.forecast_run_timestamp) FROM runs r2 WHERE r2.city = r.city))"], LR_COLS, "lr", RAW_DBL))
def q_latest_run(spark, sf_dir):
    from ..operators.forecast import latest_run
    return out(latest_run(observations(spark, sf_dir), "forecast_run_timestamp").select(*LR_COLS))


# training_clean: the training table plus stale duplicates with noisy integer
# time features stored as doubles.
TC_COLS = ["city", "timestamp", *S.MODEL_FEATURE_COLUMNS, S.TARGET_COLUMN]


def _tc_sql():
    ctes = O.training_ctes() + [
        "tcin AS (SELECT city, CAST(timestamp AS VARCHAR) AS timestamp, ingestion_timestamp, "
        + ", ".join(f"CAST({c} AS DOUBLE) + 0.4e0 AS {c}" if c in S.INT_TIME_COLUMNS else c
                    for c in S.MODEL_FEATURE_COLUMNS) + f", {S.TARGET_COLUMN} FROM train "
        "UNION ALL SELECT city, CAST(timestamp AS VARCHAR), ingestion_timestamp - INTERVAL 1 DAY, "
        + ", ".join(f"CAST({c} AS DOUBLE)" if c in S.INT_TIME_COLUMNS else c for c in S.MODEL_FEATURE_COLUMNS)
        + f", {S.TARGET_COLUMN} + 1e0 FROM train WHERE hour = 0)",
        "tc1 AS (SELECT city, TRY_CAST(timestamp AS TIMESTAMP) AS timestamp, ingestion_timestamp, "
        + ", ".join(f"CAST(round_even({c}, 0) AS BIGINT) AS {c}" if c in S.INT_TIME_COLUMNS else c
                    for c in S.MODEL_FEATURE_COLUMNS) + f", {S.TARGET_COLUMN} FROM tcin)",
        O.dedupe_cte("tc2", "tc1"),
        f"tc AS (SELECT * FROM tc2 WHERE timestamp IS NOT NULL AND {O.not_null(TC_COLS[2:])})",
    ]
    return sql(ctes, TC_COLS, "tc")


@register("training_clean", _tc_sql())
def q_training_clean(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..operators.clean import training_clean
    train = training_table(spark, sf_dir)
    cols = ["city", F.col("timestamp").cast("string").alias("timestamp"), "ingestion_timestamp"]
    a = train.select(*cols, *[(F.col(c).cast("double") + F.lit(0.4)).alias(c) if c in S.INT_TIME_COLUMNS
                              else F.col(c) for c in S.MODEL_FEATURE_COLUMNS], S.TARGET_COLUMN)
    b = train.filter(F.col("hour") == 0).select(
        "city", F.col("timestamp").cast("string").alias("timestamp"),
        (F.col("ingestion_timestamp") - F.expr("INTERVAL 1 DAY")).alias("ingestion_timestamp"),
        *[F.col(c).cast("double").alias(c) if c in S.INT_TIME_COLUMNS else F.col(c)
          for c in S.MODEL_FEATURE_COLUMNS], (F.col(S.TARGET_COLUMN) + F.lit(1.0)).alias(S.TARGET_COLUMN))
    return out(training_clean(a.unionByName(b)).select(*TC_COLS))


MESSY = {"city": " City ", "timestamp": "TimeStamp", "pm25": "PM25", "pm10": "pm10 ",
         "carbon_monoxide": "Carbon Monoxide", "nitrogen_dioxide": "nitrogen-dioxide",
         "relative_humidity_2m": "Relative-Humidity 2m", "et0_fao_evapotranspiration": "ET0 FAO-Evapotranspiration"}


@register("normalize_columns", sql(FX_CTES, RAW_OUT, "raw", RAW_DBL))
def q_normalize_columns(spark, sf_dir):
    from ..operators.clean import normalize_columns
    df = raw_rows(spark, sf_dir).select(*RAW_OUT)
    messy = df.toDF(*[MESSY.get(c, c) for c in df.columns])
    return out(normalize_columns(messy))


_NUM_TEXT_SQL = ("CASE WHEN event_id % 7 = 0 THEN 'abc' WHEN event_id % 11 = 0 THEN 'nan' "
                 "WHEN event_id % 13 = 0 THEN concat(' ', CAST(value AS VARCHAR), ' ') "
                 "WHEN event_id % 17 = 0 THEN '' ELSE CAST(value AS VARCHAR) END")


@register("coerce_numeric", O.with_([
    f"t AS (SELECT event_id, TRY_CAST({_NUM_TEXT_SQL} AS DOUBLE) AS v FROM events)"],
    "SELECT event_id, CASE WHEN isnan(v) THEN NULL ELSE v END AS value FROM t"))
def q_coerce_numeric(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..operators.clean import coerce_numeric
    from ..session import read_table
    ev = read_table(spark, sf_dir, "events")
    text = F.expr(_NUM_TEXT_SQL.replace("VARCHAR", "STRING"))
    return coerce_numeric(ev.select("event_id", text.alias("value")), ["value"])


_TS_TEXT_SPARK = ("CASE WHEN event_id % 9 = 0 THEN 'bad' WHEN event_id % 4 = 0 THEN "
                  "date_format(ts, \"yyyy-MM-dd'T'HH:mm\") ELSE CAST(ts AS STRING) END")
_TS_TEXT_SQL = ("CASE WHEN event_id % 9 = 0 THEN 'bad' WHEN event_id % 4 = 0 THEN "
                "strftime(ts, '%Y-%m-%dT%H:%M') ELSE CAST(ts AS VARCHAR) END")


@register("coerce_timestamp", O.with_([f"t AS (SELECT event_id, TRY_CAST({_TS_TEXT_SQL} AS TIMESTAMP) AS ts FROM events)"],
                                      "SELECT event_id, ts FROM t WHERE ts IS NOT NULL"))
def q_coerce_timestamp(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..operators.clean import coerce_timestamp
    from ..session import read_table
    ev = read_table(spark, sf_dir, "events")
    return coerce_timestamp(ev.select("event_id", F.expr(_TS_TEXT_SPARK).alias("ts")), ["ts"])


_TZ_TEXT_SPARK = ("CASE WHEN event_id % 3 = 0 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+05:00') "
                  "WHEN event_id % 3 = 1 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z') "
                  "ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END")
_TZ_TEXT_SQL = ("CASE WHEN event_id % 3 = 0 THEN concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '+05:00') "
                "WHEN event_id % 3 = 1 THEN concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'Z') "
                "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END")


@register("to_local_time", O.with_([f"t AS (SELECT event_id, {_TZ_TEXT_SQL} AS s FROM events)"],
                                   "SELECT event_id, CASE WHEN regexp_matches(s, '([+-][0-9]{2}:?[0-9]{2}|Z)$') "
                                   f"THEN CAST(timezone('{FX.CITY_TIMEZONE}', TRY_CAST(s AS TIMESTAMPTZ)) AS TIMESTAMP) "
                                   "ELSE TRY_CAST(s AS TIMESTAMP) END AS local_time FROM t"))
def q_to_local_time(spark, sf_dir):
    from pyspark.sql import functions as F

    from ..functions.time import to_local_time
    from ..session import read_table
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", to_local_time(F.expr(_TZ_TEXT_SPARK), FX.CITY_TIMEZONE).alias("local_time"))


@register("sort_city_time", sql(FX_CTES, RAW_OUT, "raw", RAW_DBL, "ORDER BY city, timestamp"))
def q_sort_city_time(spark, sf_dir):
    """Order by (city, timestamp): a range-partitioned distributed sort."""
    return out(raw_rows(spark, sf_dir).select(*RAW_OUT).orderBy("city", "timestamp"))


UNION_COLS = ["city", "timestamp", "series", "value"]


@register("union_all", sql(FC + [
    "u AS (SELECT city, timestamp, 'pm25_24h' AS series, pm25_24h AS value FROM fc UNION ALL "
    f"SELECT city, timestamp, 'reference', {S.REFERENCE_COLUMN} FROM fc)"], UNION_COLS, "u", {"value"}))
def q_union_all(spark, sf_dir):
    """Stack two value series (the dashboard appends reference values to predictions)."""
    from pyspark.sql import functions as F

    from .features import build_forecast_features
    fc = build_forecast_features(observations(spark, sf_dir), FX.AS_OF, horizon=72)
    a = fc.select("city", "timestamp", F.lit("pm25_24h").alias("series"), F.col("pm25_24h").alias("value"))
    b = fc.select("city", "timestamp", F.lit("reference").alias("series"), F.col(S.REFERENCE_COLUMN).alias("value"))
    return out(a.unionByName(b))


@register("build_training_features_incremental", O.with_(O.training_ctes(), O.round_select(
    S.TRAINING_OUTPUT_COLUMNS, O.doubles_of(S.TRAINING_OUTPUT_COLUMNS), "train")))
def q_build_training_features_incremental(spark, sf_dir):
    """The same table from three runs: first landing, late hours, corrections; each recomputes only what it changes."""
    from ..session import scratch_path
    from .incremental import FeatureStore
    store = FeatureStore(spark, scratch_path(spark, "feature-store"), grain="week")
    obs = observations(spark, sf_dir)
    late = F.col("emax") % 5 == 0
    for part in ((F.col("run") == 1) & ~late, (F.col("run") == 1) & late, F.col("run") == 2):
        store.update(obs.where(part).drop("emax", "run", "forecast_run_timestamp"))
    return out(store.training_features())


@register("join_air_weather_bucketed", sql(FX_CTES, RAW_OUT, "raw", RAW_DBL))
def q_join_air_weather_bucketed(spark, sf_dir):
    """Both sides as bucketed tables of the catalog, joined bucket by bucket."""
    import uuid
    from ..sources.bucketed import join_bucketed, write_bucketed
    run = uuid.uuid4().hex[:8]
    h = FX.hourly_seed(spark, sf_dir)
    sides = [write_bucketed(df, f"airspark_{name}_{run}", 8) for name, df in (("air", FX.air_rows(h)), ("weather", FX.weather_rows(h)))]
    return out(join_bucketed(spark, *sides).select(*RAW_OUT))
