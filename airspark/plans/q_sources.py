"""Sources, sinks, registry and payload queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.clean import dedupe_keep_last
from ..sources import fixture as FX
from ..sources import landing as L
from ..sources import store as ST
from ..sources.geo import city_slug, geo_resolve
from ..session import checkpoint, read_table, scratch_path
from . import oracle as O
from .catalog import ORACLE, register
from .q_core import (DD_CTES, FX_CTES, RAW_DBL, RAW_OUT, TC_COLS, observations, out, training_table,
                     raw_rows, sql)
from .q_scoring import API, DAPI_COLS, HR_COLS, PS_COLS, scored_api

AIR_OUT = ["city", "timestamp"] + O.AIR
WEATHER_OUT = ["city", "timestamp"] + O.WEATHER
FORECAST_OUT = ["city", "timestamp"] + O.AIR[:-1] + [S.REFERENCE_COLUMN]


def air_responses(spark, sf_dir, chunk_days=30):
    h = FX.hourly_seed(spark, sf_dir)
    return L.responses_from_rows(FX.air_rows(h), L.AIR_RENAME, chunk_days)


def weather_responses(spark, sf_dir, chunk_days=30):
    h = FX.hourly_seed(spark, sf_dir)
    return L.responses_from_rows(FX.weather_rows(h), L.WEATHER_RENAME, chunk_days)


@register("src_air_hourly", sql(FX_CTES, AIR_OUT, "air", set(O.AIR)))
def q_src_air_hourly(spark, sf_dir):
    return out(L.rows_from_responses(air_responses(spark, sf_dir), L.AIR_RENAME).select(*AIR_OUT))


@register("src_weather_hourly", sql(FX_CTES, WEATHER_OUT, "weather", set(O.WEATHER)))
def q_src_weather_hourly(spark, sf_dir):
    return out(L.rows_from_responses(weather_responses(spark, sf_dir), L.WEATHER_RENAME).select(*WEATHER_OUT))


@register("src_landing_files", sql(FX_CTES, AIR_OUT, "air", set(O.AIR)))
def q_src_landing_files(spark, sf_dir):
    """Landed files, with a cut-off copy of every response beside it: those are set apart."""
    responses = checkpoint(air_responses(spark, sf_dir), "responses")
    path = L.land_responses(responses, name="landing-air")
    cut = responses.select("city", "chunk_start", F.substring(F.to_json(F.struct("hourly")), 1, 200).alias("value"))
    cut.write.mode("append").partitionBy("city", "chunk_start").text(path)
    landed = L.read_landed(spark, path, S.AIR_RESPONSE_SCHEMA, bad_path=scratch_path(spark, "landing-bad"))
    return out(L.rows_from_responses(landed, L.AIR_RENAME).select(*AIR_OUT))


@register("src_landing_range", sql(FX_CTES + ["ar AS (SELECT * FROM air WHERE timestamp >= TIMESTAMP '2024-01-10' AND timestamp < TIMESTAMP '2024-01-20')"],
                                   AIR_OUT, "ar", set(O.AIR)))
def q_src_landing_range(spark, sf_dir):
    """A date range: folders of other weeks are not read."""
    path = L.land_responses(air_responses(spark, sf_dir, 7), name="landing-air")
    landed = L.read_landed(spark, path, S.AIR_RESPONSE_SCHEMA, "2024-01-10", "2024-01-19", chunk_days=7)
    rows = L.rows_from_responses(landed, L.AIR_RENAME)
    return out(rows.filter(F.to_date("timestamp").between("2024-01-10", "2024-01-19")).select(*AIR_OUT))


CHUNK_COLS = ["city", "chunk_index", "chunk_start", "chunk_end"]


@register("backfill_chunks", O.with_(FX_CTES + [
    "sp AS (SELECT city, CAST(max(timestamp) AS DATE) + INTERVAL 1 DAY AS as_of FROM raw GROUP BY city)",
    "sp2 AS (SELECT city, CAST(as_of - INTERVAL 1 DAY - INTERVAL 29 DAY AS DATE) AS start_date, "
    "CAST(as_of - INTERVAL 1 DAY AS DATE) AS end_date FROM sp)",
    "ch AS (SELECT city, start_date, end_date, unnest(generate_series(CAST(start_date AS TIMESTAMP), "
    "CAST(end_date AS TIMESTAMP), INTERVAL 7 DAY)) AS cs FROM sp2)"],
    "SELECT city, CAST(date_diff('day', start_date, CAST(cs AS DATE)) // 7 + 1 AS BIGINT) AS chunk_index, "
    "CAST(cs AS DATE) AS chunk_start, least(CAST(cs AS DATE) + 6, end_date) AS chunk_end FROM ch"))
def q_backfill_chunks(spark, sf_dir):
    """180-day/30-day chunking re-aimed at each city's span: 30 days in 7-day chunks."""
    as_of = raw_rows(spark, sf_dir).groupBy("city").agg(F.date_add(F.to_date(F.max("timestamp")), 1).alias("as_of"))
    start, end = L.backfill_range(F.col("as_of"), 30)
    return L.backfill_chunks(as_of.select("city", start, end), 7).select(*CHUNK_COLS)


UNION_OUT = ["city", "timestamp"] + O.AIR + O.WEATHER


@register("src_union_chunks", sql(FX_CTES, UNION_OUT, "raw", RAW_DBL))
def q_src_union_chunks(spark, sf_dir):
    """Per 7-day chunk: air rows join weather rows; empty chunks vanish; stack; keep last."""
    a = L.rows_from_responses(air_responses(spark, sf_dir, 7), L.AIR_RENAME, extra=["chunk_start"])
    w = L.rows_from_responses(weather_responses(spark, sf_dir, 7), L.WEATHER_RENAME, extra=["chunk_start"])
    chunks = a.join(w, ["city", "chunk_start", "timestamp"], "inner")
    if chunks.isEmpty():
        raise ValueError("No historical data fetched.")
    return out(dedupe_keep_last(chunks, order=("chunk_start",)).select(*UNION_OUT))


GEO_CAND_SQL = ("SELECT s.s_nationkey AS request_id, CASE WHEN s.s_suppkey % 3 = 0 THEN replace(n.n_name, '_', ' ') "
                "ELSE concat(replace(n.n_name, '_', ' '), ' EAST') END AS cname, r.r_name AS ccountry, "
                "CASE WHEN s.s_suppkey % 4 = 0 THEN NULL WHEN s.s_suppkey % 2 = 0 THEN 'EAST' ELSE 'WEST' END AS cadmin1, "
                "s.s_acctbal / 1e2 AS clat, s.s_suppkey / 1e1 AS clon, s.s_suppkey AS position "
                "FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey")
GEO_REQ_SQL = ("SELECT n_nationkey AS request_id, lower(replace(n_name, '_', ' ')) AS name, lower(r_name) AS country, "
               "'east' AS admin1, CASE WHEN n_nationkey % 5 = 0 THEN 25e0 END AS latitude, "
               "CASE WHEN n_nationkey % 10 = 0 THEN 68e0 END AS longitude FROM nation JOIN region ON n_regionkey = r_regionkey "
               "WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)")
GEO_COLS = ["request_id", "name", "country", "city", "latitude", "longitude", "matched"]


@register("geo_resolve", O.with_([
    f"cand AS ({GEO_CAND_SQL})", f"req AS ({GEO_REQ_SQL})",
    "j AS (SELECT c.*, (lower(c.cname) = q.name AND lower(c.ccountry) = q.country AND "
    "coalesce(lower(c.cadmin1) = q.admin1, false)) AS m FROM cand c JOIN req q USING (request_id))",
    "b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN m THEN 0 ELSE 1 END, "
    "position) AS rn FROM j) WHERE rn = 1)"],
    "SELECT q.request_id, q.name, q.country, replace(lower(q.name), ' ', '_') AS city, "
    f"{O.r6('CASE WHEN q.latitude IS NOT NULL AND q.longitude IS NOT NULL THEN q.latitude ELSE b.clat END')} AS latitude, "
    f"{O.r6('CASE WHEN q.latitude IS NOT NULL AND q.longitude IS NOT NULL THEN q.longitude ELSE b.clon END')} AS longitude, "
    "coalesce(b.m, false) AS matched FROM req q LEFT JOIN b USING (request_id)"))
def q_geo_resolve(spark, sf_dir):
    sup, nat, reg = (read_table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    geo = nat.join(reg, nat.n_regionkey == reg.r_regionkey)
    cand = sup.join(geo, sup.s_nationkey == geo.n_nationkey).select(
        F.col("s_nationkey").alias("request_id"),
        F.when(F.col("s_suppkey") % 3 == 0, F.replace("n_name", F.lit("_"), F.lit(" ")))
        .otherwise(F.concat(F.replace("n_name", F.lit("_"), F.lit(" ")), F.lit(" EAST"))).alias("name"),
        F.col("r_name").alias("country"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None).cast("string"))
        .when(F.col("s_suppkey") % 2 == 0, F.lit("EAST")).otherwise(F.lit("WEST")).alias("admin1"),
        (F.col("s_acctbal") / F.lit(100.0)).alias("latitude"), (F.col("s_suppkey") / F.lit(10.0)).alias("longitude"),
        F.col("s_suppkey").alias("position"))
    req = geo.select(F.col("n_nationkey").alias("request_id"),
                     F.lower(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("name"),
                     F.lower("r_name").alias("country"), F.lit("east").alias("admin1"),
                     F.when(F.col("n_nationkey") % 5 == 0, F.lit(25.0)).alias("latitude"),
                     F.when(F.col("n_nationkey") % 10 == 0, F.lit(68.0)).alias("longitude"))
    # Only half of a pair configured counts as none; nations without any candidate are no requests.
    req = req.join(cand.select("request_id").distinct(), "request_id", "left_semi")
    return out(geo_resolve(req, cand).select(*GEO_COLS))


@register("city_slug", O.with_([], "SELECT s.s_suppkey, replace(lower(concat(replace(n.n_name, '_', ' '), ' ', "
                                   "s.s_name, ' City')), ' ', '_') AS city FROM supplier s JOIN nation n "
                                   "ON s.s_nationkey = n.n_nationkey"))
def q_city_slug(spark, sf_dir):
    """Slugs of one place name per supplier (grows with the supplier table)."""
    sup, nat = read_table(spark, sf_dir, "supplier"), read_table(spark, sf_dir, "nation")
    name = F.concat(F.replace("n_name", F.lit("_"), F.lit(" ")), F.lit(" "), F.col("s_name"), F.lit(" City"))
    return sup.join(nat, sup.s_nationkey == nat.n_nationkey).select("s_suppkey", city_slug(name).alias("city"))


@register("src_training_table", sql(O.training_ctes(), TC_COLS, "train"))
def q_src_training_table(spark, sf_dir):
    path = ST.write_table(training_table(spark, sf_dir), "training_table", partition_by=["city"])
    return out(ST.read_training_table(spark, path).select(*TC_COLS))


UPSERT_COLS = RAW_OUT + ["ingestion_timestamp"]


@register("sink_keyed_upsert", sql(DD_CTES, UPSERT_COLS, "dd", RAW_DBL))
def q_sink_keyed_upsert(spark, sf_dir):
    obs = observations(spark, sf_dir).select(*UPSERT_COLS, "run")
    path = scratch_path(spark, "observations")
    ST.keyed_upsert(obs.filter(F.col("run") == 1).drop("run"), path)
    table = ST.keyed_upsert(obs.filter(F.col("run") == 2).drop("run"), path)
    return out(table.select(*UPSERT_COLS))


CAST_COLS = ["city", "timestamp", "ingestion_timestamp", "hour", "day_of_week", "is_weekend", "pm25", S.TARGET_COLUMN]


@register("cast_for_store", O.with_(O.training_ctes() + [
    "ci AS (SELECT city, CASE WHEN hour = 5 AND day_of_week = 2 THEN 'bad' ELSE CAST(timestamp AS VARCHAR) END AS ts, "
    "CAST(ingestion_timestamp AS VARCHAR) AS its, CASE WHEN hour = 3 THEN NULL ELSE CAST(hour AS VARCHAR) END AS h, "
    "day_of_week, is_weekend, CASE WHEN hour = 7 THEN 'n/a' ELSE CAST(pm25 AS VARCHAR) END AS p, us_aqi FROM train)"],
    "SELECT city, TRY_CAST(ts AS TIMESTAMP) AS timestamp, TRY_CAST(its AS TIMESTAMP) AS ingestion_timestamp, "
    "CAST(coalesce(TRY_CAST(h AS DOUBLE), 0) AS BIGINT) AS hour, day_of_week, is_weekend, "
    f"{O.r6('TRY_CAST(p AS DOUBLE)')} AS pm25, {O.r6('us_aqi')} AS us_aqi FROM ci "
    "WHERE TRY_CAST(ts AS TIMESTAMP) IS NOT NULL"))
def q_cast_for_store(spark, sf_dir):
    t = training_table(spark, sf_dir)
    h = F.col("hour")
    messy = t.select(
        "city", F.when((h == 5) & (F.col("day_of_week") == 2), F.lit("bad"))
        .otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
        F.col("ingestion_timestamp").cast("string").alias("ingestion_timestamp"),
        F.when(h == 3, F.lit(None)).otherwise(h.cast("string")).alias("hour"), "day_of_week", "is_weekend",
        F.when(h == 7, F.lit("n/a")).otherwise(F.col("pm25").cast("string")).alias("pm25"), S.TARGET_COLUMN)
    return out(ST.cast_for_store(messy).select(*CAST_COLS))


@register("sink_csv", sql(O.training_ctes(), S.TRAINING_OUTPUT_COLUMNS, "train"))
def q_sink_csv(spark, sf_dir):
    path = ST.write_csv(training_table(spark, sf_dir), "training_csv")
    return out(ST.read_csv(spark, path, S.TRAINING_SCHEMA))


@register("selected_features", O.with_(O.training_ctes(), " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) > 0 AS selected, CAST({i + 1} AS BIGINT) AS rank FROM train"
    for i, c in enumerate(S.MODEL_FEATURE_COLUMNS))))
def q_selected_features(spark, sf_dir):
    return ST.selected_features(training_table(spark, sf_dir))


# Registry records derived from the training table: one model per city,
# one version per week of data, stand-in metrics against the target.
def registry_records(spark, sf_dir):
    from ..operators.forecast import standin_score
    from ..operators.summarize import regression_metrics
    t = training_table(spark, sf_dir).withColumn("_pred", standin_score())
    t = t.withColumns({"name": F.concat(F.lit("aqi_"), F.col("city")),
                       "version": (F.floor(F.datediff(F.to_date("timestamp"), F.lit("2024-01-01").cast("date")) / 7)
                                   + 1).cast("bigint")})
    m = regression_metrics(t, S.TARGET_COLUMN, "_pred", group=["name", "version"], digits=None)
    span = t.groupBy("name", "version").agg(F.min("timestamp").alias("training_start"),
                                            F.max("timestamp").alias("training_end"))
    rec = m.join(span, ["name", "version"]).select(
        "name", "version", "mae", "rmse", "r2", F.lit(19).cast("bigint").alias("feature_count"),
        F.when(F.col("version") % 2 == 0, F.lit("Random Forest")).alias("best_model_name"),
        F.col("rows").alias("training_rows"), "training_start", "training_end",
        F.col("training_end").alias("created_at"))
    return rec


def _registry_sql():
    e = f"({S.TARGET_COLUMN} - {O.STANDIN_SQL})"
    return O.training_ctes() + [
        "rt AS (SELECT *, concat('aqi_', city) AS name, CAST(date_diff('day', DATE '2024-01-01', CAST(timestamp AS DATE)) "
        "// 7 + 1 AS BIGINT) AS version FROM train)",
        f"reg AS (SELECT name, version, avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse, "
        f"CASE WHEN count(*) < 2 THEN NULL WHEN var_pop({S.TARGET_COLUMN}) * count(*) = 0 THEN CASE WHEN sum({e} * {e}) = 0 "
        f"THEN 1e0 ELSE 0e0 END ELSE 1e0 - sum({e} * {e}) / (var_pop({S.TARGET_COLUMN}) * count(*)) END AS r2, "
        "CAST(19 AS BIGINT) AS feature_count, CASE WHEN version % 2 = 0 THEN 'Random Forest' END AS best_model_name, "
        "CAST(count(*) AS BIGINT) AS training_rows, min(timestamp) AS training_start, max(timestamp) AS training_end, "
        "max(timestamp) AS created_at FROM rt GROUP BY name, version)",
    ]


REG_COLS = ["name", "version", "mae", "rmse", "r2", "feature_count", "best_model_name", "training_rows",
            "training_start", "training_end", "created_at"]


@register("registry_latest", sql(_registry_sql() + [
    "rl AS (SELECT r.* FROM reg r WHERE version = (SELECT max(version) FROM reg r2 WHERE r2.name = r.name))"],
    REG_COLS, "rl", {"mae", "rmse", "r2"}))
def q_registry_latest(spark, sf_dir):
    return out(ST.registry_latest(registry_records(spark, sf_dir)).select(*REG_COLS))


MERGE_COLS = ["name", "display_name", "best_model_name", "model_name", "features", "feature_count", "training_rows"]
_UPPER_FEATURES = ", ".join(f"' {c.upper()} '" for c in S.MODEL_FEATURE_COLUMNS)
_FEATURES = ", ".join(f"'{c}'" for c in S.MODEL_FEATURE_COLUMNS)


@register("registry_metadata_merge", O.with_(_registry_sql() + [
    "docs AS (SELECT name, version AS doc_order, best_model_name, CASE WHEN version % 3 = 0 THEN NULL ELSE 'Random Forest' "
    f"END AS model_name, CASE WHEN version % 2 = 0 THEN [{_UPPER_FEATURES}] END AS ff, [{_FEATURES}] AS bf, "
    "training_rows FROM reg)",
    "lastv AS (SELECT name, "
    "(SELECT d2.best_model_name FROM docs d2 WHERE d2.name = d.name AND d2.best_model_name IS NOT NULL ORDER BY d2.doc_order DESC LIMIT 1) AS best_model_name, "
    "(SELECT d2.model_name FROM docs d2 WHERE d2.name = d.name AND d2.model_name IS NOT NULL ORDER BY d2.doc_order DESC LIMIT 1) AS model_name, "
    "(SELECT d2.ff FROM docs d2 WHERE d2.name = d.name AND d2.ff IS NOT NULL ORDER BY d2.doc_order DESC LIMIT 1) AS ff, "
    "(SELECT d2.bf FROM docs d2 WHERE d2.name = d.name AND d2.bf IS NOT NULL ORDER BY d2.doc_order DESC LIMIT 1) AS bf, "
    "(SELECT d2.training_rows FROM docs d2 WHERE d2.name = d.name AND d2.training_rows IS NOT NULL ORDER BY d2.doc_order DESC LIMIT 1) AS training_rows "
    "FROM (SELECT DISTINCT name FROM docs) d)"],
    "SELECT name, coalesce(best_model_name, model_name, 'Best AQI Model') AS display_name, best_model_name, model_name, "
    "array_to_string(list_transform(coalesce(ff, bf), lambda x: lower(trim(x))), ',') AS features, "
    "CAST(len(coalesce(ff, bf)) AS BIGINT) AS feature_count, training_rows FROM lastv"))
def q_registry_metadata_merge(spark, sf_dir):
    reg = registry_records(spark, sf_dir)
    docs = reg.select(
        "name", F.col("version").alias("doc_order"), "best_model_name",
        F.when(F.col("version") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("Random Forest")).alias("model_name"),
        F.when(F.col("version") % 2 == 0, F.array(*[F.lit(f" {c.upper()} ") for c in S.MODEL_FEATURE_COLUMNS]))
        .alias("file_feature_columns"),
        F.array(*[F.lit(c) for c in S.MODEL_FEATURE_COLUMNS]).alias("bundle_feature_columns"), "training_rows")
    m = ST.registry_metadata_merge(docs)
    return m.withColumn("features", F.array_join("feature_columns", ",")).select(*MERGE_COLS)


def _payloads(spark, sf_dir):
    """The documents of all cities; the scored rows that feed their four parts are derived once."""
    from ..operators import summarize as SU
    from .payload import prediction_payload
    hourly = checkpoint(scored_api(spark, sf_dir), "scored-hours")
    return prediction_payload(hourly, SU.daily_summary_api(hourly), SU.pollutant_summary(hourly),
                              SU.headline_summary(hourly),
                              {**MODEL_PART, "feature_columns": S.MODEL_FEATURE_COLUMNS}, "norland", FX.CITY_TIMEZONE)


def _parsed(spark, sf_dir):
    from .payload import payload_read
    return payload_read(checkpoint(_payloads(spark, sf_dir), "payloads"))


@register("payload_read", sql(API + [
    "pr AS (SELECT * FROM api)"], HR_COLS, "pr", set(HR_COLS) - {"city", "timestamp", "aqi_category"}))
def q_payload_read(spark, sf_dir):
    return out(_parsed(spark, sf_dir)[0].select(*HR_COLS))


@register("payload_read_daily", ORACLE["daily_summary_api"])
def q_payload_read_daily(spark, sf_dir):
    return out(_parsed(spark, sf_dir)[1].select(*DAPI_COLS))


@register("payload_read_pollutants", ORACLE["pollutant_summary"])
def q_payload_read_pollutants(spark, sf_dir):
    return _parsed(spark, sf_dir)[2].select(*PS_COLS)


def _text_payloads(spark, sf_dir):
    """The documents as a careless writer gives them: every number as text, the temperature unreadable, and no
    days where the city's name has an even length."""
    docs = checkpoint(_payloads(spark, sf_dir), "payloads")
    text = F.regexp_replace("payload", r'"(\w+)":(-?[0-9][0-9.eE+-]*)', '"$1":" $2 "')
    text = F.regexp_replace(text, r'"temperature_2m":"[^"]*"', '"temperature_2m":"n/a"')
    no_days = F.when(F.length("city") % 2 == 0, F.regexp_replace(text, '"daily":', '"other":')).otherwise(text)
    return docs.select("city", no_days.alias("payload"))


@register("payload_read_text", sql(API + ["pr AS (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS temperature_2m) FROM api)"],
                                   HR_COLS, "pr", set(HR_COLS) - {"city", "timestamp", "aqi_category"}))
def q_payload_read_text(spark, sf_dir):
    from .payload import payload_read
    return out(payload_read(_text_payloads(spark, sf_dir))[0].select(*HR_COLS))


@register("payload_read_text_daily", f"SELECT * FROM ({ORACLE['daily_summary_api']}) WHERE length(city) % 2 = 1")
def q_payload_read_text_daily(spark, sf_dir):
    from .payload import payload_read
    return out(payload_read(_text_payloads(spark, sf_dir))[1].select(*DAPI_COLS))


MODEL_PART = {"model_name": "aqi_model", "model_version": 1, "best_model_name": "stand-in"}


@register("prediction_payload", f"""SELECT h.*, 'success' AS status, 'norland' AS country, '{FX.CITY_TIMEZONE}' AS timezone,
 'aqi_model' AS model_name, CAST(1 AS BIGINT) AS model_version, 'stand-in' AS best_model_name,
 CAST({len(S.MODEL_FEATURE_COLUMNS)} AS BIGINT) AS feature_count, CAST({len(S.MODEL_FEATURE_COLUMNS)} AS BIGINT) AS features,
 h.forecast_hours AS hours, (SELECT CAST(count(*) AS BIGINT) FROM ({ORACLE['daily_summary_api']}) d WHERE d.city = h.city) AS days,
 (SELECT CAST(count(*) AS BIGINT) FROM ({ORACLE['pollutant_summary']}) p WHERE p.city = h.city) AS pollutants
 FROM ({ORACLE['headline_summary']}) h""")
def q_prediction_payload(spark, sf_dir):
    """Every document parsed back: status, place, summary, model and the lengths of its arrays."""
    from .payload import payload_head
    return out(payload_head(checkpoint(_payloads(spark, sf_dir), "payloads")))


@register("src_air_forecast", sql(FX_CTES + [f"fc AS (SELECT * RENAME (us_aqi AS {S.REFERENCE_COLUMN}) FROM air)"],
                                  FORECAST_OUT, "fc", set(FORECAST_OUT[2:])))
def q_src_air_forecast(spark, sf_dir):
    """Forecast flavour of the air source: the provider's index is a reference, not the target."""
    return out(L.rows_from_responses(air_responses(spark, sf_dir), L.FORECAST_AIR_RENAME).select(*FORECAST_OUT))


@register("sink_cache", sql(O.training_ctes(), S.TRAINING_OUTPUT_COLUMNS, "train"))
def q_sink_cache(spark, sf_dir):
    """Binary cache of the training table: Parquet in the shared folder, read back."""
    path = ST.write_table(training_table(spark, sf_dir), "training_cache")
    return out(spark.read.parquet(path).select(*S.TRAINING_OUTPUT_COLUMNS))
