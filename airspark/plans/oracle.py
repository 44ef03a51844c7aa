"""DuckDB SQL for the oracle check: the same semantics as plain SQL.

The oracle states WHAT each query computes in the simplest SQL (plain
``PARTITION BY city`` windows, ``row_number`` keep-last, ``median``); the
Spark side computes the same thing with the skew-safe layouts.  Doubles
are rounded on both sides with ``rint(x*1e6)/1e6`` (``round_even`` here).
"""

from __future__ import annotations

from .. import schemas as S
from ..sources.fixture import AS_OF, RUN_TIMESTAMPS

RAW = S.RAW_FEATURE_COLUMNS
AIR = ["pm25", "pm10", "carbon_monoxide", "nitrogen_dioxide", "ozone", "us_aqi"]
WEATHER = S.RAW_WEATHER_COLUMNS


def dbl(v) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def num(v) -> str:
    return str(int(v)) if float(v).is_integer() else dbl(v)


def r6(expr: str) -> str:
    return f"round_even(({expr}) * 1e6, 0) / 1e6"


def r_digits(expr: str, d: int) -> str:
    return f"round_even(({expr}) * {10 ** d}e0, 0) / {10 ** d}e0"


def clip(c: str, lo, hi, cast_long=False) -> str:
    if cast_long:
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, {int(hi)}), {int(lo)}) END"
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, {dbl(hi)}), {dbl(lo)}) END"


def seed_cte(variant: str = "events") -> str:
    if variant == "events":
        return ("h AS (SELECT event_type AS city, date_trunc('hour', ts) AS timestamp, "
                "min_by(value, event_id) AS v1, max_by(value, event_id) AS v2, max(event_id) AS emax "
                "FROM events GROUP BY 1, 2)")
    return ("h AS (SELECT concat('s', l_suppkey) AS city, date_trunc('hour', l_shipdate) AS timestamp, "
            "min(l_quantity) * 2e0 AS v1, max(l_quantity) * 2e0 AS v2, max(l_orderkey) AS emax "
            "FROM lineitem GROUP BY 1, 2)")


AIR_SELECT = """SELECT city, timestamp, emax,
  CASE WHEN emax % 11 = 0 THEN NULL ELSE v1 END AS pm25,
  CASE WHEN emax % 13 = 0 THEN NULL ELSE v1 + v2 END AS pm10,
  v1 * 3e2 AS carbon_monoxide,
  CASE WHEN emax % 17 = 0 THEN NULL ELSE v2 * 2e1 END AS nitrogen_dioxide,
  v2 * 5e0 AS ozone,
  v1 + v2 + (emax % 100) * 3e0 AS us_aqi
FROM h"""

WEATHER_SELECT = """SELECT city, timestamp,
  (emax % 140) / 2e0 - 12e0 AS temperature_2m,
  (emax % 111) * 1e0 AS relative_humidity_2m,
  CASE WHEN emax % 5 = 0 THEN v2 ELSE 0e0 END AS precipitation,
  v1 / 2e0 AS windspeed_10m,
  88e1 + (emax % 240) AS surface_pressure,
  v1 * 1e1 AS shortwave_radiation,
  v2 / 5e0 AS et0_fao_evapotranspiration
FROM h WHERE emax % 19 <> 0"""

RAW_COLS = ["city", "timestamp", "emax"] + AIR + WEATHER


def fixture_ctes(variant: str = "events") -> list[str]:
    raw_sel = ", ".join(["a.city", "a.timestamp", "a.emax"] + [f"a.{c}" for c in AIR] + [f"w.{c}" for c in WEATHER])
    others = ", ".join(c if c != "pm25" else "pm25 + 1e0 AS pm25" for c in RAW_COLS)
    plain = ", ".join(RAW_COLS)
    run_ts = (f"CASE WHEN run = 1 THEN TIMESTAMP '{RUN_TIMESTAMPS[1]}' "
              f"ELSE TIMESTAMP '{RUN_TIMESTAMPS[2]}' END")
    return [
        seed_cte(variant),
        f"air AS ({AIR_SELECT})",
        f"weather AS ({WEATHER_SELECT})",
        f"raw AS (SELECT {raw_sel} FROM air a JOIN weather w ON a.city = w.city AND a.timestamp = w.timestamp)",
        f"runs0 AS (SELECT {plain}, 1 AS run FROM raw UNION ALL SELECT {others}, 2 AS run FROM raw WHERE emax % 7 = 0)",
        f"runs AS (SELECT *, {run_ts} AS ingestion_timestamp, {run_ts} AS forecast_run_timestamp FROM runs0)",
    ]


def dedupe_cte(name: str, src: str, order: str = "ingestion_timestamp DESC") -> str:
    return (f"{name} AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY city, timestamp ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1)")


def fill_expr(c: str) -> str:
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY city ORDER BY timestamp "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER "
            f"(PARTITION BY city ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))")


def fill_cte(name: str, src: str, cols) -> str:
    repl = ", ".join(f"{fill_expr(c)} AS {c}" for c in cols)
    return f"{name} AS (SELECT * REPLACE ({repl}) FROM {src})"


def clip_cte(name: str, src: str, cols) -> str:
    repl = ", ".join(f"{clip(c, *S.CLIP_BOUNDS[c], cast_long=c in S.LONG_COLUMNS)} AS {c}" for c in cols)
    return f"{name} AS (SELECT * REPLACE ({repl}) FROM {src})"


def roll_expr(src: str, n: int) -> str:
    return (f"avg({src}) OVER (PARTITION BY city ORDER BY timestamp "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")


ROLLS = [("pm25_24h", "pm25", 24), ("pm10_24h", "pm10", 24), ("o3_8h", "ozone", 8),
         ("co_8h", "carbon_monoxide", 8)]


def roll_cte(name: str, src: str) -> str:
    adds = ", ".join(f"{roll_expr(s, n)} AS {o}" for o, s, n in ROLLS)
    return f"{name} AS (SELECT *, {adds} FROM {src})"


CONVERT_SELECT = (f"nitrogen_dioxide AS no2_1h, o3_8h * {dbl(S.O3_TO_PPB)} AS o3_8h_ppb, "
                  f"co_8h * {dbl(S.CO_TO_PPM)} AS co_8h_ppm, nitrogen_dioxide * {dbl(S.NO2_TO_PPB)} AS no2_1h_ppb")


def convert_cte(name: str, src: str) -> str:
    return f"{name} AS (SELECT *, {CONVERT_SELECT} FROM {src})"


TIME_PARTS_SELECT = ("CAST(hour(timestamp) AS BIGINT) AS hour, CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week, "
                     "CAST(CASE WHEN isodow(timestamp) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend")
CYCLIC_SELECT = ("sin(2 * pi() * hour / 24e0) AS hour_sin, cos(2 * pi() * hour / 24e0) AS hour_cos, "
                 "sin(2 * pi() * day_of_week / 7e0) AS day_of_week_sin, "
                 "cos(2 * pi() * day_of_week / 7e0) AS day_of_week_cos")


def time_cte(name: str, src: str) -> str:
    return (f"{name}_t AS (SELECT *, {TIME_PARTS_SELECT} FROM {src}), "
            f"{name} AS (SELECT *, {CYCLIC_SELECT} FROM {name}_t)")


def quantile_sql(c: str, src: str, p: float) -> str:
    """numpy linear quantile, spelled out over the sorted values (scalar subquery)."""
    v = f"((n - 1) * {float(p)!r}e0)"
    lo = f"CAST(floor({v}) AS BIGINT)"
    a = f"l[{lo} + 1]"
    b = f"l[least({lo} + 1, n - 1) + 1]"
    g = f"({v} - floor({v}))"
    return (f"(SELECT CASE WHEN n = 0 THEN NULL WHEN {g} >= 0.5e0 THEN {b} - ({b} - {a}) * (1 - {g}) "
            f"ELSE {a} + ({b} - {a}) * {g} END FROM (SELECT list_sort(list(CAST({c} AS DOUBLE))) AS l, "
            f"count({c}) AS n FROM {src}))")


def median_sql(c: str, src: str) -> str:
    """Mean of the two middle values (pandas median)."""
    return (f"(SELECT CASE WHEN n = 0 THEN NULL ELSE (l[(n - 1) // 2 + 1] + l[n // 2 + 1]) / 2 END FROM "
            f"(SELECT list_sort(list(CAST({c} AS DOUBLE))) AS l, count({c}) AS n FROM {src}))")


def median_cte(name: str, src: str, cols) -> str:
    repl = ", ".join(
        f"CAST(coalesce({c}, {median_sql(c, src)}, 0) AS {'BIGINT' if c in S.LONG_COLUMNS else 'DOUBLE'}) AS {c}"
        for c in cols)
    return f"{name} AS (SELECT * REPLACE ({repl}) FROM {src})"


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def with_(ctes, final: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" + final) if ctes else final


def round_select(cols, doubles, src: str, extra: str = "") -> str:
    parts = [r6(c) + f" AS {c}" if c in doubles else c for c in cols]
    return f"SELECT {', '.join(parts)} FROM {src} {extra}"


TRAIN_REQUIRED = RAW + S.DERIVED_DIAGNOSTIC_COLUMNS + S.MODEL_FEATURE_COLUMNS + [S.TARGET_COLUMN]
TRAIN_REQUIRED = S.unique(TRAIN_REQUIRED)


def training_ctes(variant: str = "events") -> list[str]:
    """CTE chain ending in ``train`` (31 columns, unrounded)."""
    fill_cols = RAW + [S.TARGET_COLUMN]
    return fixture_ctes(variant) + [
        dedupe_cte("dd", "runs"),
        fill_cte("filled", "dd", fill_cols),
        clip_cte("clipped", "filled", fill_cols),
        roll_cte("rolled", "clipped"),
        convert_cte("conv", "rolled"),
        time_cte("timed", "conv"),
        f"proj AS (SELECT {', '.join(S.TRAINING_OUTPUT_COLUMNS)} FROM timed)",
        median_cte("imputed", "proj", TRAIN_REQUIRED),
        clip_cte("clip2", "imputed", [c for c in S.CLIP_BOUNDS if c in S.TRAINING_OUTPUT_COLUMNS]),
        f"train AS (SELECT {', '.join(S.TRAINING_OUTPUT_COLUMNS)} FROM clip2 WHERE {not_null(TRAIN_REQUIRED)})",
    ]


def doubles_of(cols) -> set:
    return {c for c in cols if S.column_type(c).typeName() == "double"}


def forecast_context_ctes(variant: str = "events", as_of: str = AS_OF) -> list[str]:
    """CTE chain ending in ``fctx``: past+future rows with all features (33 columns)."""
    fill_cols = RAW + [S.REFERENCE_COLUMN]
    cutoff = f"date_trunc('hour', TIMESTAMP '{as_of}')"
    return fixture_ctes(variant) + [
        f"fin AS (SELECT * EXCLUDE (us_aqi), us_aqi AS {S.REFERENCE_COLUMN}, "
        f"CAST(CASE WHEN timestamp > {cutoff} THEN 1 ELSE 0 END AS BIGINT) AS is_future FROM runs)",
        dedupe_cte("fdd", "fin", "forecast_run_timestamp DESC, ingestion_timestamp DESC"),
        fill_cte("ffilled", "fdd", fill_cols),
        clip_cte("fclipped", "ffilled", fill_cols),
        roll_cte("frolled", "fclipped"),
        convert_cte("fconv", "frolled"),
        time_cte("ftimed", "fconv"),
        clip_cte("fclip2", "ftimed", [c for c in S.CLIP_BOUNDS if c in S.FORECAST_OUTPUT_COLUMNS]),
        f"fctx AS (SELECT {', '.join(S.FORECAST_OUTPUT_COLUMNS)} FROM fclip2)",
    ]


def forecast_ctes(variant: str = "events", as_of: str = AS_OF, horizon: int = S.DEFAULT_HORIZON_HOURS) -> list[str]:
    return forecast_context_ctes(variant, as_of) + [
        f"fc AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp) AS _rn "
        f"FROM fctx WHERE is_future = 1) WHERE _rn <= {int(horizon)})",
    ]



def category_sql(x: str) -> str:
    parts = [f"WHEN {x} <= {dbl(u)} THEN '{lab}'" for u, lab in S.AQI_CATEGORY_EDGES]
    return f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN 'Unknown' {' '.join(parts)} ELSE '{S.AQI_TOP_CATEGORY}' END)"


def advice_sql(cat: str, dashboard: bool = False) -> str:
    parts = []
    for lab, text in S.AQI_ADVICE.items():
        if dashboard and lab == "Good":
            text = S.AQI_ADVICE_DASHBOARD_GOOD
        parts.append(f"WHEN {cat} = '{lab}' THEN '{text}'")
    return f"(CASE {' '.join(parts)} ELSE '{S.AQI_ADVICE_FALLBACK}' END)"


def level_sql(column_name: str, x: str) -> str:
    edges = S.POLLUTANT_BREAKPOINTS.get(column_name)
    if edges is None:
        return f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN 'Unknown' ELSE 'Measured' END)"
    parts = [f"WHEN {x} <= {dbl(u)} THEN '{lab}'" for u, (_, lab) in zip(edges, S.AQI_CATEGORY_EDGES)]
    return f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN 'Unknown' {' '.join(parts)} ELSE '{S.AQI_TOP_CATEGORY}' END)"


def clip_sql(x: str, lo, hi) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest(least({x}, {dbl(hi)}), {dbl(lo)}) END)"


STANDIN_SQL = "((round_even(pm25_24h * 1e6, 0) / 1e6) * (round_even(pm25_24h * 1e6, 0) / 1e6) / 2e1)"

OLD_RUN = "2024-01-24 00:00:00"


def scoring_ctes(horizon: int = S.DEFAULT_HORIZON_HOURS) -> list[str]:
    """Forecast store (old + current snapshot) -> prepared horizon rows ``prep``."""
    ref = S.REFERENCE_COLUMN
    med = ", ".join(
        f"CAST(coalesce({c}, median({c}) OVER (PARTITION BY city), 0) AS "
        f"{'BIGINT' if c in S.LONG_COLUMNS else 'DOUBLE'}) AS {c}" for c in S.MODEL_FEATURE_COLUMNS)
    return forecast_context_ctes() + [
        f"cur AS (SELECT * REPLACE (TIMESTAMP '{RUN_TIMESTAMPS[2]}' AS forecast_run_timestamp) FROM fctx)",
        f"old AS (SELECT * REPLACE (TIMESTAMP '{OLD_RUN}' AS forecast_run_timestamp, {ref} + 1e0 AS {ref}) FROM fctx)",
        "store AS (SELECT * FROM cur UNION ALL SELECT * FROM old)",
        "slat AS (SELECT s.* FROM store s WHERE s.forecast_run_timestamp = "
        "(SELECT max(s2.forecast_run_timestamp) FROM store s2 WHERE s2.city = s.city))",
        "sfut AS (SELECT * FROM slat WHERE is_future = 1)",
        dedupe_cte("sdd", "sfut", "forecast_run_timestamp DESC, timestamp DESC"),
        f"shz AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp) AS _rn "
        f"FROM sdd) WHERE _rn <= {int(horizon)})",
        f"prep AS (SELECT * REPLACE ({med}) FROM shz)",
    ]


def api_ctes() -> list[str]:
    return scoring_ctes() + [
        f"api0 AS (SELECT *, round_even({clip_sql(STANDIN_SQL, 0, 500)} * 1e1, 0) / 1e1 AS predicted_aqi FROM prep)",
        f"api AS (SELECT *, {category_sql('predicted_aqi')} AS aqi_category, "
        "row_number() OVER (PARTITION BY city ORDER BY timestamp) AS forecast_hour FROM api0)",
        "apid AS (SELECT *, CAST((forecast_hour - 1) // 24 + 1 AS BIGINT) AS forecast_day FROM api)",
    ]


def eval_ctes(raw: str = STANDIN_SQL, src: str = "prep") -> list[str]:
    ref = S.REFERENCE_COLUMN
    return scoring_ctes() + [
        f"ev0 AS (SELECT *, round_even({clip_sql(raw, 0, 500)} * 1e2, 0) / 1e2 AS predicted_aqi FROM {src})",
        f"ev AS (SELECT *, round_even(abs({ref} - predicted_aqi) * 1e2, 0) / 1e2 AS absolute_error, "
        f"round_even(({ref} - predicted_aqi) * ({ref} - predicted_aqi) * 1e2, 0) / 1e2 AS squared_error, "
        "CAST(row_number() OVER (PARTITION BY city ORDER BY timestamp) AS BIGINT) AS forecast_hour FROM ev0)",
        "evd AS (SELECT *, CAST((forecast_hour - 1) // 24 + 1 AS BIGINT) AS forecast_day FROM ev)",
    ]
