"""Profile, quality, model-metric and exploratory queries (oracle-checked)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import summarize as SU
from ..operators.quality import quality_report
from ..operators.split import time_split
from ..operators.forecast import standin_score
from ..functions.numeric import np_round
from . import eda as E
from . import oracle as O
from .catalog import register
from .q_core import FC, forecast_context, out, training_table, sql
from .q_scoring import EV, scored_eval

TRAIN = O.training_ctes()
TCOLS = S.TRAINING_OUTPUT_COLUMNS
FEATS = S.MODEL_FEATURE_COLUMNS
TARGET = S.TARGET_COLUMN


@register("table_profile", O.with_(TRAIN, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, CAST(count(*) AS BIGINT) AS row_count, "
    f"min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp, CAST({len(TCOLS)} AS BIGINT) AS column_count FROM train"
    for c in TCOLS)))
def q_table_profile(spark, sf_dir):
    return SU.table_profile(training_table(spark, sf_dir))


def _quality_sql():
    null_rows = " UNION ALL ".join(
        f"SELECT 'feature_nulls' AS \"check\", '{c}' AS subject, CAST(count(*) - count({c}) AS BIGINT) AS value, "
        f"CASE WHEN count(*) - count({c}) > 0 THEN 'error' ELSE 'ok' END AS status FROM fc" for c in FEATS)
    fixed = " UNION ALL ".join(
        f"SELECT '{k}', 'table', CAST({v} AS BIGINT), 'ok'" for k, v in
        (("missing_columns", 0), ("feature_count", 19), ("blocked_month_columns", 0), ("target_in_features", 0)))
    return O.with_(FC, f"""SELECT 'row_count' AS "check", 'table' AS subject, CAST(count(*) AS BIGINT) AS value,
 CASE WHEN count(*) = 0 THEN 'error' ELSE 'ok' END AS status FROM fc
UNION ALL {fixed}
UNION ALL {null_rows}
UNION ALL SELECT 'duplicate_keys', 'table', CAST(count(*) - count(DISTINCT (city, timestamp)) AS BIGINT),
 CASE WHEN count(*) - count(DISTINCT (city, timestamp)) > 0 THEN 'error' ELSE 'ok' END FROM fc
UNION ALL SELECT 'horizon_rows', city, CAST(count(*) AS BIGINT), CASE WHEN count(*) < 72 THEN 'warn' ELSE 'ok' END
 FROM fc GROUP BY city
UNION ALL SELECT 'history_days', city, CAST(count(DISTINCT CASE WHEN is_future = 0 THEN CAST(timestamp AS DATE) END) AS BIGINT),
 CASE WHEN count(DISTINCT CASE WHEN is_future = 0 THEN CAST(timestamp AS DATE) END) < 2 THEN 'error'
 WHEN count(DISTINCT CASE WHEN is_future = 0 THEN CAST(timestamp AS DATE) END) < 30 THEN 'warn' ELSE 'ok' END FROM fctx GROUP BY city
UNION ALL SELECT 'forecast_days', city, CAST(count(DISTINCT CASE WHEN is_future = 1 THEN CAST(timestamp AS DATE) END) AS BIGINT),
 CASE WHEN count(DISTINCT CASE WHEN is_future = 1 THEN CAST(timestamp AS DATE) END) < 5 THEN 'warn' ELSE 'ok' END FROM fctx GROUP BY city""")


@register("quality_report", _quality_sql())
def q_quality_report(spark, sf_dir):
    from .features import build_forecast_features
    from .q_core import observations
    from ..sources import fixture as FX
    fc = build_forecast_features(observations(spark, sf_dir), FX.AS_OF, horizon=72)
    return quality_report(fc, context=forecast_context(spark, sf_dir))


# Two deterministic scorers stand in for fitted models.
STANDIN_B_SQL = "(round_even(pm10_24h * 1e6, 0) / 1e6 / 2e0 + 1e1)"


def _standin_b():
    return np_round("pm10_24h", 6) / F.lit(2.0) + F.lit(10.0)


MM_COLS = ["model_name", "train_MAE", "train_RMSE", "train_R2", "test_MAE", "test_RMSE", "test_R2"]


def _mm_sql():
    split = ("sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY timestamp, city) <= "
             "(SELECT CAST(floor(count(*) * 0.8e0) AS BIGINT) FROM train) THEN 'train' ELSE 'test' END AS split FROM train)")
    preds = (f"pr AS (SELECT 'standin_pm25' AS model_name, split, {TARGET} AS y, {O.STANDIN_SQL} AS p FROM sp "
             f"UNION ALL SELECT 'standin_pm10', split, {TARGET}, {STANDIN_B_SQL} FROM sp)")

    def side(s):
        return (f"avg(CASE WHEN split = '{s}' THEN abs(y - p) END) AS {s}_MAE, "
                f"sqrt(avg(CASE WHEN split = '{s}' THEN (y - p) * (y - p) END)) AS {s}_RMSE, "
                f"1e0 - sum(CASE WHEN split = '{s}' THEN (y - p) * (y - p) END) / "
                f"(var_pop(CASE WHEN split = '{s}' THEN y END) * count(CASE WHEN split = '{s}' THEN 1 END)) AS {s}_R2")
    mm = f"mm AS (SELECT model_name, {side('train')}, {side('test')} FROM pr GROUP BY model_name)"
    return TRAIN + [split, preds, mm]


def model_metrics_df(spark, sf_dir):
    t = time_split(training_table(spark, sf_dir))
    preds = t.select("split", F.col(TARGET).alias("y"), F.explode(F.array(
        F.struct(F.lit("standin_pm25").alias("model_name"), standin_score().alias("p")),
        F.struct(F.lit("standin_pm10").alias("model_name"), _standin_b().alias("p")))).alias("x")).select(
        "split", "y", "x.*")
    m = SU.regression_metrics(preds, "y", "p", group=["model_name", "split"], digits=None)
    return (m.groupBy("model_name").pivot("split", ["train", "test"])
            .agg(F.first("mae").alias("MAE"), F.first("rmse").alias("RMSE"), F.first("r2").alias("R2"))
            .select(*MM_COLS))


@register("model_metrics", sql(_mm_sql(), MM_COLS, "mm", set(MM_COLS[1:])))
def q_model_metrics(spark, sf_dir):
    return out(model_metrics_df(spark, sf_dir))


@register("best_model", sql(_mm_sql() + ["bm AS (SELECT * FROM mm ORDER BY test_RMSE, test_MAE, model_name LIMIT 1)"],
                            MM_COLS, "bm", set(MM_COLS[1:])))
def q_best_model(spark, sf_dir):
    return out(SU.best_model(model_metrics_df(spark, sf_dir)))


@register("importance_rank", O.with_(TRAIN + ["imp AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, {TARGET})) AS importance FROM train" for c in FEATS) + ")"],
    f"SELECT feature, {O.r6('importance')} AS importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS BIGINT) "
    "AS rank FROM imp"))
def q_importance_rank(spark, sf_dir):
    c = E.correlation(training_table(spark, sf_dir), FEATS)
    imp = c.select("feature", F.abs("correlation").alias("importance"))
    return out(SU.importance_rank(imp))


DIST_COLS = ["feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
DIST_FEATS = FEATS + [TARGET]


@register("eda_distribution", O.with_(TRAIN, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS count, {O.r6(f'avg({c})')} AS mean, "
    f"{O.r6(f'stddev_samp({c})')} AS std, {O.r6(f'min(CAST({c} AS DOUBLE))')} AS min, "
    f"{O.r6(O.quantile_sql(c, 'train', 0.25))} AS q25, {O.r6(O.quantile_sql(c, 'train', 0.5))} AS q50, "
    f"{O.r6(O.quantile_sql(c, 'train', 0.75))} AS q75, {O.r6(f'max(CAST({c} AS DOUBLE))')} AS max FROM train"
    for c in DIST_FEATS)))
def q_eda_distribution(spark, sf_dir):
    return out(E.distribution(training_table(spark, sf_dir), DIST_FEATS).select(*DIST_COLS))


@register("eda_correlation", O.with_(TRAIN, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {O.r6(f'corr({c}, {TARGET})')} AS correlation FROM train" for c in FEATS)))
def q_eda_correlation(spark, sf_dir):
    return out(E.correlation(training_table(spark, sf_dir), FEATS))


DRIFT_FEATS = FEATS


def _drift_sql():
    split = ("sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY timestamp, city) <= "
             "(SELECT CAST(floor(count(*) * 0.8e0) AS BIGINT) FROM train) THEN 'train' ELSE 'test' END AS split FROM train)")
    parts = []
    for c in DRIFT_FEATS:
        qs = ", ".join(f"{O.quantile_sql(c, 'sptrain', i / 10)} AS e{i}" for i in range(1, 10))
        b = " + ".join(f"CAST({c} > (SELECT e{i} FROM q_{c}) AS INTEGER)" for i in range(1, 10))
        parts.append(f"q_{c} AS (SELECT {qs})")
        parts.append(f"b_{c} AS (SELECT '{c}' AS feature, split, {b} AS bin FROM sp)")
    union = " UNION ALL ".join(f"SELECT * FROM b_{c}" for c in DRIFT_FEATS)
    return TRAIN + [split, "sptrain AS (SELECT * FROM sp WHERE split = 'train')"] + parts + [
        f"bins AS ({union})",
        "tot AS (SELECT feature, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS ne, "
        "sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS na FROM bins GROUP BY feature)",
        "cnt AS (SELECT feature, bin, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS ce, "
        "sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS ca FROM bins GROUP BY feature, bin)",
        "pp AS (SELECT c.feature, greatest(ce / ne, 1e-6) AS pe, greatest(ca / na, 1e-6) AS pa FROM cnt c JOIN tot t USING (feature))",
    ]


@register("eda_drift", O.with_(_drift_sql(), f"SELECT feature, {O.r6('sum((pa - pe) * ln(pa / pe))')} AS psi FROM pp GROUP BY feature"))
def q_eda_drift(spark, sf_dir):
    t = time_split(training_table(spark, sf_dir))
    return out(E.drift_psi(t, DRIFT_FEATS))


AVP_COLS = ["city", "timestamp", "actual", "predicted", "residual"]


@register("eda_actual_vs_predicted", sql(EV + [
    f"avp AS (SELECT city, timestamp, {S.REFERENCE_COLUMN} AS actual, predicted_aqi AS predicted, "
    f"{S.REFERENCE_COLUMN} - predicted_aqi AS residual FROM evd)"], AVP_COLS, "avp", {"actual", "predicted", "residual"}))
def q_eda_actual_vs_predicted(spark, sf_dir):
    s = scored_eval(spark, sf_dir)
    return out(s.select("city", "timestamp", F.col(S.REFERENCE_COLUMN).alias("actual"),
                        F.col("predicted_aqi").alias("predicted"),
                        (F.col(S.REFERENCE_COLUMN) - F.col("predicted_aqi")).alias("residual")))

