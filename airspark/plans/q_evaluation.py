"""The evaluation job with a fitted model, from registration to the CSV files, against SQL."""

from __future__ import annotations

from .. import schemas as S
from ..functions.numeric import np_round
from ..session import scratch_path
from ..sources import fixture as FX
from ..sources.store import read_csv, registry_latest
from . import ml as M
from . import oracle as O
from .catalog import register
from .evaluation import METRICS, evaluate
from .q_ml import _split, _table, recursive, ridge_ctes, ridge_prediction
from .q_scoring import REF, _daily_eval_sql, _metrics_sql, stored_forecast

HOURS = ["city", "timestamp", "forecast_hour", "forecast_day", "predicted_aqi", REF, "absolute_error", "squared_error"]


def _ctes():
    """Training, the ridge fitted on all of it, and the forecast rows with its predictions."""
    scored = O.eval_ctes("raw_prediction", "pred")
    at = next(i for i, c in enumerate(scored) if c.startswith("ev0 "))
    fitted = [*ridge_ctes("train"), f"pred AS (SELECT prep.*, {ridge_prediction()} AS raw_prediction FROM prep, mo, fit)"]
    return list(dict.fromkeys([*O.training_ctes(), *scored[:at], *fitted, *scored[at:]]))


def _evaluation(spark, sf_dir):
    table = _table(spark, sf_dir)
    model = M.estimators(table, only=(M.RIDGE,))[M.RIDGE].fit(table)
    registry = M.register_model(model, table, scratch_path(spark, "registry"), "evaluated", M.RIDGE, S.MODEL_FEATURE_COLUMNS)
    return evaluate(registry_latest(registry, "evaluated").first(), stored_forecast(spark, sf_dir, newest_days=0),
                    scratch_path(spark, "evaluation"), horizon=72, timezone=FX.CITY_TIMEZONE)


COMPARED = ["model_name", *(f"{side}_{m}" for side in ("train", "test") for m in ("MAE", "RMSE", "R2"))]


def _compared_sql():
    y = S.TARGET_COLUMN
    split = ("sp AS (SELECT *, row_number() OVER (ORDER BY timestamp, city) <= "
             "(SELECT CAST(floor(count(*) * 0.8e0) AS BIGINT) FROM train) AS learned FROM train)")
    errors = f"er AS (SELECT learned, {y} AS y, {y} - ({ridge_prediction()}) AS e FROM sp, mo, fit)"
    side = {"train": "learned", "test": "NOT learned"}
    parts = ", ".join(
        f"{O.r_digits(expr.format(w=where), 4)} AS {name}_{metric}" for name, where in side.items() for metric, expr in (
            ("MAE", "avg(abs(e)) FILTER ({w})"), ("RMSE", "sqrt(avg(e * e) FILTER ({w}))"),
            ("R2", "1e0 - (sum(e * e) FILTER ({w})) / ((var_pop(y) FILTER ({w})) * (count(*) FILTER ({w})))")))
    return recursive([*O.training_ctes(), split, *ridge_ctes("sp", "learned"), errors],
                     f"SELECT '{M.RIDGE}' AS model_name, {parts} FROM er")


@register("ml_compare_ridge", _compared_sql())
def q_ml_compare_ridge(spark, sf_dir):
    """The comparison with ridge as its only candidate: metrics of both sides."""
    train, test = _split(spark, sf_dir)
    metrics, _, _ = M.compare(train, test, M.estimators(train, only=(M.RIDGE,)))
    return metrics.select("model_name", *[np_round(c, 4).alias(c) for c in COMPARED[1:]])


@register("ml_importance_ridge", recursive([*O.training_ctes(), *ridge_ctes("train")], " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {O.r_digits(f'abs(m[{i + 1}][{len(S.MODEL_FEATURE_COLUMNS) + 1}])', 4)} AS importance, '{M.RIDGE}' AS model_name "
    "FROM fit" for i, c in enumerate(S.MODEL_FEATURE_COLUMNS))))
def q_ml_importance_ridge(spark, sf_dir):
    """Importances of a ridge registered on the whole table: absolute weights of standardised features."""
    table = _table(spark, sf_dir)
    model = M.estimators(table, only=(M.RIDGE,))[M.RIDGE].fit(table)
    registry = M.register_model(model, table, scratch_path(spark, "registry"), "ranked", M.RIDGE, S.MODEL_FEATURE_COLUMNS)
    return M.feature_importance(registry_latest(registry, "ranked")).withColumn("importance", np_round("importance", 4))


@register("evaluation_job", recursive(_daily_eval_sql(_ctes()), _metrics_sql("evd", REF, "predicted_aqi", "hourly") + " UNION ALL "
                                      + _metrics_sql("deval", "openmeteo_daily_avg_aqi", "predicted_daily_avg_aqi", "daily")))
def q_evaluation_job(spark, sf_dir):
    """The metrics, read back from their CSV file."""
    done = _evaluation(spark, sf_dir)
    return read_csv(spark, done.paths["metrics"], done.metrics.schema).select(*METRICS)


@register("evaluation_hours", recursive(_ctes(), "SELECT city, timestamp, forecast_hour, forecast_day, predicted_aqi, "
                                        f"{O.r6(REF)} AS {REF}, absolute_error, squared_error FROM evd"))
def q_evaluation_hours(spark, sf_dir):
    """The hourly predictions with their errors, read back from their CSV file."""
    from ..operators.clean import round_doubles
    done = _evaluation(spark, sf_dir)
    return round_doubles(read_csv(spark, done.paths["hourly"], done.hourly.schema).select(*HOURS))
