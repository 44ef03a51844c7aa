"""The evaluation job: a registered model scores the stored forecast, errors against the provider's index follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..operators.forecast import predict_eval, prepare_scoring
from ..operators.summarize import daily_summary_eval, regression_metrics
from ..session import checkpoint
from ..sources.store import write_csv
from .ml import without_inner

METRICS = ["city", "level", "rows", "mae", "mse", "rmse", "r2"]


@dataclass
class Evaluation:
    """What the job computed, and where its CSV files lie."""

    hourly: DataFrame
    daily: DataFrame
    metrics: DataFrame
    paths: dict[str, str]


def metrics_of(hourly: DataFrame, daily: DataFrame, reference: str = S.REFERENCE_COLUMN) -> DataFrame:
    """Hourly and daily metrics per city; a city without any reference value has no row."""
    by_hour = regression_metrics(hourly, reference, "predicted_aqi", group=["city"], level="hourly")
    by_day = regression_metrics(daily, "openmeteo_daily_avg_aqi", "predicted_daily_avg_aqi", group=["city"], level="daily")
    return by_hour.select(*METRICS).unionByName(by_day.select(*METRICS))


def evaluate(registered, store: DataFrame, path: str, horizon: int = S.DEFAULT_HORIZON_HOURS, timezone: str = "UTC") -> Evaluation:
    """Score the newest run with the model of a registry row and write three CSV tables under ``path``.

    forecast store -> horizon rows -> predictions with errors -> daily means with errors -> metrics.  The scored rows,
    at most ``horizon`` a city, are written once; everything else reads them.  Without future rows it raises.
    """
    rows = prepare_scoring(store, list(registered["feature_columns"]), horizon=horizon, timezone=timezone)
    if S.REFERENCE_COLUMN not in rows.columns:
        raise ValueError(f"The forecast table has no {S.REFERENCE_COLUMN} to evaluate against.")
    scored = without_inner(PipelineModel.load(registered["model_path"]).transform(rows))
    hourly = checkpoint(predict_eval(scored, F.col("prediction")).drop("prediction"), "evaluation-hours")
    daily = checkpoint(daily_summary_eval(hourly), "evaluation-days")
    metrics = checkpoint(metrics_of(hourly, daily), "evaluation-metrics")
    tables = {"hourly": hourly, "daily": daily, "metrics": metrics}
    paths = {name: write_csv(df, name, f"{path.rstrip('/')}/{name}") for name, df in tables.items()}
    return Evaluation(hourly, daily, metrics, paths)
