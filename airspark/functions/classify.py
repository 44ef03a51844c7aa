"""AQI category, advice and pollutant level as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import schemas as S
from .numeric import col_of


def aqi_category(c) -> Column:
    c = col_of(c)
    expr = F.when(c.isNull() | F.isnan(c), F.lit(S.UNKNOWN))
    for upper, label in S.AQI_CATEGORY_EDGES:
        expr = expr.when(c <= F.lit(float(upper)), F.lit(label))
    return expr.otherwise(F.lit(S.AQI_TOP_CATEGORY))


def aqi_advice(category, dashboard: bool = False) -> Column:
    category = col_of(category)
    expr = None
    for label, text in S.AQI_ADVICE.items():
        if dashboard and label == "Good":
            text = S.AQI_ADVICE_DASHBOARD_GOOD
        expr = (F.when(category == label, F.lit(text)) if expr is None
                else expr.when(category == label, F.lit(text)))
    return expr.otherwise(F.lit(S.AQI_ADVICE_FALLBACK))


def pollutant_level_for(column_name: str, value) -> Column:
    """Level of ``value`` for a known pollutant column (static column name)."""
    v = col_of(value)
    edges = S.POLLUTANT_BREAKPOINTS.get(column_name)
    if edges is None:
        return F.when(v.isNull() | F.isnan(v), F.lit(S.UNKNOWN)).otherwise(F.lit(S.MEASURED))
    expr = F.when(v.isNull() | F.isnan(v), F.lit(S.UNKNOWN))
    for upper, (_, label) in zip(edges, S.AQI_CATEGORY_EDGES):
        expr = expr.when(v <= F.lit(float(upper)), F.lit(label))
    return expr.otherwise(F.lit(S.AQI_TOP_CATEGORY))


def pollutant_level(column_name_col, value) -> Column:
    """Level where the pollutant column name is data (e.g. after unpivot)."""
    name = col_of(column_name_col)
    v = col_of(value)
    expr = F.when(v.isNull() | F.isnan(v), F.lit(S.UNKNOWN))
    for col_name in S.POLLUTANT_BREAKPOINTS:
        expr = expr.when(name == col_name, pollutant_level_for(col_name, v))
    return expr.otherwise(F.lit(S.MEASURED))


def alert_level(peak) -> Column:
    p = col_of(peak)
    return (F.when(p > F.lit(150.0), F.lit("error"))
            .when(p > F.lit(100.0), F.lit("warning"))
            .otherwise(F.lit("ok")))
