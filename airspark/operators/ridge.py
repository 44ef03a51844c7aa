"""Ridge regression from mergeable sufficient statistics.

One grouped aggregate gives the counts, sums and products of features and label per city and month.  Such rows
add up, so a daily training only aggregates the months that changed; the fit is one small solve over their
total and never reads the data again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.numeric import nan_to_null

GROUP = ("city", "month")


def _centre(column: str) -> float:
    """A fixed value near the column's: products of differences from it keep their digits."""
    low, high = S.CLIP_BOUNDS.get(column, (0.0, 0.0))
    return float(round((low + high) / 2)) if abs(low) > 100 else 0.0


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def statistics(df: DataFrame, features, label: str = S.TARGET_COLUMN, fill: dict | None = None) -> DataFrame:
    """(city, month, n, sums, products): one row per city and month of the training rows.

    ``sums`` holds each feature's and then the label's sum, ``products`` their upper triangle of products,
    both of differences from fixed centres.  Missing features take ``fill`` (else 0), rows without label
    are left out.
    """
    names = [*features, label]
    value = {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(float((fill or {}).get(c) or 0.0))) - F.lit(_centre(c))
             for c in names}
    rows = (df.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
            .select("city", F.trunc(F.to_date("timestamp"), "month").alias("month"), *[v.alias(f"v{i}") for i, v in enumerate(value.values())]))
    # As SQL text: hundreds of columns made one by one take seconds of the driver.
    sums = ", ".join(f"sum(v{i})" for i in range(len(names)))
    products = ", ".join(f"sum(v{i} * v{j})" for i, j in _pairs(len(names)))
    return rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.expr(f"array({sums})").alias("sums"),
                                    F.expr(f"array({products})").alias("products"))


def total(stats: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, product matrix) over all groups."""
    pairs = _pairs(size)
    of = lambda column, n: F.expr("array(" + ", ".join(f"sum({column}[{k}])" for k in range(n)) + ")").alias(column)
    row = stats.agg(F.sum("n").alias("n"), of("sums", size), of("products", len(pairs))).first()
    matrix = np.zeros((size, size))
    for (i, j), v in zip(pairs, row["products"]):
        matrix[i, j] = matrix[j, i] = v or 0.0
    return int(row["n"] or 0), np.array([v or 0.0 for v in row["sums"]]), matrix


@dataclass
class RidgeModel:
    features: list[str]
    intercept: float
    coefficients: np.ndarray
    deviations: np.ndarray  # of the features, over the learned rows
    array: str = "_x"

    @property
    def importances(self) -> list[float]:
        """Absolute coefficients on standardised features."""
        return np.abs(self.coefficients * self.deviations).tolist()

    def stage(self, output: str = "prediction") -> SQLTransformer:
        terms = [f"{float(b)!r}D * {self.array}[{i}]" for i, b in enumerate(self.coefficients)]
        return SQLTransformer(statement=f"SELECT *, {' + '.join([f'{float(self.intercept)!r}D', *terms])} AS {output} FROM __THIS__")


def solve(stats: DataFrame, features, label: str = S.TARGET_COLUMN, alpha: float = 1.0) -> RidgeModel:
    """Least squares on standardised features (population deviation) plus alpha times the squared weights.

    The intercept is not penalised; a constant feature gets no weight.  Without rows everything is 0.
    """
    features = list(features)
    k = len(features)
    n, sums, products = total(stats, k + 1)
    if not n:
        return RidgeModel(features, 0.0, np.zeros(k), np.zeros(k))
    mean = sums / n
    cov = products / n - np.outer(mean, mean)
    # Rounding leaves a constant feature a variance of about the last digit of its mean square.
    deviation = np.sqrt(np.where(np.diag(cov) > 1e-12 * np.diag(products) / n, np.diag(cov), 0.0))[:k]
    inverse = np.divide(1.0, deviation, out=np.zeros(k), where=deviation > 0)
    z = cov[:k, :k] * np.outer(inverse, inverse)
    weights = np.linalg.solve(z * n + alpha * np.eye(k), n * cov[:k, k] * inverse) * inverse
    centres = np.array([_centre(c) for c in [*features, label]])
    return RidgeModel(features, float(mean[k] + centres[k] - weights @ (mean[:k] + centres[:k])), weights, deviation)
