"""Exploratory summaries over the training table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.numeric import nan_to_null
from ..operators.median import exact_quantiles

DECILES = tuple(i / 10 for i in range(1, 10))


def distribution(df: DataFrame, cols) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column (long format)."""
    cols = list(cols)
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    stats = df.agg(*[F.struct(F.count(c).cast("bigint").alias("count"), F.avg(c).alias("mean"),
                              F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
                              F.lit(q[c][0.25]).cast("double").alias("q25"),
                              F.lit(q[c][0.5]).cast("double").alias("q50"),
                              F.lit(q[c][0.75]).cast("double").alias("q75"),
                              F.max(F.col(c).cast("double")).alias("max")).alias(c) for c in cols])
    long = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s"))
                                            for c in cols])).alias("x"))
    return long.select("x.feature", "x.s.*")


def correlation(df: DataFrame, cols, target: str = S.TARGET_COLUMN) -> DataFrame:
    """Pearson r of each column with the target (one aggregate)."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in cols])
    return one.unpivot([], list(cols), "feature", "correlation")


def drift_psi(df_with_split: DataFrame, cols, expected: str = "train", actual: str = "test",
              eps: float = 1e-6) -> DataFrame:
    """Population stability index per column: 10 bins from exact deciles of the expected side.

    The bins are counted by conditional sums of one aggregate, a count a decile and side; missing values are
    in no bin.
    """
    cols = list(cols)
    q = exact_quantiles(df_with_split.filter(F.col("split") == expected), cols, DECILES)
    sides = {"e": F.col("split") == expected, "a": F.col("split") == actual}
    aggs = []
    for i, c in enumerate(cols):
        v = nan_to_null(F.col(c).cast("double"))
        for s, own in sides.items():
            aggs.append(F.count(F.when(own, v)).alias(f"{s}{i}_n"))
            aggs += [F.count(F.when(own & (v <= F.lit(q[c][p])), 1)).alias(f"{s}{i}_{j}") for j, p in enumerate(DECILES)]
    one = df_with_split.agg(*aggs)

    def psi(i: int):
        share = {}
        for s in sides:
            up_to = [F.lit(0), *[F.col(f"{s}{i}_{j}") for j in range(len(DECILES))], F.col(f"{s}{i}_n")]
            share[s] = [F.greatest((b - a) / F.col(f"{s}{i}_n"), F.lit(eps)) for a, b in zip(up_to, up_to[1:])]
        return sum((a - e) * F.log(a / e) for e, a in zip(share["e"], share["a"]))

    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), psi(i).alias("psi")) for i, c in enumerate(cols)])))
