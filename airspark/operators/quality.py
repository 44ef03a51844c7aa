"""Data-quality report for forecast/training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .. import schemas as S
from ..session import checkpoint

REPORT_SCHEMA = "check string, subject string, value bigint, status string"


def _status(bad, warn=None):
    e = F.when(bad, F.lit("error"))
    return (e.when(warn, F.lit("warn")) if warn is not None else e).otherwise(F.lit("ok"))


def _check(name: str, subject, value, status):
    return F.struct(F.lit(name).alias("check"), subject.alias("subject"), value.cast("bigint").alias("value"), status.alias("status"))


def quality_report(table: DataFrame, context: DataFrame | None = None, features=None,
                   horizon: int = S.DEFAULT_HORIZON_HOURS, expected_columns=None, strict: bool = False) -> DataFrame:
    """One row per check: (check, subject, value, status in ok/warn/error).

    Schema checks run on the driver (they read metadata only).  The table is
    read once: counts per key are rolled up to cities and to the whole; the
    context is read once: days per city.  Both results have a row per city,
    are written once, and every check is derived from them.
    ``strict=True`` raises on any error row.
    """
    features = list(features or S.MODEL_FEATURE_COLUMNS)
    expected = list(expected_columns or S.FORECAST_OUTPUT_COLUMNS)
    missing = [c for c in expected if c not in table.columns]
    blocked = [c for c in S.BLOCKED_FEATURES if c in table.columns]
    leaked = int(S.TARGET_COLUMN in features or S.REFERENCE_COLUMN in features)
    present = [c for c in features if c in table.columns]

    nulls = {c: f"_null_{i}" for i, c in enumerate(present)}
    keys = table.groupBy("city", "timestamp").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(a) for c, a in nulls.items()])
    sums = checkpoint(keys.rollup("city").agg(
        F.grouping("city").alias("_all"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_again"),
        *[F.coalesce(F.sum(a), F.lit(0)).alias(a) for a in nulls.values()]), "quality-table")

    word, n = F.lit("table"), F.col("_n")
    fixed = [("missing_columns", len(missing), len(missing) > 0), ("feature_count", len(features), len(features) != 19),
             ("blocked_month_columns", len(blocked), len(blocked) > 0), ("target_in_features", leaked, leaked > 0)]
    checks = [_check("row_count", word, n, _status(n == 0))]
    checks += [_check(name, word, F.lit(v), F.lit("error" if bad else "ok")) for name, v, bad in fixed]
    checks += [_check("feature_nulls", F.lit(c), F.col(a), _status(F.col(a) > 0)) for c, a in nulls.items()]
    checks += [_check("duplicate_keys", word, F.col("_again"), _status(F.col("_again") > 0))]
    # A grand total without rows is no row at all.
    total = (sums.filter(F.col("_all") == 1).drop("city", "_all").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", "_again", *nulls.values())]))
    out = total.select(F.inline(F.array(*checks)))

    cities = sums.filter(F.col("_all") == 0).select("city", "_n")
    if context is not None:
        days = (context.groupBy("city", F.to_date("timestamp").alias("_day"))
                .agg(F.max((F.col("is_future") == 0).cast("int")).alias("_past"), F.max((F.col("is_future") == 1).cast("int")).alias("_fut"))
                .groupBy("city").agg(F.coalesce(F.sum("_past"), F.lit(0)).alias("_past"), F.coalesce(F.sum("_fut"), F.lit(0)).alias("_fut")))
        days = checkpoint(days, "quality-context")
        # A city without a single future row is an error, not an absent line.
        cities = days.join(cities, "city", "full").withColumn("_n", F.coalesce("_n", F.lit(0)))
    per_city = [_check("horizon_rows", F.col("city"), n, _status(n == 0, n < horizon))]
    out = out.unionByName(cities.select(F.inline(F.array(*per_city))))
    if context is not None:
        out = out.unionByName(days.select(F.inline(F.array(
            _check("history_days", F.col("city"), F.col("_past"), _status(F.col("_past") < 2, F.col("_past") < 30)),
            _check("forecast_days", F.col("city"), F.col("_fut"), _status(F.lit(False), F.col("_fut") < 5))))))
    if strict:
        errors = out.filter(F.col("status") == "error")
        shown = errors.limit(20).collect()  # one line per failing city: show some, count all
        if shown:
            raise ValueError(f"Quality check failed, {errors.count()} errors, of them {[tuple(r) for r in shown]}")
    return out


def written_rows(df: DataFrame, name: str, message: str) -> DataFrame:
    """``df`` written once; raises ``message`` if it has no rows, which the write itself counts."""
    seen = Observation("rows")
    done = checkpoint(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    if not seen.get["rows"]:
        raise ValueError(message)
    return done
