"""Time-ordered train/test split without a global sort or a full shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .. import schemas as S


#: So many distinct keys of the boundary hour are looked through at once; more are narrowed by their beginnings.
KEYS_AT_ONCE = 100_000


def _key_of_rank(rows: DataFrame, key: str, rank: int, at_once: int) -> tuple[str, int, int]:
    """(key, rows of smaller keys, rows of this key) of the row with 1-based ``rank`` in key order.

    Selection by a prefix histogram: counts of the keys by their first letters, one letter more a turn, until
    few keys are left.  Every turn is a grouped count with map-side combining; no group holds the rows.
    """
    prefix, below = "", 0
    while True:
        inside = rows.where(F.col(key).startswith(prefix)) if prefix else rows
        found = inside.groupBy(key).agg(F.count(F.lit(1)).alias("n")).limit(at_once + 1).collect()
        if len(found) > at_once:
            size = len(prefix) + 1
            found = [(r["p"], r["n"]) for r in inside.groupBy(F.substring(key, 1, size).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
            last = False
        else:
            found, last = [(r[key], r["n"]) for r in found], True
        for value, n in sorted(found):  # code points sort as UTF-8 bytes do
            if rank <= below + n:
                if last or value == prefix:  # nothing but the prefix itself
                    return value, below, n
                prefix = value
                break
            below += n
        else:
            raise ValueError("Rank beyond the rows.")


def time_split(df: DataFrame, fraction: float = S.TRAIN_FRACTION, ts: str = "timestamp",
               tie: str = "city", at_once: int = KEYS_AT_ONCE) -> DataFrame:
    """Adds ``split`` = 'train' for the first int(n*fraction) rows in (ts, tie) order.

    Only one timestamp can straddle the cut.  Per-timestamp counts (a table
    bounded by the number of distinct hours) and their running sum locate
    that boundary hour and how many of its rows are train; the last of these
    rows' ``tie`` value is selected by counts.  Every row is then classified by
    comparing (ts, tie) with that key: a projection, so the input is read once
    for the counts and once for the result, and no group is ranked.  Rows that
    share just this key (dedupe first) are told apart by their rank.
    """
    key = F.coalesce(F.col(tie).cast("string"), F.lit(""))
    counts = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_n"))
    # One job over the per-hour table (distinct hours only): running and
    # total counts, the cut, and the first hour whose running count reaches it.
    upto = W.orderBy(ts).rowsBetween(W.unboundedPreceding, 0)
    whole = W.orderBy(ts).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cut_col = F.floor(F.col("_total") * F.lit(float(fraction))).cast("bigint")
    boundary = (counts.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(whole)})
                .filter(F.col("_upto") >= cut_col)
                .agg(F.min_by(F.struct(F.col(ts).alias("b"), (cut_col - (F.col("_upto") - F.col("_n"))).alias("k"),
                                       F.col("_n").alias("n"), cut_col.alias("cut"), F.col("_total").alias("total")), F.col(ts)).alias("x"))
                .first()["x"])
    if boundary is None or boundary["cut"] <= 0 or boundary["cut"] >= boundary["total"]:
        raise ValueError("Invalid train/test split. Need more training rows.")
    # Back as a naive Python datetime; rebuild the literal from text so the
    # session time zone cannot shift it (F.lit(datetime) would be TIMESTAMP).
    b_ts = F.lit(boundary["b"].isoformat(sep=" ")).cast(df.schema[ts].dataType)
    k, train, test = boundary["k"], F.lit("train"), F.lit("test")
    if k == boundary["n"]:  # the hour is train as a whole
        return df.withColumn("split", F.when(F.col(ts) <= b_ts, train).otherwise(test))
    hour = df.filter(F.col(ts) == b_ts).select(key.alias("_key"))
    last, below, equal = _key_of_rank(hour, "_key", k, at_once)
    before = (F.col(ts) < b_ts) | ((F.col(ts) == b_ts) & (key < F.lit(last)))
    here = (F.col(ts) == b_ts) & (key == F.lit(last))
    if k == below + equal:
        return df.withColumn("split", F.when(before | here, train).otherwise(test))
    rank = F.row_number().over(W.partitionBy(ts, tie).orderBy(*[c for c in df.columns if c not in (ts, tie)]))
    torn = (df.filter(here).withColumn("_r", rank).withColumn("split", F.when(F.col("_r") <= k - below, train).otherwise(test)).drop("_r"))
    return df.filter(~here).withColumn("split", F.when(before, train).otherwise(test)).unionByName(torn)


def check_split(df_with_split: DataFrame) -> None:
    counts = {r["split"]: r["n"] for r in df_with_split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get("train") or not counts.get("test"):
        raise ValueError("Invalid train/test split. Need more training rows.")
