"""Per-city ordered series: exact positions, gap fill and rolling means.

Skew-safe layout.  A city can hold a large share of all rows, so no window
is ever partitioned by city alone:

1. ``add_positions`` gives each row its exact 1-based position in its city's
   time order from per-(city, month) counts (a table bounded by the time
   span, not by row volume) and a ``row_number`` inside (city, month).
2. Rows are cut into position buckets of ``bucket_rows`` rows.  The last
   ``halo`` rows of each bucket are copied into the next bucket as context,
   so every ROWS window of length <= halo+1 is exact inside one bucket.
   The positioned rows are written once to the shared checkpoint folder,
   since two branches read them.
3. Forward fill inside a bucket is a running ``last(..., ignorenulls)``;
   what comes before the bucket is a per-bucket summary carried with a
   window over the small summary table and joined back.  Back fill of
   leading nulls uses the city's first non-null value from that summary.

Each window task therefore holds at most ``bucket_rows + halo`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.numeric import clip, nan_to_null
from ..session import checkpoint

DEFAULT_BUCKET_ROWS = 8192


def add_positions(df: DataFrame, key: str = "city", ts: str = "timestamp",
                  pos_col: str = "_pos") -> DataFrame:
    """Exact 1-based position of each row within its key, ordered by ``ts``.

    Requires unique (key, ts) (dedupe first).
    """
    grain = F.trunc(F.to_date(F.col(ts)), "month")
    counts = df.groupBy(key, grain.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(key).orderBy("_g").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(key, "_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = W.partitionBy(key, "_g").orderBy(ts)
    return (df.withColumn("_g", grain).join(offsets, [key, "_g"])
            .withColumn(pos_col, F.col("_off") + F.row_number().over(within))
            .drop("_g", "_off"))


def series_features(df: DataFrame, fill_cols=(), clip_bounds=None, rolls=(),
                    key: str = "city", ts: str = "timestamp",
                    bucket_rows: int = DEFAULT_BUCKET_ROWS, keep_pos: bool = False,
                    materialize: bool = True, prior: DataFrame | None = None) -> DataFrame:
    """Per-key forward+backward fill, clip, then trailing row-count means.

    ``rolls``: (output, source, n) -> mean of the current and n-1 preceding
    rows of ``source`` (after fill and clip), NULLs ignored, min 1 value.
    ``clip_bounds``: {column: (lo, hi)} applied to present columns after fill.
    ``prior``: optional (key, fill columns...) table of the last non-NULL
    values *before* ``df`` starts (when ``df`` is a suffix of a longer
    series); forward fill continues from them.
    """
    fill_cols = [c for c in fill_cols]
    rolls = list(rolls)
    halo = max([n - 1 for _, _, n in rolls], default=0)
    if bucket_rows <= halo:
        raise ValueError("bucket_rows must exceed the longest window")
    B = int(bucket_rows)

    missing_aware = {c: nan_to_null(c) for c in dict.fromkeys([*fill_cols, *(src for _, src, _ in rolls)])
                     if df.schema[c].dataType.typeName() in ("double", "float")}
    df = df.withColumns(missing_aware)  # NaN is missing: it is filled and never averaged
    base = df if "_pos" in df.columns else add_positions(df, key, ts)
    if materialize and fill_cols:
        # Two branches (bucket summaries and the windows) read the positioned
        # rows: write them once to the shared checkpoint folder instead of
        # recomputing the dedupe and position shuffles in each branch.
        base = checkpoint(base)
    base = base.withColumns({
        "_b": F.floor((F.col("_pos") - 1) / F.lit(B)).cast("bigint"),
        "_tail": ((F.col("_pos") - 1) % F.lit(B)) >= F.lit(B - halo) if halo > 0 else F.lit(False),
    })

    out = base
    if halo > 0:
        out = out.withColumn(
            "_q", F.explode(F.when(F.col("_tail"), F.array(F.col("_b"), F.col("_b") + 1))
                            .otherwise(F.array(F.col("_b")))))
    else:
        out = out.withColumn("_q", F.col("_b"))

    if fill_cols:
        # Per (key, bucket, head/tail part) first and last non-null value.
        pos_if = {c: F.when(F.col(c).isNotNull(), F.col("_pos")) for c in fill_cols}
        summ = base.groupBy(key, "_b", F.col("_tail").cast("int").alias("_part")).agg(
            *[F.max_by(c, pos_if[c]).alias(f"_last_{c}") for c in fill_cols],
            *[F.min_by(c, pos_if[c]).alias(f"_first_{c}") for c in fill_cols])
        upto = W.partitionBy(key).orderBy("_b", "_part").rowsBetween(W.unboundedPreceding, 0)
        whole = W.partitionBy(key).orderBy("_b", "_part").rowsBetween(W.unboundedPreceding,
                                                                      W.unboundedFollowing)
        summ = summ.select(
            key, "_b", "_part",
            *[F.last(f"_last_{c}", True).over(upto).alias(f"_carry_{c}") for c in fill_cols],
            *[F.first(f"_first_{c}", True).over(whole).alias(f"_lead_{c}") for c in fill_cols])
        # Partition q starts right after the head part of bucket q-1.
        carry = (summ.filter(F.col("_part") == 0)
                 .withColumn("_q", F.explode(F.when(F.col("_b") == 0, F.array(F.lit(0).cast("bigint"),
                                                                              F.lit(1).cast("bigint")))
                                             .otherwise(F.array(F.col("_b") + 1))))
                 .select(key, "_q",
                         *[F.when(F.col("_q") > 0, F.col(f"_carry_{c}")).alias(f"_carry_{c}")
                           for c in fill_cols],
                         *[F.col(f"_lead_{c}") for c in fill_cols]))
        if prior is not None:
            p = prior.select(key, *[F.col(c).alias(f"_prior_{c}") for c in fill_cols])
            carry = carry.join(p, key, "left").select(
                key, "_q", *[F.coalesce(f"_carry_{c}", f"_prior_{c}").alias(f"_carry_{c}") for c in fill_cols],
                *[F.col(f"_lead_{c}") for c in fill_cols])
        # Fill inside the bucket first, then attach the (small) carry table:
        # joining after the window keeps the carried columns out of the big
        # shuffle, and the join preserves the (key, _q) partitioning that the
        # rolling windows below reuse.
        running = W.partitionBy(key, "_q").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
        out = out.withColumns({c: F.last(c, True).over(running) for c in fill_cols})
        out = out.join(carry, [key, "_q"], "left")
        out = out.withColumns({
            c: F.coalesce(F.col(c), F.col(f"_carry_{c}"), F.col(f"_lead_{c}")) for c in fill_cols})
        out = out.drop(*[f"_carry_{c}" for c in fill_cols], *[f"_lead_{c}" for c in fill_cols])

    if clip_bounds:
        out = out.withColumns({c: clip(c, *clip_bounds[c]) for c in clip_bounds if c in out.columns})

    if rolls:
        out = out.withColumns({
            name: F.avg(src).over(W.partitionBy(key, "_q").orderBy("_pos").rowsBetween(-(n - 1), 0))
            for name, src, n in rolls})

    out = out.filter(F.col("_q") == F.col("_b")).drop("_q", "_b", "_tail")
    return out if keep_pos else out.drop("_pos")


def fill_gaps(df: DataFrame, cols, key="city", ts="timestamp", bucket_rows=DEFAULT_BUCKET_ROWS):
    return series_features(df, fill_cols=cols, key=key, ts=ts, bucket_rows=bucket_rows)


def rolling_means(df: DataFrame, rolls, key="city", ts="timestamp", bucket_rows=DEFAULT_BUCKET_ROWS):
    return series_features(df, rolls=rolls, key=key, ts=ts, bucket_rows=bucket_rows)
