"""Feature tables kept up to date by an index of bucket summaries.

Observations are stored by city and time bucket.  The index has one small row per city and bucket: its row count
and, per column, the first and the last value with their times.  With it a run that brings new, late or corrected
rows knows, without reading history,

* the last values before any bucket (forward fill goes on from them),
* how many buckets back the 23 rows lie that the 24-row windows read,
* whether a city's first value changed (back fill of its leading gaps hangs on it),

and recomputes only the buckets from a city's first changed one on.  The index is written last: a run that dies
before is repeated whole, and repeating a run changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from .. import schemas as S
from ..operators.clean import coerce_numeric
from ..session import checkpoint
from ..sources.store import keyed_upsert, read_keyed, stored_schema, table_exists
from .features import ROLLS, build_forecast_features, derive_series, finish_training, forecast_context_rows

BUCKET = "obs_bucket"
HALO = max(n for _, _, n in ROLLS) - 1
VALUES = S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN]


@dataclass
class FeatureStore:
    """Paths of one store.  ``grain`` is the bucket's length, a unit that ``trunc`` knows."""

    spark: SparkSession
    path: str
    grain: str = "month"

    def bucket(self):
        return F.trunc(F.to_date("timestamp"), self.grain)

    def table(self, name: str) -> DataFrame | None:
        path = f"{self.path}/{name}"
        if not table_exists(self.spark, path):
            return None
        declared = T.StructType([T.StructField("city", T.StringType()), T.StructField(BUCKET, T.DateType())])
        return read_keyed(self.spark, path, stored_schema(self.spark, path, declared))

    # -- index ------------------------------------------------------------

    def _summaries(self, rows: DataFrame) -> DataFrame:
        def end(pick, c, name):
            at = F.when(F.col(c).isNotNull(), F.col("timestamp"))
            return pick(F.struct(F.col("timestamp").alias("t"), F.col(c).alias("v")), at).alias(f"{name}_{c}")

        return rows.groupBy("city", BUCKET).agg(
            F.count(F.lit(1)).alias("n"), *[end(F.min_by, c, "first") for c in VALUES], *[end(F.max_by, c, "last") for c in VALUES])

    @staticmethod
    def _leads(index: DataFrame) -> DataFrame:
        """Each city's first value per column, and its first bucket."""
        return index.groupBy("city").agg(F.min(BUCKET).alias("_first"), F.struct(*[
            F.min_by(f"first_{c}", F.col(f"first_{c}")["t"]).alias(c) for c in VALUES]).alias("_lead"))

    @staticmethod
    def _context_start(index: DataFrame, bounds: DataFrame, upto: str) -> DataFrame:
        """``bounds`` with _from: the bucket from which on HALO rows stand before the bucket in ``upto``."""
        older = index.select("city", BUCKET, "n").join(bounds, "city").where(F.col(BUCKET) < F.col(upto))
        later = W.partitionBy("city").orderBy(F.desc(BUCKET)).rowsBetween(W.unboundedPreceding, -1)
        needed = older.withColumn("_later", F.coalesce(F.sum("n").over(later), F.lit(0))).where(F.col("_later") < HALO)
        start = needed.groupBy("city").agg(F.min(BUCKET).alias("_from"))
        return bounds.join(start, "city", "left").withColumn("_from", F.coalesce("_from", upto))

    @staticmethod
    def _prior(index: DataFrame, bounds: DataFrame) -> DataFrame:
        """Last values before _from, per city."""
        older = index.join(bounds.select("city", "_from"), "city").where(F.col(BUCKET) < F.col("_from"))
        return older.groupBy("city").agg(*[F.max_by(F.col(f"last_{c}")["v"], F.col(f"last_{c}")["t"]).alias(c) for c in VALUES])

    def _rows_from(self, bounds: DataFrame) -> DataFrame:
        """Observations of the cities from _from on; the earliest of all is a literal in the scan's partition filter."""
        least = bounds.agg(F.min("_from")).first()[0]
        return self.table("observations").where(F.col(BUCKET) >= F.lit(least)).join(bounds, "city").where(F.col(BUCKET) >= F.col("_from"))

    def add_observations(self, batch: DataFrame) -> DataFrame | None:
        """Upsert the batch; the rebuilt index as it will be (not yet written), or None for an empty batch."""
        batch = checkpoint(coerce_numeric(batch, VALUES).withColumn(BUCKET, self.bucket()), "batch")
        touched = checkpoint(batch.select("city", BUCKET).distinct(), "touched")
        if touched.isEmpty():
            return None
        obs = keyed_upsert(batch, f"{self.path}/observations", partition_by=("city", BUCKET))
        lo, hi = touched.agg(F.min(BUCKET), F.max(BUCKET)).first()
        rows = obs.where(F.col(BUCKET).between(F.lit(lo), F.lit(hi))).join(touched, ["city", BUCKET], "left_semi")
        return checkpoint(self._summaries(rows), "index-entries")

    def observe(self, batch: DataFrame) -> None:
        """Take in a batch without recomputing the training windows (scoring needs the index only)."""
        entries = self.add_observations(batch)
        if entries is not None:
            self._write_index(entries)

    # -- training ---------------------------------------------------------

    def update(self, batch: DataFrame) -> DataFrame | None:
        """Take in a batch of observations and recompute what it changes.

        Returns (city, _since): from which bucket on each city was recomputed; None if the batch is empty.
        """
        entries = self.add_observations(batch)
        if entries is None:
            return None
        old = self.table("index")
        index = entries
        since = entries.groupBy("city").agg(F.min(BUCKET).alias("_since"))
        if old is not None:
            old = old.drop("built_at")
            index = checkpoint(old.join(entries.select("city", BUCKET), ["city", BUCKET], "left_anti").unionByName(entries), "index")
            before = self._leads(old).select("city", F.col("_lead").alias("_was"))
            since = (since.join(self._leads(index), "city").join(before, "city", "left")
                     .withColumn("_since", F.when(F.col("_was").isNotNull() & ~F.col("_was").eqNullSafe(F.col("_lead")), F.col("_first"))
                                 .otherwise(F.col("_since"))).select("city", "_since"))
        bounds = checkpoint(self._context_start(index, since, "_since"), "bounds")
        out = derive_series(self._rows_from(bounds), VALUES, prior=self._prior(index, bounds))
        out = out.where(F.col(BUCKET) >= F.col("_since")).select(*S.TRAINING_OUTPUT_COLUMNS, BUCKET)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("city", BUCKET)
         .parquet(f"{self.path}/derived"))
        self._write_index(entries)
        return bounds.select("city", "_since")

    def _write_index(self, entries: DataFrame) -> None:
        keyed_upsert(entries.withColumn("built_at", F.localtimestamp()), f"{self.path}/index", key=("city", BUCKET),
                     order=("built_at",), partition_by=(BUCKET,))

    def training_features(self) -> DataFrame:
        """The training table: whole-frame medians and the last clean-up over the stored windows."""
        return finish_training(self.table("derived").select(*S.TRAINING_OUTPUT_COLUMNS))

    # -- forecast ---------------------------------------------------------

    def forecast_features(self, cities: DataFrame, as_of, horizon: int = S.DEFAULT_HORIZON_HOURS) -> DataFrame:
        """Forecast rows of some cities from the buckets that their windows reach; history is not scanned."""
        index = self.table("index").drop("built_at")
        now = cities.select("city").distinct().withColumn("_until", F.trunc(F.lit(as_of).cast("date"), self.grain))
        bounds = checkpoint(self._context_start(index, now, "_until"), "bounds")
        older = self._prior(index, bounds)
        rows = self._rows_from(bounds).drop("_until", "_from", BUCKET)
        recent, prior = forecast_context_rows(rows, as_of, VALUES)
        # What the recent buckets do not hold comes from the index.
        both = older.select("city", *[F.col(c).alias(f"_older_{c}") for c in VALUES]).join(prior, "city", "full")
        prior = both.select("city", *[F.coalesce(c, f"_older_{c}").alias(c) for c in VALUES])
        return build_forecast_features(recent, as_of, horizon=horizon, prior=prior, validate=False)
