"""Source tables bucketed by their key, so that joining and deduplicating them moves no row.

Both sides are written with as many buckets of (city, timestamp), each sorted; a join or a grouping on that key then
reads bucket against bucket.  The exchange is paid once, when a batch lands, instead of at every build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

KEY = ("city", "timestamp")
#: A bucket should hold about this many rows of the table's expected size.
ROWS_A_BUCKET = 5_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """A power of two, so that a table that has outgrown its buckets can be rewritten by splitting each in two."""
    n = least
    while n * ROWS_A_BUCKET < rows:
        n *= 2
    return n


def write_bucketed(df: DataFrame, table: str, buckets: int, key=KEY, mode: str = "overwrite", path: str | None = None) -> str:
    """Write (or append a batch to) a bucketed table in the session's catalog; returns its name.

    Its files lie under ``path``, else in a scratch folder.  Rows are dealt to the buckets before the write, so a batch
    makes one file a bucket.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, *[F.col(c) for c in key]).write.mode(mode).format("parquet").bucketBy(buckets, *key).sortBy(*key)
    if not (mode == "append" and spark.catalog.tableExists(table)):  # a table that is there knows its place
        writer = writer.option("path", path or scratch_path(spark, table))
    writer.saveAsTable(table)
    return table


def join_bucketed(spark: SparkSession, air: str, weather: str, key=KEY) -> DataFrame:
    """Inner join of two bucketed tables on their key: a merge of sorted buckets, without an exchange."""
    a, w = spark.table(air), spark.table(weather)
    w = w.drop(*[c for c in w.columns if c in a.columns and c not in key])
    return a.join(w.hint("merge"), list(key), "inner")
