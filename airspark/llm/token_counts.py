"""Token counts through a digest cache.

Texts are normalised (NULL becomes empty, nothing else: any other change would change the count) and
digested with SHA-256.  The cache is a Parquet table keyed by content digest and tokenizer digest (the
tokenizer's version).  Digests are joined to the stored counts, only distinct misses are encoded, and
the new counts are appended to the cache before the final join reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokenizing, word_memo
from .common import checkpoint, per_text, scratch_path, text_or_empty

CACHE_SCHEMA = T.StructType([
    T.StructField("content", T.BinaryType()), T.StructField("tokenizer", T.StringType()),
    T.StructField("n_tokens", T.LongType())])


#: A warm cache misses few digests, of 32 bytes or so: at most so many, and a small share of all rows.  These are sent to
#: the texts; else texts and digests are shuffled.
BROADCAST_MISSES, BROADCAST_SHARE = 100_000, 0.01


def content_digest(text) -> F.Column:
    """128 bits of SHA-256 of the normalised text."""
    return F.unhex(F.substring(F.sha2(F.encode(text_or_empty(text), "UTF-8"), 256), 1, 32))


def _counter(tokenizer: str):
    if tokenizer.endswith(".json"):
        return word_memo.encoder(tokenizer).count
    encode = tokenizing.encoder(tokenizer)
    return lambda text: len(encode(text))


def _cached(spark, cache_path: str, version: str) -> DataFrame:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA).select("content", "n_tokens")
    # Two writers may have appended the same digest; their counts are equal.
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version)
            .groupBy("content").agg(F.min("n_tokens").alias("n_tokens")))


def _standing_for(keyed: DataFrame, misses: DataFrame, n: int, of: int) -> DataFrame:
    """content, row, text of the rows that stand for the ``n`` missing digests of ``of`` rows.

    Few digests go to the texts, so that a warm cache moves no text; many stream through a hashed semi-join, whose
    text side is neither sorted nor collected.
    """
    side = F.broadcast(misses) if n <= min(BROADCAST_MISSES, BROADCAST_SHARE * of) else misses.hint("shuffle_hash")
    return keyed.select("content", "row", "text").join(side, ["content", "row"], "left_semi")


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", cache_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    One row out per row in, also for NULL, repeated or clashing ids; a NULL or empty text counts 0
    tokens.  ``cache_path`` names a cache shared by runs; without it the call starts an empty one.
    Equal texts, however many, are encoded once: their copies meet only as 16-byte digests, which are
    pre-aggregated, and the text is sent on for one row of each missing digest.  With none missing no text is
    read a second time.
    """
    spark = docs.sparkSession
    version = tokenizing.version_digest(tokenizer)
    cache_path = cache_path or scratch_path(spark, "token-cache")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    # The row that stands for its digest: the least salt, which a rerun of the scan gives again.
    keyed = texts.select("doc_id", "text", content_digest("text").alias("content"),
                         F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("row"))
    digests = checkpoint(keyed.select("doc_id", "content", "row", F.octet_length("text").cast("long").alias("n_bytes")),
                         "token-digests")
    misses = checkpoint(digests.groupBy("content").agg(F.min("row").alias("row"))
                        .join(_cached(spark, cache_path, version), "content", "left_anti"), "token-misses")
    n = misses.count()
    if n:
        encode = per_text("n_tokens long", lambda: (lambda count: lambda t: (count(t),))(_counter(tokenizer)))
        # Rows that repeat both id and text remain, and the cache's reader keeps one of them.
        (_standing_for(keyed, misses, n, digests.count())
         .select("content", F.lit(version).alias("tokenizer"), encode("text")["n_tokens"].alias("n_tokens"))
         .write.mode("append").parquet(cache_path))
    # Written apart, so that the join below has no aggregate in it and Spark can split a hot digest.
    counts = checkpoint(_cached(spark, cache_path, version), "token-counts")
    return (digests.select("doc_id", "content", "n_bytes").join(counts, "content")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
