"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..session import ensure_checkpoint_dir, read_table, scratch_path

__all__ = ["checkpoint", "ensure_checkpoint_dir", "read_table", "scratch_path", "per_text", "text_or_empty",
           "held_out", "labelled", "label_sample", "sigmoid", "fit_logistic", "mix64"]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """``session.checkpoint``; the shuffle files of the write go with it, since only the table is read on.

    The session's own setting is put back.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return session.checkpoint(df, name)
    finally:
        conf.set(_CLEANUP, before) if before is not None else conf.unset(_CLEANUP)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def per_text(schema: str | T.StructType, make: Callable[[], Callable[[str], tuple]]):
    """A column function text -> struct, computed one whole text at a time inside Arrow batches.

    ``make`` runs once per task and returns the per-text function (so it may load a model).  A
    NULL text counts as empty.  Marked non-deterministic so that Catalyst never evaluates it twice
    to push a filter below it.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in struct.fields]

    @F.pandas_udf(struct)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fn = make()
        for texts in batches:
            rows = [fn(t if isinstance(t, str) else "") for t in texts]
            yield pd.DataFrame(rows, columns=names)

    return run.asNondeterministic()


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """True for rows never used to learn: crc32(id as text) mod ``modulus`` equals ``remainder``."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def labelled(labels: DataFrame, label_col: str, modulus: int, remainder: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label): the labelled rows that may be learned from.

    Rows with a NULL id or label and the held-out rows are left out; an id labelled twice takes its
    lowest label.
    """
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
            .where(~held_out(F.col("doc_id"), modulus, remainder))
            .groupBy("doc_id").agg(F.min("label").alias("label")))


def label_sample(labels: DataFrame, label_col: str, modulus: int, remainder: int, bound: int,
                 id_col: str = "doc_id") -> DataFrame:
    """A bounded hash sample of ``labelled``.

    ``bound`` is the expected number of rows kept; below it every row is kept.  The choice depends on the id's
    hash alone, so it is the same on every run.
    """
    rows = labelled(labels, label_col, modulus, remainder, id_col)
    n = rows.count()
    if n <= bound:
        return rows
    parts = 1 << 30
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("label sample")), F.lit(parts)) < int(parts * bound / n))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method for ridge logistic regression; ``x`` already holds any constant column."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) / len(y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, grad)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return w


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over a uint64 array (arithmetic modulo 2^64)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
