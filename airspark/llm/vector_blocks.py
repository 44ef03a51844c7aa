"""Vectors dealt to blocks, and blocks of queries sent to shards of candidates.

Rows have the columns width (number of components), label, id, row (one number a row) and vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

KEY = ["width", "label", "block"]
SHARD = ["width", "s_label", "s_block"]


def quantise(vector) -> Column:
    """floor(256 x) of each component as double; NULL if a component is NULL, NaN or infinite."""
    v = F.transform(vector, lambda x: x.cast("double"))
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ok, F.transform(v, lambda x: F.floor(x * 256).cast("double")))


def whole(scores: np.ndarray) -> np.ndarray:
    """Scores that a long can hold: beyond its ends, the ends."""
    return np.clip(np.nan_to_num(scores), -9.2e18, 9.2e18)


def unpack(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """([ids, rows], vectors) of a block."""
    i = np.frombuffer(ids, dtype=np.int64).reshape(2, -1)
    return i, np.frombuffer(vectors, dtype=np.float64).reshape(i.shape[1], width)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (width, label, block, id, row, vector) -> one row a block: its ids and vectors as bytes."""
    key, ids, rows, vectors = None, [], [], []

    def out():
        return pd.DataFrame({"width": [key[0]], "label": [key[1]], "block": [key[2]],
                             "ids": [np.array([ids, rows], dtype=np.int64).tobytes()],
                             "vectors": [np.array(vectors, dtype=np.float64).tobytes()]})

    for b in batches:
        for width, label, block, i, row, v in zip(b["width"], b["label"], b["block"], b["id"], b["row"], b["vector"]):
            if key is not None and key != (width, label, block):
                yield out()
                ids, rows, vectors = [], [], []
            key = width, label, block
            ids.append(i)
            rows.append(row)
            vectors.append(v)
    if key is not None:
        yield out()


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks of about ``size`` rows of one width and label, as many as its rows need."""
    counts = rows.groupBy("width", "label").agg(F.count("*").alias("n"))
    dealt = (rows.join(counts, ["width", "label"])
             .withColumn("block", F.pmod(F.xxhash64("row", F.lit(name)), F.ceil(F.col("n") / size)).cast("int")))
    return checkpoint(dealt.select(*KEY, "id", "row", "vector").repartition(*KEY).sortWithinPartitions(*KEY, "row")
                      .mapInPandas(_pack, "width int, label int, block int, ids binary, vectors binary"), name)


def deal(asked: DataFrame, shards: DataFrame, fits: Column, one: bool = False) -> DataFrame:
    """The query blocks once for each shard of their width whose s_label ``fits``; with ``one``, for one of these only.

    The shards are known through the small table of their counts, so only blocks are copied.
    """
    counts = shards.groupBy("width", F.col("label").alias("s_label")).agg((F.max("block") + 1).alias("n"))
    met = asked.join(counts, "width").where(fits)
    if one:
        return met.withColumn("s_block", F.pmod(F.col("block"), F.col("n"))).drop("n")
    return met.withColumn("s_block", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")


def meet(shards: DataFrame, sent: DataFrame, search: Callable, schema: str) -> DataFrame:
    """``search(prepared shard)`` over every query block that ``deal`` sent to a shard.

    ``search(names, vectors)`` is called once a shard and gives a function of (names, vectors, more) of a block
    that lists rows of ``schema``.  A task holds one shard and one block at a time.
    """
    both = (shards.select("width", F.col("label").alias("s_label"), F.col("block").alias("s_block"), F.lit(None).cast("int").alias("label"),
                          F.lit(-1).alias("block"), "ids", "vectors", F.lit(None).cast("binary").alias("more"))
            .unionByName(sent.select(*SHARD, "label", "block", "ids", "vectors", "more")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, find = None, None
        for b in batches:
            for width, label, block, number, ids, vectors, more in zip(*(b[c] for c in (*SHARD, "block", "ids", "vectors", "more"))):
                if number < 0:  # the shard itself comes before its blocks
                    at, find = (width, label, block), search(*unpack(ids, vectors, width))
                elif at == (width, label, block):  # else hashing gave this shard no rows
                    out = find(*unpack(ids, vectors, width), more)
                    if out:
                        yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return both.repartition(*SHARD).sortWithinPartitions(*SHARD, "block", "label").mapInPandas(run, schema)


def with_more(asked: DataFrame, values: DataFrame, k: int) -> DataFrame:
    """The blocks with their rows' numbers from ``values`` (row, numbers array), k places each, as bytes in ``more``.

    Missing ones are NaN.
    """
    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for width, label, block, ids in zip(*(b[c] for c in (*KEY, "ids"))):
                own = np.frombuffer(ids, dtype=np.int64).reshape(2, -1)[1]
                yield pd.DataFrame({"width": width, "label": label, "block": block, "at": np.arange(len(own)), "row": own})

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def out():
            return pd.DataFrame({"width": [now[0]], "label": [now[1]], "block": [now[2]],
                                 "more": [np.array(held, dtype=np.float64).tobytes()]})

        for b in batches:
            for width, label, block, numbers in zip(*(b[c] for c in (*KEY, "numbers"))):
                if now is not None and now != (width, label, block):
                    yield out()
                    held = []
                now = width, label, block
                own = [] if numbers is None else list(numbers)
                held.append(own + [np.nan] * (k - len(own)))
        if now is not None:
            yield out()

    places = asked.select(*KEY, "ids").mapInPandas(rows_of, "width int, label int, block int, at long, row long")
    more = (places.join(values, "row", "left").repartition(*KEY).sortWithinPartitions(*KEY, "at")
            .select(*KEY, "numbers").mapInPandas(fill, "width int, label int, block int, more binary"))
    return asked.join(more, KEY)
