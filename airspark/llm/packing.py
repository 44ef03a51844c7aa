"""Packing documents into fixed-length token sequences by Karmarkar-Karp multiway differencing.

Each document becomes its token ids and an end id.  Whole windows are cut off first; the rest is cut into
short pieces.  Pieces are dealt to blocks of bounded size, and each block splits its pieces over k windows:
partial partitions are merged two by two, the largest spreads first, the fullest windows of one onto the
emptiest of the other.  Whenever a window exceeds the capacity, k rises and the block is split anew.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import word_memo
from .common import checkpoint, per_text

END_ID = 1
BLOCK_PIECES = 4096
WINDOWS_BITS = 20


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each item, by multiway differencing of ``sizes`` over k windows."""
    n = len(sizes)
    left, right = list(range(n)), [-1] * n  # windows as a forest: a node joins two earlier ones
    # A partial partition: its windows' sums in descending order and their nodes; missing windows are empty.
    heap: list = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    if k == 1:
        return np.zeros(n, dtype=np.int64)
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - k)  # so many windows of each fall together
        b, b_nodes = b[::-1], b_nodes[::-1]
        sums = np.concatenate([a, b[over:]])
        nodes = np.concatenate([a_nodes, b_nodes[over:]])
        if over:
            # Position i of a meets position k - 1 - i of b, which is empty unless k - 1 - i < len(b).
            sums[len(a) - over: len(a)] += b[:over]
            first = len(left)
            left += a_nodes[len(a) - over:].tolist()
            right += b_nodes[:over].tolist()
            nodes[len(a) - over: len(a)] = np.arange(first, first + over)
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, turn, sums, nodes))
        turn += 1
    out = np.zeros(n, dtype=np.int64)
    for window, root in enumerate(heap[0][3].tolist() if heap else []):
        stack = [root]
        while stack:
            x = stack.pop()
            if x < n:
                out[x] = window
            else:
                stack += (left[x], right[x])
    return out


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for items no larger than ``capacity``: as few as differencing can fill without excess."""
    total = int(sizes.sum())
    k = max(1, -(-total // capacity))
    while True:
        window = differencing(sizes, k)
        fullest = int(np.bincount(window, weights=sizes, minlength=k).max(initial=0))
        if fullest <= capacity or k >= len(sizes):
            return window if fullest <= capacity else np.arange(len(sizes))
        room = capacity - (fullest - total / k)  # the mean load at which this spread would fit
        k = min(len(sizes), max(k + 1, math.ceil(total / room) if room > 0 else k + 1))


def cut(n: int, capacity: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then near-equal ones of at most ``longest``."""
    out = [(s, capacity) for s in range(0, n - capacity + 1, capacity)]
    start = len(out) * capacity
    parts = -(-(n - start) // longest)
    edges = [start + (n - start) * i // parts for i in range(parts + 1)] if parts else []
    return out + [(a, z - a) for a, z in zip(edges, edges[1:])]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, longest: int, end_id: int, id_col: str, text_col: str,
           with_ids: bool) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked, its ids."""

    def make():
        encoder = word_memo.encoder(tokenizer)

        def one(text: str):
            ids = np.append(encoder.ids(text), [end_id]).astype("<u4")
            spans = cut(len(ids), capacity, longest)
            raw = ids.tobytes()
            row = (len(ids), [s for s, _ in spans], [n for _, n in spans],
                   [zlib.crc32(raw[4 * s: 4 * (s + n)]) for s, n in spans])
            return row + ([ids[s: s + n].tolist() for s, n in spans],) * with_ids
        return one

    lists = ["start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_tokens long, start array<long>, length array<long>, ids_crc32 array<long>" + (
        ", ids array<array<int>>" * with_ids)
    done = docs.select(F.col(id_col).alias("doc_id"), per_text(schema, make)(text_col).alias("p"))
    return done.select("doc_id", F.col("p.doc_tokens").alias("doc_tokens"),
                       F.inline(F.arrays_zip(*[F.col(f"p.{c}").alias(c) for c in lists])))


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 2048, longest: int = 512,
                   end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids): one row per piece.

    A NULL or empty text is its end id alone.  Every row of ``docs`` is packed, repeated ids and rows
    too; an empty table gives no pieces.  No sequence exceeds ``capacity``; a whole window is a sequence
    of its own.  Texts are not shuffled: only the rows that describe short pieces are, dealt evenly by
    their number to blocks of about BLOCK_PIECES, whatever documents or sources they come from.
    """
    rows = checkpoint(pieces(docs, tokenizer, capacity, longest, end_id, id_col, text_col, with_ids)
                      .withColumn("_piece", F.monotonically_increasing_id()), "packing-pieces")
    names = [c for c in rows.columns if c != "_piece"]
    whole = rows.where(F.col("length") == capacity)
    short = rows.where(F.col("length") < capacity)
    n_blocks = max(1, -(-short.count() // BLOCK_PIECES))
    # Ids pass as text: pandas would turn a column of longs with NULLs into doubles.
    id_type = rows.schema["doc_id"].dataType
    short = short.withColumns({"_block": F.pmod(F.xxhash64("_piece"), F.lit(n_blocks)),
                               "doc_id": F.col("doc_id").cast("string")})

    def fill(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_piece", kind="stable")
        block["_window"] = pack(block["length"].to_numpy(), capacity)
        block["offset"] = block.groupby("_window")["length"].cumsum() - block["length"]
        # Even numbers; whole windows take the odd ones.
        block["sequence_id"] = (block["_block"] * (1 << WINDOWS_BITS) + block["_window"]) * 2
        return block[[*names, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in short.schema if f.name not in ("_piece", "_block"))
    packed = short.groupBy("_block").applyInPandas(fill, schema + ", sequence_id long, offset long")
    packed = packed.withColumn("doc_id", F.col("doc_id").cast(id_type))
    alone = whole.select(*names, (F.col("_piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return packed.unionByName(alone).select(*out)
