"""Exact top-k inner-product search over KD-trees, one per shard.

Each shard of the vectors builds its tree once, by median splits with tight bounding boxes.  A query walks a
tree best first by the largest inner product its boxes allow, and stops at its kth best score so far.  Every
query first meets one shard; the kth score that it finds there goes with it to all shards.  Queries travel
in blocks; shards stay where they are.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint
from .vector_blocks import blocks, deal, meet, quantise, whole, with_more

LEAF = 128


class Tree:
    """Nodes in arrays: box bounds, children (-1: leaf) and the row range of leaves in tree order."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((names[1], names[0]))  # by id, then row
        self.names, self.vectors = names[:, order], vectors[order]
        rows = np.arange(len(order))
        lows, highs, kids, spans, placed = [], [], [], [], []
        stack = [(rows, -1, 0)]
        at = 0
        while stack:
            part, parent, side = stack.pop()
            here, box = len(lows), self.vectors[part]
            low, high = box.min(axis=0), box.max(axis=0)  # vectors without components have no axis
            lows.append(low)
            highs.append(high)
            kids.append([-1, -1])
            spans.append((0, 0))
            if parent >= 0:
                kids[parent][side] = here
            axis = int(np.argmax(high - low)) if len(low) else 0
            if len(part) <= LEAF or not len(low) or low[axis] == high[axis]:  # equal vectors stay in one leaf
                spans[here] = (at, at + len(part))
                at += len(part)
                placed.append(np.sort(part))  # by id, for ties
                continue
            by = part[np.argsort(box[:, axis], kind="stable")]
            half = len(by) // 2
            stack += [(by[half:], here, 1), (by[:half], here, 0)]
        perm = np.concatenate(placed) if placed else rows
        self.names, self.vectors = self.names[:, perm], self.vectors[perm]
        self.low, self.high, self.kids, self.spans = np.array(lows), np.array(highs), kids, spans

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """query x node: the largest inner product any point of the node's box can have."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, floor: float, k: int) -> list[tuple[float, int, int]]:
        """At most k hits (score, -id, -row) that no k others beat; scores below ``floor`` may be left out.

        The row ``own`` is skipped.
        """
        best: list[tuple[float, int, int]] = []
        queue = [(-bound[0], 0)]
        while queue:
            b, node = heapq.heappop(queue)
            least = max(best[0][0], floor) if len(best) == k else floor
            if -b < least:  # an equal bound may still bring a smaller id
                break
            left, right = self.kids[node]
            if left >= 0:
                heapq.heappush(queue, (-bound[left], left))
                heapq.heappush(queue, (-bound[right], right))
                continue
            a, z = self.spans[node]
            scores = whole(self.vectors[a:z] @ query)
            some = np.flatnonzero(scores >= least)
            some = some[np.argsort(-scores[some], kind="stable")][: k + 1]  # leaf rows stand in id order
            for i in some:
                hit = float(scores[i]), -int(self.names[0, a + i]), -int(self.names[1, a + i])
                if -hit[2] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, hit)
                elif hit > best[0]:
                    heapq.heapreplace(best, hit)
        return best


def _search(k: int):
    def prepare(names: np.ndarray, vectors: np.ndarray):
        tree = Tree(names, vectors)

        def find(asked: np.ndarray, queries: np.ndarray, more: bytes) -> list[tuple]:
            floors = np.frombuffer(more, dtype=np.float64) if more else np.full(len(queries), -np.inf)
            floors = np.where(np.isnan(floors), -np.inf, floors)
            bound = tree.bounds(queries)
            return [(own, query, -i, -row, int(s)) for j, (query, own) in enumerate(asked.T.tolist())
                    for s, i, row in tree.search(queries[j], own, bound[j], floors[j], k)]
        return find
    return prepare


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = 8192, block_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, ties to the smaller id.

    ``is_query`` is a condition on the id column.  Rows whose id or vector is NULL, or whose vector holds a NULL
    or non-finite component, take no part.  Rows, not ids, are told apart: a repeated id or row is a query
    and a candidate each time that it stands there, and only the query's own row is left out.  Vectors of
    different lengths have no inner product, so each length is searched apart; empty ones all score 0.
    Fewer than k candidates are all returned; an empty table gives an empty result.  Work grows with queries
    times rows; a task holds one shard and one block at a time, and each shard's k best per query meet in one
    exact cut.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col)).alias("vector"))
            .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
            .withColumns({"width": F.size("vector"), "label": F.lit(0), "row": F.monotonically_increasing_id()}))
    rows = checkpoint(rows, "topk-vectors")
    shards = blocks(rows, shard_rows, "topk-shards")
    asked = blocks(rows.where(is_query(F.col("id"))), block_rows, "topk-blocks")
    schema = "row long, query_id long, vec_id long, vec_row long, score long"

    first = meet(shards, deal(asked, shards, F.lit(True), one=True).withColumn("more", F.lit(b"")), _search(k), schema)
    kth = (first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
           .where(F.col("n") == k).select("row", F.array("least").alias("numbers")))
    floored = checkpoint(with_more(asked, kth, 1), "topk-floors")
    found = meet(shards, deal(floored, shards, F.lit(True)), _search(k), schema)
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "vec_row"))
    return (found.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
