"""Hard-negative mining with segment summaries as a filter.

A vector is cut into equal segments; each keeps its sum and its deviation (the root of its squared distance
from the segment's mean).  Of two vectors, a segment's inner product is the product of their means times the
segment's length, give or take the product of their deviations.  Summed over the segments that bounds the
score.  Candidates whose bounds cannot matter go; for the others every segment is halved and the bounds are
taken again, until the rest is scored exactly.

Rows are dealt to shards by length and label.  A shard computes its summaries once and meets the blocks of
anchors that concern it, one after the other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint
from .vector_blocks import blocks, deal, meet, quantise, whole, with_more

#: Segments of a vector at each level of refinement (fewer if it has fewer components).
LEVELS = (1, 2, 4, 8, 16)
#: Bounds are widened by this share of the vectors' norms, far beyond rounding errors.
SLACK = 1e-9
#: Candidates below this number are scored at once.
FEW = 16


class Summaries:
    """Sums and deviations of the segments of many vectors, level by level; made when first asked for."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norms = np.sqrt((vectors ** 2).sum(axis=1))
        self.width = vectors.shape[1]
        self.levels = [k for k in LEVELS if k <= self.width]
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(means times root of length, deviations), so that plain products of them sum up."""
        if k not in self.made:
            edges = self.width * np.arange(k + 1) // k
            n = np.diff(edges)
            sums = np.add.reduceat(self.vectors, edges[:-1], axis=1)
            squares = np.add.reduceat(self.vectors ** 2, edges[:-1], axis=1)
            self.made[k] = sums / np.sqrt(n), np.sqrt(np.maximum(squares - sums ** 2 / n, 0))
        return self.made[k]


def survivors(query: int, asked: Summaries, rows: Summaries, keep: Callable[[np.ndarray, np.ndarray], np.ndarray],
              among: np.ndarray) -> np.ndarray:
    """The numbers of the rows ``among`` whose bounds ``keep`` lets through at every level."""
    for k in rows.levels:
        if len(among) <= FEW:
            break
        (means, devs), (q_means, q_devs) = rows.at(k), asked.at(k)
        some = among if len(among) < len(means) else slice(None)  # all rows: no copy
        middle, reach = means[some] @ q_means[query], devs[some] @ q_devs[query]
        reach = reach + SLACK * rows.norms[some] * asked.norms[query] + 1e-6
        among = among[keep(middle - reach, middle + reach)]
    return among


def exact(query: int, asked: Summaries, rows: Summaries, among: np.ndarray) -> np.ndarray:
    """The scores of the rows ``among``."""
    return whole(rows.vectors[among] @ asked.vectors[query])


def best_scores(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Keeps what can be among the k highest scores."""
    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        sure = float(np.partition(low, -k)[-k]) if len(low) >= k else -np.inf
        return ~(high < sure)
    return keep


def best_in_ranges(k: int, ranges: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Keeps what can be among the k highest scores inside any of the closed ranges (rows: lowest, highest)."""
    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(low), dtype=bool)
        for least, most in ranges:
            inside = low[(low >= least) & (high <= most)]
            sure = float(np.partition(inside, -k)[-k]) if len(inside) >= k else least
            kept |= ~((high < max(least, sure)) | (low > most))
        return kept
    return keep


def _top(ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, then the smaller row."""
    return np.lexsort((rows, ids, -scores))[:k]


def _find_positives(k: int):
    def prepare(names: np.ndarray, vectors: np.ndarray):
        rows = Summaries(vectors)

        def find(anchors: np.ndarray, queries: np.ndarray, _more: bytes) -> list[tuple]:
            asked, out = Summaries(queries), []
            for q, (anchor, own) in enumerate(anchors.T.tolist()):
                among = survivors(q, asked, rows, best_scores(k), np.flatnonzero(names[1] != own))
                scores = exact(q, asked, rows, among)
                for i in _top(names[0][among], names[1][among], scores, k):
                    out.append((own, anchor, int(names[1][among[i]]), int(names[0][among[i]]), int(scores[i])))
            return out
        return find
    return prepare


def _find_negatives(k: int, low: int, high: int):
    def prepare(names: np.ndarray, vectors: np.ndarray):
        rows = Summaries(vectors)

        def find(anchors: np.ndarray, queries: np.ndarray, more: bytes) -> list[tuple]:
            wanted = np.frombuffer(more, dtype=np.float64).reshape(anchors.shape[1], -1)  # positive scores, filled with NaN
            asked, out = Summaries(queries), []
            for q, (anchor, own) in enumerate(anchors.T.tolist()):
                goals = np.unique(wanted[q][wanted[q] >= 0])  # below 0 no score lies in the range
                if not len(goals):
                    continue
                # Widened by rounding's reach; the test below is on whole numbers.
                ranges = np.stack([low * goals / 100 * (1 - 1e-9) - 1e-6, high * goals / 100 * (1 + 1e-9) + 1e-6], axis=1)
                among = survivors(q, asked, rows, best_in_ranges(k, ranges), np.arange(names.shape[1]))
                scores = exact(q, asked, rows, among)
                for goal in goals.tolist():
                    hit = np.flatnonzero((low * goal <= 100 * scores) & (100 * scores <= high * goal))
                    found = among[hit]
                    for i in _top(names[0][found], names[1][found], scores[hit], k):
                        out.append((own, anchor, int(goal), int(names[1][found[i]]), int(names[0][found[i]]), int(scores[hit][i])))
            return out
        return find
    return prepare


def mine(vectors: DataFrame, is_anchor, k_positives: int = 5, k_negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label",
         shard_rows: int = 8192, block_rows: int = 512) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor (``is_anchor`` is a condition on the id) its ``k_positives`` highest scores among the
    other rows of its label, and for each of them the ``k_negatives`` highest scores among rows of other
    labels with low * positive <= 100 * negative <= high * positive.  Scores are inner products of
    floor(256 * component); ties go to the smaller id.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component take no part.  Rows, not ids,
    are told apart: a repeated id or row is an anchor and a candidate for each time that it stands there, and
    only an anchor's own row is left out.  Vectors of different lengths have no inner product and do not meet; empty
    ones all score 0.  An empty table gives no rows.

    Work grows with anchors times rows, as the task states it, in blocks; a label that holds most rows is
    cut into shards of ``shard_rows`` like any other.
    """
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"),
                           quantise(F.col(vector_col)).alias("vector"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
            .withColumns({"width": F.size("vector"), "row": F.monotonically_increasing_id()}))
    rows = checkpoint(rows, "negatives-vectors")
    shards = blocks(rows, shard_rows, "negatives-shards")
    asked = blocks(rows.where(is_anchor(F.col("id"))), block_rows, "negatives-anchors")

    same = F.col("label") == F.col("s_label")
    near = meet(shards, deal(asked, shards, same).withColumn("more", F.lit(b"")), _find_positives(k_positives),
                "row long, id long, positive_row long, positive_id long, positive_score long")
    # Each shard's best meet in one exact cut.
    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    positives = checkpoint(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k_positives),
                           "negatives-positives")

    scores = positives.groupBy("row").agg(F.collect_list(F.col("positive_score").cast("double")).alias("numbers"))
    second = checkpoint(with_more(asked, scores, k_positives), "negatives-goals")
    far = meet(shards, deal(second, shards, ~same), _find_negatives(k_negatives, low, high),
               "row long, id long, positive_score long, negative_row long, negative_id long, negative_score long")
    # The positives of one anchor with equal scores share their negatives.
    best = Window.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    negatives = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k_negatives)
    return (positives.join(negatives.drop("id"), ["row", "positive_score"])
            .select(F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
