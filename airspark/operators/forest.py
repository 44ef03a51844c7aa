"""Random forest of regression trees, grown tree by tree in parallel tasks.

Features are binned once (see ``boosting``).  A tree's rows are drawn with Poisson(1) counts from the hash of their
number; every node looks at its own features, drawn from its place in the tree, and takes the cut that lowers the squared
error most.  While a level's nodes have fewer bins than rows, it sums its rows by (node, bin); below, rows stay sorted by
(node, bin), so a level costs one pass over a tree's rows whatever its number of nodes.  The nodes are written by the tasks as the table that a Spark ML forest loads.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .boosting import DRAWS, GAIN_TIE, _arrays, _drawn, prepared

#: A cut must lower a node's squared error by more than this share of the label's variance.
LEAST_GAIN = 1e-9
#: Or, if labels are equal, than this share of their square: what rounding leaves of them.
ROUNDING = 1e-18
#: Rows that are sent to the tasks as one value.
ROWS_OF_A_BLOCK = 50_000
NODES = ("treeID int, feature array<int>, cut array<double>, left array<int>, right array<int>, gain array<double>, "
         "count array<bigint>, mean array<double>, square array<double>")


@dataclass
class Forest:
    """Parameters; ``grow`` learns from a label column and an array column of features without NULLs."""

    trees: int = 300
    depth: int = 14
    least_leaf: int = 3
    least_split: int = 8
    share: float = 0.85  # of the features that a node looks at
    seed: int = 42
    max_bins: int = 256
    label: str = "us_aqi"
    array: str = "_x"

    def grow(self, df: DataFrame, kept: dict | None = None) -> DataFrame:
        """(treeID, nodeData) as Spark ML saves a forest; children have higher ids than their parents."""
        _, edges, rows = prepared(df, self.label, self.array, self.max_bins, self.seed, kept)
        tasks = min(self.trees, 3 * df.sparkSession.sparkContext.defaultParallelism)
        dealt = (rows.mapInArrow(_pack(len(edges)), "block binary")
                 .withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, "task"))
        return spark_nodes(dealt.mapInArrow(self._some(edges, tasks), NODES))

    def _some(self, edges: list[list[float]], tasks: int) -> Callable:
        """The trees of one task on all rows."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks, task = [], None
            for batch in batches:
                blocks += [pickle.loads(b) for b in batch.column("block").to_pylist()]
                task = batch.column("task")[0].as_py() if batch.num_rows else task
            if task is None:
                return
            y, bins, draw, r = (np.concatenate(part, axis=-1) for part in zip(*blocks))
            order = np.argsort(r, kind="stable")
            y, bins, draw = y[order], bins[:, order], draw[order]
            for tree in range(task, self.trees, tasks):
                counts = _poisson(_drawn(draw, tree))
                counts = counts if counts.any() else np.ones_like(counts)  # of few rows, none may be drawn
                nodes = self._tree(bins, y, counts, tree, edges)
                yield pa.RecordBatch.from_pydict({"treeID": pa.array([tree], pa.int32()), **{
                    k: pa.array([v], pa.list_({"f": pa.float64(), "i": pa.int32()}[v.dtype.kind] if k != "count" else pa.int64()))
                    for k, v in nodes.items()}})

        return run

    def _tree(self, bins: np.ndarray, y: np.ndarray, counts: np.ndarray, tree: int, edges: list[list[float]]) -> dict[str, np.ndarray]:
        """A tree's nodes, a level after the other."""
        some = np.flatnonzero(counts)
        y, w, b = y[some], counts[some].astype(float), bins[:, some]
        width, looked = max(map(len, edges), default=0) + 1, max(1, math.ceil(self.share * len(edges)))
        least_gain, levels, first = 0.0, [], 0
        node, heap, order = np.zeros(len(y), dtype=np.int32), np.zeros(1, dtype=np.uint64), None
        for depth in range(self.depth + 1):
            # ``node``: the open node of each row that is left; ``order``: its rows by (node, bin), once there are many nodes.
            size = len(heap)
            count = np.bincount(node, w, size)
            mean = np.bincount(node, w * y, size) / count
            g = y - mean[node]
            square = np.bincount(node, w * g * g, size)
            g *= w
            if not depth:
                least_gain = LEAST_GAIN * square[0] / count[0] + ROUNDING * mean[0] ** 2
            level = {"feature": np.full(size, -1, dtype=np.int32), "cut": np.zeros(size), "left": np.full(size, -1, dtype=np.int32),
                     "right": np.full(size, -1, dtype=np.int32), "gain": np.full(size, -1.0), "count": count.astype(np.int64),
                     "mean": mean, "square": square}
            levels.append(level)
            first += size
            if depth == self.depth or not edges:
                break
            picked = _picked(self.seed, tree, heap, len(edges), looked)
            if order is None and size * width > len(y):
                order = [o[np.argsort(_short(node, size)[o], kind="stable")] for o in (np.argsort(x, kind="stable") for x in b)]
                order = [o.astype(np.int32) for o in order]
            gain, feature, bin_at = (self._best_summed(b, w, g, node, count, picked, width) if order is None else
                                     self._best_sorted(b, w, g, node, count, picked, order))
            split = (count >= self.least_split) & (gain > least_gain)
            if not split.any():
                break
            kids = np.cumsum(split) * 2 - 2  # the left child's number on the next level
            level["feature"][split] = feature[split]
            level["cut"][split] = [edges[f][k] for f, k in zip(feature[split], bin_at[split])]
            level["left"][split], level["right"][split] = first + kids[split], first + kids[split] + 1
            level["gain"][split] = gain[split] / count[split]
            heap = np.stack([2 * heap[split] + np.uint64(1), 2 * heap[split] + np.uint64(2)], axis=1).ravel()
            # Rows of split nodes go on; a stable sort by the new node keeps the order of their bins.
            stays = split[node]
            node = (kids[node] + (b[feature[node], np.arange(len(node))] > bin_at[node])).astype(np.int32)
            if order is not None:
                place, number = (np.cumsum(stays) - 1).astype(np.int32), _short(node, len(heap))
                order = [o[stays[o]] for o in order]
                order = [place[o[np.argsort(number[o], kind="stable")]] for o in order]
            if not stays.all():
                node, y, w, b = node[stays], y[stays], w[stays], b[:, stays]
        return {k: np.concatenate([level[k] for level in levels]) for k in levels[0]}

    def _gain(self, left: np.ndarray, total: np.ndarray, right: np.ndarray, ok) -> np.ndarray:
        """How much cuts lower the squared error, given counts and the left side's sums.

        Sums are of what is left of the label without the node's mean, so those of the two sides cancel.
        """
        ok = ok & (left >= self.least_leaf) & (right >= self.least_leaf)
        return np.where(ok, total * total * (1 / np.maximum(left, 1) + 1 / np.maximum(right, 1)), -np.inf)

    def _best_summed(self, b, w, g, node, count, picked, width) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each open node's best lowering of the squared error, its feature and its last bin on the left."""
        size = len(count)
        gains, cut = np.full((len(b), size), -np.inf), np.zeros((len(b), size), dtype=np.int64)
        start = node * np.int32(width)
        for f, x in enumerate(b):
            at = start + x
            left, total = (np.bincount(at, v, size * width).reshape(size, width).cumsum(axis=1) for v in (w, g))
            gain = self._gain(left, total, count[:, None] - left, True)
            gains[f] = gain.max(axis=1)
            cut[f] = (gain >= (gains[f] * (1 - GAIN_TIE))[:, None]).argmax(axis=1)
        return _first_best(gains, cut, picked)

    def _best_sorted(self, b, w, g, node, count, picked, order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same from rows sorted by (node, bin)."""
        size = len(count)
        rows = np.bincount(node, minlength=size)
        start = np.cumsum(rows) - rows
        of = np.repeat(np.arange(size, dtype=np.int32), rows)
        inner, whole = np.append(of[1:] == of[:-1], False), count[of]  # places followed by another row of their node
        gains, cut = np.full((len(b), size), -np.inf), np.zeros((len(b), size), dtype=np.int64)
        for f, o in enumerate(order):
            left, total, bins = np.cumsum(w[o]), np.cumsum(g[o]), b[f][o]
            left -= np.append(0.0, left)[start][of]
            total -= np.append(0.0, total)[start][of]
            last = inner.copy()
            last[:-1] &= bins[1:] != bins[:-1]
            gain = self._gain(left, total, whole - left, last)
            gains[f] = np.maximum.reduceat(gain, start)
            hit = np.flatnonzero(gain >= (gains[f] * (1 - GAIN_TIE))[of])
            one = np.append(True, of[hit][1:] != of[hit][:-1])
            cut[f, of[hit[one]]] = bins[hit[one]]
        return _first_best(gains, cut, picked)


def _first_best(gains: np.ndarray, cut: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the features a node looks at, the best; ties go to the first."""
    gains[~picked.T] = -np.inf
    best = gains.max(axis=0)
    feature = (gains >= best * (1 - GAIN_TIE)).argmax(axis=0)
    return best, feature, cut[feature, np.arange(len(best))]


def _short(numbers: np.ndarray, size: int) -> np.ndarray:
    """Numbers below ``size`` in a type that is sorted by radix, if there is one."""
    return numbers.astype(np.uint16 if size <= 1 << 16 else np.int64)


def _pack(n_features: int) -> Callable:
    """Rows of a task as blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        y, bins, draw = _arrays(iter(batches), n_features)
        r = np.sort(np.concatenate([np.empty(0, dtype=int), *[x.column("r").to_numpy(zero_copy_only=False) for x in batches]]))
        for at in range(0, len(y), ROWS_OF_A_BLOCK):
            part = slice(at, at + ROWS_OF_A_BLOCK)
            block = pickle.dumps((y[part], bins[:, part], draw[part], r[part]))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.binary())})

    return run


def _poisson(draws: np.ndarray) -> np.ndarray:
    """Poisson(1) counts by inversion."""
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]) * DRAWS
    return np.searchsorted(below, draws, side="right").astype(np.int64)


def _picked(seed: int, tree: int, heap: np.ndarray, n_features: int, looked: int) -> np.ndarray:
    """(node, feature): whether the node looks at it; the features of the lowest hashes are looked at."""
    def mix(h):
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return h ^ h >> np.uint64(31)

    step = np.uint64(0x9E3779B97F4A7C15)
    h = mix(mix(heap + np.array([tree + 1], dtype=np.uint64) * step) + np.array([seed], dtype=np.uint64) * step)
    h = mix(h[:, None] + (np.arange(n_features, dtype=np.uint64) + np.uint64(1)) * step)
    picked = np.zeros(h.shape, dtype=bool)
    np.put_along_axis(picked, np.argsort(h, axis=1, kind="stable")[:, :looked], True, axis=1)
    return picked


def spark_nodes(trees: DataFrame) -> DataFrame:
    """Rows of ``NODES``, one a tree, as the table of nodes that Spark ML's tree models save."""
    zipped = F.arrays_zip(*[c for c in trees.columns if c != "treeID"])
    nodes = trees.select("treeID", F.posexplode(zipped).alias("id", "n"))
    n, count = F.col("n"), F.col("n.count").cast("double")
    leaf = n["feature"] < 0
    return nodes.select("treeID", F.struct(
        F.col("id").alias("id"), n["mean"].alias("prediction"), F.when(count > 0, n["square"] / count).otherwise(0.0).alias("impurity"),
        F.array(count, n["mean"] * count, n["square"] + n["mean"] * n["mean"] * count).alias("impurityStats"),
        n["count"].alias("rawCount"), n["gain"].alias("gain"), n["left"].alias("leftChild"), n["right"].alias("rightChild"),
        F.struct(n["feature"].alias("featureIndex"),
                 F.when(leaf, F.array().cast("array<double>")).otherwise(F.array(n["cut"])).alias("leftCategoriesOrThreshold"),
                 F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
