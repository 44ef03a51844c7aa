"""Second-order gradient boosting on histograms, squared error.

Features are binned once and kept as arrays.  A level of a tree needs the sums of gradients and counts (the hessian of
squared error is 1) by (node, feature, bin): each block of rows adds up its own, so the driver gets at most
nodes / 2 x features x bins numbers a block, summed in the blocks' order.  Rows of a single task need no exchange, so
there one job grows all trees; else a level is one job over the kept blocks.  The best splits are chosen by

    gain = s(left) + s(right) - s(node),  s(G, H) = T(G)^2 / (H + l2),  T(G) = sign(G) max(|G| - l1, 0)

and a leaf's weight is -T(G) / (H + l2) times the learning rate.  Rows are sampled per tree by a hash of
their number, columns per tree by the seed.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpoint

#: Rows of a level's aggregate count as equal within this share when gains are compared: ties go to the first
#: feature and the lowest cut, whatever the order of summation.
GAIN_TIE = 1e-9
LEAST_GAIN = 1e-6
#: So few rows are one task's work.
ROWS_OF_A_TASK = 200_000
#: Of more rows, a block has this many, or up to the second number if there would be more blocks than cores.
ROWS_OF_A_BLOCK = (50_000, 1_000_000)
#: Sampling draws are hashed to so many values.
DRAWS = 1 << 20


@dataclass
class Tree:
    """Nodes numbered as a heap; ``feature`` -1 marks a leaf, ``cut``: greater values go right."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros(n, dtype=int), np.zeros(n), np.zeros(n), np.zeros(n))


@dataclass
class BoostedTrees:
    """Parameters; ``fit`` learns from a label column and an array column of features without NULLs."""

    rounds: int = 300
    learning_rate: float = 0.05
    depth: int = 4
    min_child: float = 3.0
    rows: float = 0.85
    columns: float = 0.85
    l1: float = 0.1
    l2: float = 2.0
    seed: int = 42
    max_bins: int = 256
    write_every: int = 25  # so many trees' values are summed before they are added to the running prediction
    label: str = "us_aqi"
    array: str = "_x"
    trees: list[Tree] = field(default_factory=list)
    base: float = 0.0
    n_features: int = 0

    def fit(self, df: DataFrame, kept: dict | None = None) -> "FittedBoostedTrees":
        base, edges, rows = prepared(df, self.label, self.array, self.max_bins, self.seed, kept)
        model = BoostedTrees(**{**self.__dict__, "trees": [], "base": base, "n_features": len(edges)})
        n = rows.count()
        if not edges or not n:
            return FittedBoostedTrees(model)
        rng = np.random.default_rng(self.seed)
        picks = [np.sort(rng.permutation(len(edges))[:max(1, int(len(edges) * self.columns))]) for _ in range(self.rounds)]
        if n <= ROWS_OF_A_TASK:
            grown = rows.coalesce(1).mapInArrow(model._alone(edges, picks), "tree binary").collect()
            model.trees = [pickle.loads(r["tree"]) for r in grown]
        else:
            few, many = (-(-n // size) for size in ROWS_OF_A_BLOCK)
            tasks = min(few, max(many, df.sparkSession.sparkContext.defaultParallelism))
            model.trees = model._over_blocks(rows.repartition(tasks), edges, picks)
        return FittedBoostedTrees(model)

    def _alone(self, edges: list[list[float]], picks: list[np.ndarray]) -> Callable:
        """All rounds on the rows of one task."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            y, bins, draw = _arrays(batches, len(edges))
            p, fresh = np.full(len(y), self.base), np.zeros(len(y))
            for turn, picked in enumerate(picks):
                g, drawn = p + fresh - y, np.flatnonzero(_drawn(draw, turn) < int(DRAWS * self.rows))
                tree = self._grow(lambda tree, nodes: _histograms(bins, g, drawn, tree, nodes, picked, edges), picked, edges)
                fresh += tree.value[_leaf(bins, tree)]
                if (turn + 1) % self.write_every == 0:
                    p, fresh = p + fresh, np.zeros(len(y))
                yield pa.RecordBatch.from_pydict({"tree": pa.array([pickle.dumps(tree)], pa.binary())})

        return run

    def _over_blocks(self, rows: DataFrame, edges: list[list[float]], picks: list[np.ndarray]) -> list[Tree]:
        """All rounds, a job a level, over blocks of rows that are kept with their running prediction."""
        base, size, share = self.base, len(edges), int(DRAWS * self.rows)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            y, bins, draw = _arrays(batches, size)
            block = pickle.dumps((y, bins, draw, np.full(len(y), base)))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.binary())})

        kept = StorageLevel.MEMORY_AND_DISK
        blocks = rows.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r["block"])).persist(kept)
        trees, new = [], []
        for turn, picked in enumerate(picks):
            def sums(tree: Tree, nodes: list[int]) -> np.ndarray:
                def of(block, new=tuple(new)):
                    y, bins, draw, p = block
                    drawn = np.flatnonzero(_drawn(draw, turn) < share)
                    return _histograms(bins, p + _fresh(bins, new) - y, drawn, tree, nodes, picked, edges)
                return sum(blocks.map(of).collect())

            new.append(self._grow(sums, picked, edges))
            if len(new) == self.write_every:
                trees, last = trees + new, blocks
                blocks = last.map(lambda b, new=tuple(new): (*b[:3], b[3] + _fresh(b[1], new))).persist(kept)
                blocks.count()
                last.unpersist()
                new = []
        blocks.unpersist()
        return trees + new

    def _grow(self, sums: Callable[[Tree, list[int]], np.ndarray], picked: np.ndarray, edges: list[list[float]]) -> Tree:
        """A tree; ``sums(tree so far, nodes)`` gives these nodes' histograms over all drawn rows."""
        tree, open_nodes, above = Tree.empty(self.depth), {0}, {}
        for _ in range(self.depth):
            # Of two siblings the left one is summed; the right one is what is left of their parent.
            counted = [at for at in sorted(open_nodes) if at % 2 or not at]
            hist = dict(zip(counted, sums(tree, counted)))
            hist |= {at + 1: above[at // 2] - hist[at] for at in counted if at}
            grown = set()
            for at in sorted(open_nodes):
                grown |= self._split(tree, at, hist[at], picked, edges)
            open_nodes, above = grown, hist
            if not open_nodes:
                break
        return tree

    def _weight(self, g: float, h: float) -> float:
        return -self.learning_rate * np.sign(g) * max(abs(g) - self.l1, 0.0) / (h + self.l2)

    def _split(self, tree: Tree, node: int, hist: np.ndarray, picked: np.ndarray, edges: list[list[float]]) -> set[int]:
        """Set the node's weight, and its split if one pays; the children that may be split further."""
        def score(g, h):
            return np.maximum(np.abs(g) - self.l1, 0.0) ** 2 / (h + self.l2)

        left = hist[picked].cumsum(axis=1)
        whole = left[0, -1]  # any feature's bins hold all rows of the node
        if node == 0:
            tree.value[0] = self._weight(*whole)
        right = whole - left
        gain = score(left[..., 0], left[..., 1]) + score(right[..., 0], right[..., 1]) - score(*whole)
        gain[(left[..., 1] < self.min_child) | (right[..., 1] < self.min_child)] = -np.inf
        best = gain.max()
        if not best > LEAST_GAIN:
            return set()
        f, b = np.argwhere(gain >= best - GAIN_TIE * abs(best))[0]
        tree.feature[node], tree.bin[node], tree.gain[node] = picked[f], b, best
        tree.cut[node] = edges[picked[f]][b]
        for child, (g, h) in ((2 * node + 1, left[f, b]), (2 * node + 2, right[f, b])):
            tree.value[child] = self._weight(g, h)
        return {2 * node + 1, 2 * node + 2}


@dataclass
class FittedBoostedTrees:
    """A fitted model.  ``stage`` is a Spark ML stage that a PipelineModel saves and loads."""

    model: BoostedTrees

    @property
    def importances(self) -> list[float]:
        """Average gain of a feature's splits, as shares of 1."""
        m = self.model
        total, n = np.zeros(m.n_features), np.zeros(m.n_features)
        for t in m.trees:
            at = t.feature >= 0
            np.add.at(total, t.feature[at], t.gain[at])
            np.add.at(n, t.feature[at], 1)
        mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
        return (mean / mean.sum() if mean.sum() else mean).tolist()

    def expression(self) -> str:
        """The prediction as SQL: a walk down each tree, summed.

        The nodes of all trees are a few arrays, so parsing and planning the expression does not grow with the number
        of trees, as it does with one CASE a tree.  Trees are filled up to full depth: all below a leaf has its value.
        """
        m = self.model
        if not m.trees:
            return f"{m.base!r}D"
        feature, cut, value = (np.stack([getattr(t, k) for t in m.trees]) for k in ("feature", "cut", "value"))
        size = feature.shape[1]
        left = 2 * np.arange(size) + 1 + size * np.arange(len(m.trees))[:, None]  # a node's left child among all nodes
        for node in range(size // 2):
            ends = feature[:, node] < 0
            feature[ends, node] = 0
            for child in (2 * node + 1, 2 * node + 2):
                value[ends, child] = value[ends, node]
        held = lambda a, kind: _held(a.ravel().tolist(), kind)
        step = f"get({held(left, 'int')}, n) + if({m.array}[get({held(feature, 'int')}, n)] > get({held(cut, 'double')}, n), 1, 0)"
        leaf = f"aggregate(sequence(1, {m.depth}), root, (n, level) -> {step})" if m.depth else "root"
        return (f"aggregate(sequence(0, {size * (len(m.trees) - 1)}, {size}), {m.base!r}D, "
                f"(total, root) -> total + get({held(value, 'double')}, {leaf}))")

    def stage(self, output: str = "prediction") -> SQLTransformer:
        return SQLTransformer(statement=f"SELECT *, {self.expression()} AS {output} FROM __THIS__")

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stage().transform(df)


def cuts(df: DataFrame, label: str, array: str, max_bins: int) -> tuple[float, list[list[float]]]:
    """Mean label and each feature's cut candidates: all its values, or quantiles if it has many."""
    n = df.select(F.max(F.size(array))).first()[0] or 0
    probs = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    x = F.col(array)
    few = [F.array_sort(F.collect_set(x[i])) for i in range(n)]
    low = df.agg(F.avg(label).alias("mean"), *[F.approx_count_distinct(x[i]).alias(f"d{i}") for i in range(n)]).first()
    some = [i for i in range(n) if low[f"d{i}"] <= max_bins // 2]  # surely at most max_bins values
    got = df.agg(*[(few[i] if i in some else F.percentile_approx(x[i], probs, 10_000)).alias(f"e{i}")
                   for i in range(n)]).first() if n else []
    return float(low["mean"] or 0.0), [sorted(set(got[i] or [])) for i in range(n)]


def prepared(df: DataFrame, label: str, array: str, max_bins: int, seed: int,
             kept: dict | None = None) -> tuple[float, list[list[float]], DataFrame]:
    """Mean label, cut candidates and binned rows.  ``kept`` holds them for the next learner of the same table."""
    kept, key = {} if kept is None else kept, (label, array, max_bins, seed)
    if key not in kept:
        mean, edges = cuts(df, label, array, max_bins)
        kept[key] = mean, edges, binned(df, edges, label, array, seed)
    return kept[key]


def binned(df: DataFrame, edges: list[list[float]], label: str, array: str, seed: int) -> DataFrame:
    """Label, bins, number and hash of each labelled row, written once."""
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"),
        F.array(*[_bin(f"{array}[{i}]", e) for i, e in enumerate(edges)]).alias("b"),
        F.monotonically_increasing_id().alias("r"))
    return checkpoint(rows, "binned-rows").select("y", "b", "r", F.xxhash64("r", F.lit(seed)).alias("draw"))


def _held(values, kind: str) -> str:
    """A literal array as SQL, folded by Catalyst.

    Arrays are passed to generated code by reference, so other values mean the same code.
    """
    return f"cast(split('{','.join(map(repr, values))}', ',') AS array<{kind}>)"


def _bin(value: str, edges: list[float]) -> Column:
    """How many edges lie below the value, by binary search."""
    steps = [1 << i for i in reversed(range(len(edges).bit_length()))]
    if not steps:
        return F.lit(0).cast("smallint")
    found = f"aggregate({_held(steps, 'int')}, 0, (n, s) -> if(get({_held(edges, 'double')}, n + s - 1) < {value}, n + s, n))"
    return F.expr(f"cast({found} AS smallint)")


def _arrays(batches: Iterator[pa.RecordBatch], n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, bins (feature x row) and hashes of a task's rows in the order of their numbers."""
    y, b, r, draw = [np.empty(0)], [np.empty((0, n_features), dtype=np.int16)], [np.empty(0, dtype=int)], [np.empty(0, dtype=int)]
    for batch in batches:
        y.append(batch.column("y").to_numpy(zero_copy_only=False))
        b.append(batch.column("b").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features))
        r.append(batch.column("r").to_numpy(zero_copy_only=False))
        draw.append(batch.column("draw").to_numpy(zero_copy_only=False))
    order = np.argsort(np.concatenate(r), kind="stable")
    return (np.concatenate(y)[order], np.ascontiguousarray(np.concatenate(b)[order].T), np.concatenate(draw)[order].view(np.uint64))


def _drawn(draw: np.ndarray, turn: int) -> np.ndarray:
    """``xxhash64(..., turn)`` modulo DRAWS, given the hash of the columns before it."""
    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = (draw + p5 + np.uint64(4)) ^ (np.array([turn], dtype=np.uint64) * p1)
    h = (h << np.uint64(23) | h >> np.uint64(41)) * p2 + p3
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return (h ^ h >> np.uint64(32)) & np.uint64(DRAWS - 1)


def _leaf(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """The node of a tree, grown as far as it is, that each row (feature x row) reaches."""
    node, every = np.zeros(bins.shape[1], dtype=int), np.arange(bins.shape[1])
    while True:
        feature = tree.feature[node]
        if (feature < 0).all():
            return node
        node = np.where(feature < 0, node, 2 * node + 1 + (bins[feature, every] > tree.bin[node]))


def _fresh(bins: np.ndarray, trees: tuple[Tree, ...]) -> np.ndarray:
    """The sum of several trees' values for each row."""
    total = np.zeros(bins.shape[1])
    for tree in trees:
        total += tree.value[_leaf(bins, tree)]
    return total


def _histograms(bins: np.ndarray, g: np.ndarray, drawn: np.ndarray, tree: Tree, nodes: list[int],
                picked: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """(node, feature, bin, [sum of gradients, count]) of one block's drawn rows; features not picked stay 0."""
    size = max(map(len, edges)) + 1
    hist = np.zeros((len(nodes), len(edges), size, 2))
    node = _leaf(bins, tree)[drawn]
    slot = np.searchsorted(nodes, node)
    here = np.take(nodes, slot, mode="clip") == node
    rows, start = drawn[here], slot[here] * size
    weights = g[rows]
    for f in picked:
        at = start + bins[f, rows]
        hist[:, f, :, 0] = np.bincount(at, weights, len(nodes) * size).reshape(-1, size)
        hist[:, f, :, 1] = np.bincount(at, minlength=len(nodes) * size).reshape(-1, size)
    return hist
