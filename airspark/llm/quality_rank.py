"""Quality classifier: Bradley-Terry scores learned from preference pairs.

A good document is preferred to a bad one.  With a linear score w.f(x), the Bradley-Terry likelihood of
a pair is logistic in w.(f(good) - f(bad)); the weights minimise that loss over pairs drawn from the
labels.  The decision threshold is a quantile of the learned documents' scores.  All labelled rows are learned from:
few on the driver, more by Spark jobs of which only sums reach it.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.median import exact_quantiles
from .common import checkpoint, fit_logistic, held_out, labelled, per_text, sigmoid

FEATURES = ["log_words", "word_length", "symbols", "bars", "bangs", "upper", "echoes", "distinct", "common", "stops",
            "digits", "line_words", "dup_lines", "long_words"]
#: So many labelled rows' features are fitted on the driver; Spark fits more.
DRIVER_ROWS = 20_000
#: Rows that are put in order by one task when rows are dealt into pairs.
DEAL_ROWS = 20_000
PAIRS_PER_GOOD = 4
CUT = 0.3
#: No feature is told apart more finely than this, so a nearly constant one gets no runaway weight.
LEAST_SCALE = 0.02
RIDGE = 1e-3
_UPPER, _DIGITS = string.ascii_uppercase.encode(), string.digits.encode()


def features(text: str) -> tuple[float, ...]:
    """Shape features of one text, each bounded or logarithmic; an empty text has all zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, size = len(words), len(raw)
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    symbols = size - len(raw.translate(None, b"#*$%&|<>"))
    length = sum(map(len, words)) / n
    top = max(seen.values())
    return (math.log1p(n) / 10, min(length, 40.0) / 10, min(symbols / n, 3.0), min(raw.count(b"|") / n, 1.0),
            min(raw.count(b"!") / n, 2.0), (size - len(raw.translate(None, _UPPER))) / size,
            sum(map(bytes.__eq__, words, words[1:])) / n, len(seen) / n, top / n,
            min((raw.count(b".") + raw.count(b",")) / n, 2.0),
            (size - len(raw.translate(None, _DIGITS))) / size, math.log1p(n / len(lines)) / 5,
            1 - len(set(lines)) / len(lines), sum(len(w) > 24 for w in words) / n)


def feature_column(text: str | Column) -> Column:
    return per_text("f array<double>", lambda: lambda t: (list(features(t)),))(text)["f"]


@dataclass
class RankModel:
    """score = w.f(x), features cut to the learned range; a document at ``threshold`` gets probability ``CUT``."""

    weights: np.ndarray
    threshold: float
    low: np.ndarray
    high: np.ndarray

    def probability(self, f: np.ndarray) -> float:
        score = np.clip(f, self.low, self.high) @ self.weights
        return float(sigmoid(score - self.threshold + math.log(CUT / (1 - CUT))))


def pairs(good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Preferred and other rows: PAIRS_PER_GOOD rounds, in each of which both classes are gone through whole."""
    rng = np.random.default_rng(7)
    n = max(len(good), len(bad))
    drawn = [(np.resize(rng.permutation(good), n), np.resize(rng.permutation(bad), n)) for _ in range(PAIRS_PER_GOOD)]
    return np.concatenate([a for a, _ in drawn]), np.concatenate([b for _, b in drawn])


def fit(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> RankModel:
    """Learn from feature rows and labels.

    Every good row is paired with PAIRS_PER_GOOD bad rows dealt in a fixed shuffled order, so no class
    is crossed with the other.  The threshold is the score quantile at the share of bad labels.
    Without both labels nothing can be ranked: every document scores just at the share of good ones.
    """
    order = np.argsort(ids, kind="stable")
    x, y = x[order], y[order]
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        share = min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99)
        flat = np.zeros(len(FEATURES))
        return RankModel(flat, math.log(CUT / (1 - CUT)) - math.log(share / (1 - share)), flat, flat)
    firsts, seconds = pairs(good, bad)
    diff = x[firsts] - x[seconds]
    scale = np.maximum(x.std(axis=0), LEAST_SCALE)
    both = np.concatenate([diff, -diff]) / scale  # each pair as seen from either side
    w = fit_logistic(both, np.repeat([1.0, 0.0], len(diff)), ridge=RIDGE) / scale
    scores = x @ w
    # The quantile level that the labels give: the share of bad documents, read between the two neighbours.
    return RankModel(w, float(np.quantile(scores, len(bad) / len(y), method="midpoint")), x.min(axis=0), x.max(axis=0))


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """(round, label, rank, f): each class in a shuffled order, another in each of PAIRS_PER_GOOD rounds, ranks from 0.

    Rows are ordered by a hash, inside a share of its range; the shares' counts give where each share begins.
    """
    shares = -(-n // DEAL_ROWS)
    drawn = rows.select("doc_id", "label", "f", F.explode(F.sequence(F.lit(0), F.lit(PAIRS_PER_GOOD - 1))).alias("round"))
    drawn = drawn.withColumn("draw", F.xxhash64("doc_id", "round")).withColumn("share", F.shiftrightunsigned("draw", 33) % shares)
    counts = drawn.groupBy("round", "label", "share").agg(F.count(F.lit(1)).alias("n"))
    begins = counts.select("round", "label", "share", (F.sum("n").over(W.partitionBy("round", "label").orderBy("share")) - F.col("n")).alias("begin"))
    place = F.row_number().over(W.partitionBy("round", "label", "share").orderBy("draw", "doc_id", "f"))
    return (drawn.withColumn("place", place).join(F.broadcast(begins), ["round", "label", "share"])
            .select("round", "label", (F.col("begin") + F.col("place") - 1).alias("rank"), "f"))


def _sums(w: np.ndarray, scale: np.ndarray):
    """One Newton step's sums over a task's pairs: gradient, then Hessian."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grad, hess = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for b in batches:
            x = (np.array(b["good"].tolist()) - np.array(b["bad"].tolist())).reshape(-1, len(w)) / scale
            p = sigmoid(x @ w)
            grad += x.T @ (p - 1)
            hess += (x * (p * (1 - p))[:, None]).T @ x
        yield pd.DataFrame({"sums": [np.concatenate([grad, hess.ravel()])]})
    return run


def fit_spread(rows: DataFrame, n: int, n_bad: int) -> RankModel:
    """``fit`` as Spark jobs over written (doc_id, label, f): the same loss over pairs dealt by a hash, the exact quantile.

    A pair seen from its other side adds the same gradient and Hessian, so one side is enough.
    """
    size = len(FEATURES)
    each = [F.col("f")[i] for i in range(size)]
    seen = rows.agg(F.array(*map(F.stddev_pop, each)).alias("scale"), F.array(*map(F.min, each)).alias("low"),
                    F.array(*map(F.max, each)).alias("high")).first()
    scale = np.maximum(seen["scale"], LEAST_SCALE)
    fewer = min(n_bad, n - n_bad)
    ranked = checkpoint(dealt(rows, n).withColumn("key", F.col("rank") % fewer), "quality-ranked")
    good, bad = (ranked.where(F.col("label") == y).select("round", "key", F.col("f").alias(name)) for y, name in ((1, "good"), (0, "bad")))
    # The class with fewer rows has each key once.
    drawn = checkpoint(good.join(bad, ["round", "key"]).select("good", "bad"), "quality-pairs")
    pairs_n, w = PAIRS_PER_GOOD * max(n_bad, n - n_bad), np.zeros(size)
    for _ in range(50):
        sums = sum(np.array(r["sums"]) for r in drawn.mapInPandas(_sums(w, scale), "sums array<double>").collect()) / pairs_n
        step = np.linalg.solve(sums[size:].reshape(size, size) + RIDGE * np.eye(size), sums[:size] + RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    w = w / scale

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"s": [float(np.array(f) @ w) for f in b["f"]]})

    at = (n - 1) * n_bad / n
    ends = sorted({math.floor(at) / (n - 1), math.ceil(at) / (n - 1)})
    found = exact_quantiles(rows.select("f").mapInPandas(scores, "s double"), ["s"], ends)["s"]
    return RankModel(w, sum(found[p] for p in ends) / len(ends), np.array(seen["low"]), np.array(seen["high"]))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", modulus: int = 5, remainder: int = 0, driver_rows: int = DRIVER_ROWS) -> RankModel:
    """Fit on all labelled documents that are not held out."""
    known = labelled(labels, label_col, modulus, remainder)
    # Features first: they are far narrower than texts, should the join shuffle.
    rows = (docs.select(F.col(id_col).alias("doc_id"), feature_column(text_col).alias("f"))
            .join(known, "doc_id").select("doc_id", "label", "f"))
    rows = checkpoint(rows, "quality-features")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n, n_bad = sum(counts.values()), counts.get(0, 0)
    if n > driver_rows and 0 < n_bad < n:
        return fit_spread(rows, n, n_bad)
    if n > driver_rows:  # one label alone: a row says all that is learned
        rows = rows.limit(1)
    rows = rows.collect()
    return fit(np.array([r["f"] for r in rows]).reshape(len(rows), len(FEATURES)),
               np.array([r["label"] for r in rows], dtype=float), np.array([r["doc_id"] for r in rows]))


def probability_column(model: RankModel, text: str | Column) -> Column:
    def make():
        return lambda t: (model.probability(np.array(features(t))),)
    return per_text("p double", make)(text)["p"]


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          modulus: int = 5, remainder: int = 0, driver_rows: int = DRIVER_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; NULL texts are scored as empty ones.

    Labels serve learning only; texts are read once to learn and once to score, and are never shuffled.  Repeated rows score alike; an empty table gives an empty result.
    """
    model = learn(docs, labels, id_col, text_col, "quality", modulus, remainder, driver_rows)
    return (docs.select(F.col(id_col).alias("doc_id"), probability_column(model, F.col(text_col)).alias("score"))
            .select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: RankModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, whose probability reaches CUT."""
    name = "_rank_score"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, probability_column(model, F.col(text_col))).where(F.col(name) >= CUT).drop(name)
