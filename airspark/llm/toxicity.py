"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digits and signs written for letters), the lexicon's entries
are found by an Aho-Corasick automaton in one pass, hits inside exception phrases do not count, and the
weight found is normalised by text length.  Entries, weights and exceptions are learned from labels; more
can be given.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, fit_logistic, held_out, label_sample, per_text, sigmoid, text_or_empty

CUT = 0.3
#: Expected number of labelled rows that are learned from; the others are only scored.
SAMPLE_ROWS = 20_000
#: Lengths of word beginnings that may become entries beside whole words.
STEMS = (4, 5, 6, 7, 8)
MIN_DOCS = 5          # learned documents an entry must be seen in
MIN_SHARE = 0.85      # and the share of them that must be toxic
MIN_STEM_DOCS, MIN_STEM_SHARE = 8, 0.95  # the same for word beginnings, which clean words may share
MIN_SURPRISE = 20.0   # and how unlikely that must be by chance (log-likelihood ratio)
_LOOKALIKES = ("аa бb вb гr еe зe иu кk мm нh оo пn рp сc тt уy хx ѕs іi јj ԁd ԛq ԝw αa βb εe ηn ικ κk νv οo ρp τt υu χx "
               "ıi łl øo đd ßs 0o 1i 3e 4a 5s 7t @a $s")
_FOLD = str.maketrans({pair[0]: pair[1] for pair in _LOOKALIKES.split() if len(pair) == 2})
_GAP = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Words of letters with single spaces between and around them; an empty text gives one space."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()  # accents stay: they tell words apart
    return " " + _GAP.sub(" ", text.translate(_FOLD)).strip() + " "


@dataclass
class Lexicon:
    """entries: " word " (whole word) or " stem" (word beginning) -> weight; exceptions: folded phrases."""

    entries: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, ...] = (-4.0, 1.0, 0.0)

    def automaton(self):
        a = ahocorasick.Automaton()
        for e, w in self.entries.items():
            a.add_word(e, (len(e), w))
        for p in self.exceptions:
            a.add_word(p, (len(p), None))
        if len(a):
            a.make_automaton()
        return a


def evidence(folded: str, automaton) -> tuple[float, ...]:
    """(1, length-normalised weight, heaviest hit) of a folded text.

    A word counts once, at its heaviest entry, and not at all inside an exception phrase.
    """
    hits: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    if len(automaton):
        for end, (size, weight) in automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            else:
                hits[start] = max(weight, hits.get(start, 0.0))
    if spared:
        # Phrase spans share their end spaces with their neighbours; a hit lies inside if its word does.
        spared.sort()
        starts, reach = np.array([s for s, _ in spared]), np.maximum.accumulate([e for _, e in spared])
        at = np.array(sorted(hits), dtype=int)
        k = np.searchsorted(starts, at, side="right") - 1
        hits = {int(p): hits[int(p)] for p, j in zip(at, k) if j < 0 or p >= reach[j]}
    total = sum(hits.values())
    words = max(folded.count(" ") - 1, 1)
    return 1.0, total / math.sqrt(words), max(hits.values(), default=0.0)


def _entries(folded: str) -> set[str]:
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for n in STEMS for w in words if len(w) > n}


def _count_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pre-aggregate inside a batch: (entry, toxic documents, clean documents)."""
    for b in batches:
        toxic, clean = Counter(), Counter()
        for t, y in zip(b["folded"], b["label"]):
            (toxic if y else clean).update(_entries(t))
        names = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"entry": names, "toxic": [toxic[n] for n in names], "clean": [clean[n] for n in names]})


def _count_phrases(entries: dict[str, float]):
    """Two-word phrases around whole-word entries: (phrase, toxic documents, clean documents)."""
    words = {e.strip() for e in entries}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            toxic, clean = Counter(), Counter()
            for t, y in zip(b["folded"], b["label"]):
                w = t.split()
                found = {f" {p} {q} " for p, q in zip(w, w[1:]) if p in words or q in words}
                (toxic if y else clean).update(found)
            names = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"entry": names, "toxic": [toxic[n] for n in names],
                                "clean": [clean[n] for n in names]})
    return run


def _sums(counted: DataFrame) -> DataFrame:
    return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _surprise(toxic: Column, clean: Column, n1: float, n0: float) -> Column:
    """Log-likelihood ratio of toxic:clean among the entry's documents against all documents."""
    n = toxic + clean
    share = n1 / (n1 + n0)
    part = lambda k, e: F.when(k > 0, k * F.log(k / (n * e))).otherwise(0.0)
    return 2 * (part(toxic, share) + part(clean, 1 - share))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", modulus: int = 4, remainder: int = 2, bound: int = SAMPLE_ROWS,
          more_entries: dict[str, float] | None = None, more_exceptions: list[str] | None = None) -> Lexicon:
    """Learn entries, weights, exceptions and the scale from a bounded sample of labelled documents.

    Documents with the same folded text count once, with the label that most of them have (toxic, if as many
    have either), so a word of one much copied document is no evidence; others that share lines all count.
    Only accepted entries reach the driver; each needs MIN_DOCS of the sample's documents.
    """
    sample = label_sample(labels, label_col, modulus, remainder, bound)
    folded = per_text("folded string", lambda: lambda t: (fold(t),))
    rows = (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
            .select("label", folded("text")["folded"].alias("folded"))
            .groupBy("folded").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    rows = checkpoint(rows, "toxicity-sample")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = float(n.get(1, 0)), float(n.get(0, 0))
    entries: dict[str, float] = {}
    if n1 and n0:
        counted = _sums(rows.mapInPandas(_count_entries, "entry string, toxic long, clean long"))
        t, c = F.col("toxic"), F.col("clean")
        whole = F.col("entry").endswith(" ")
        good = counted.where((t + c >= F.when(whole, MIN_DOCS).otherwise(MIN_STEM_DOCS))
                             & (t >= F.when(whole, MIN_SHARE).otherwise(MIN_STEM_SHARE) * (t + c))
                             & (_surprise(t, c, n1, n0) >= MIN_SURPRISE))
        for r in good.collect():
            entries[r["entry"]] = math.log((r["toxic"] + 0.5) / (n1 + 1)) - math.log((r["clean"] + 0.5) / (n0 + 1))
    entries |= {fold(e): w for e, w in (more_entries or {}).items()}
    exceptions = [fold(e) for e in more_exceptions or []]
    if entries and n1 and n0:
        # A phrase around an entry that is as clean as any text is an exception.
        t, c = F.col("toxic"), F.col("clean")
        phrases = _sums(rows.mapInPandas(_count_phrases(entries), "entry string, toxic long, clean long"))
        exceptions += [r["entry"] for r in phrases.where((c >= MIN_DOCS) & (t <= c * n1 / n0)).collect()]
    lexicon = Lexicon(entries, sorted(set(exceptions)))

    def make():
        a = lexicon.automaton()
        return lambda t: (list(evidence(t, a)),)

    seen = rows.select("label", per_text("x array<double>", make)("folded")["x"].alias("x")).collect()
    if seen:
        lexicon.coefficients = tuple(fit_logistic(np.array([r["x"] for r in seen]),
                                                  np.array([r["label"] for r in seen], dtype=float), ridge=1e-3))
    return lexicon


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          modulus: int = 4, remainder: int = 2, bound: int = SAMPLE_ROWS, lexicon: Lexicon | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; NULL and empty texts score as texts without hits.

    Repeated rows score alike; an empty table gives an empty result; without labels of both kinds the
    lexicon is empty and all rows share one score.
    """
    lexicon = lexicon or learn(docs, labels, id_col, text_col, "toxic", modulus, remainder, bound)

    def make():
        a, w = lexicon.automaton(), np.array(lexicon.coefficients)
        return lambda t: (float(sigmoid(np.dot(w, evidence(fold(t), a)))),)

    return (docs.select(F.col(id_col).alias("doc_id"), per_text("p double", make)(text_col)["p"].alias("score"))
            .select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted")))
