"""Quality rules as weak supervision.

Each rule votes good (1), bad (0) or abstains (-1) on a document.  Expectation-maximisation over the
counts of vote patterns estimates how often every rule gives each vote on good and on bad documents;
the posterior probability of being good then replaces an all-must-pass filter.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, per_text

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
          "n_bangs", "n_echo_words", "n_symbol_words", "n_symbol_runs"]
SCHEMA = ", ".join(f"{c} long" for c in COUNTS)
#: (rule, numerator, denominator, good at or below, bad at or above); between them the rule abstains.
RULES = [
    ("symbols", "n_symbols", "n_words", 0.02, 0.10),
    ("symbol_words", "n_symbol_words", "n_words", 0.01, 0.05),
    ("symbol_runs", "n_symbol_runs", "n_words", 0.005, 0.02),
    ("bangs", "n_bangs", "n_words", 0.02, 0.20),
    ("upper", "n_upper", "n_letters", 0.20, 0.50),
    ("repeats", "n_repeat_words", "n_words", 0.10, 0.30),
    ("echoes", "n_echo_words", "n_words", 0.05, 0.20),
    ("dup_lines", "n_dup_lines", "n_lines", 0.05, 0.60),
    ("word_length", "word_chars", "n_words", 12.0, 20.0),
]
#: The rules are written so that a good document seldom trips one: a prior on the false-alarm rates of so many documents
#: shaped like the start model.  It is fixed, so it washes out as the table grows; several rules look at one defect
#: (symbols, words that hold them, runs of them; repeats and echoes; upper case and bangs), so that the data can tell
#: a rule that fires on clean documents.
PRIOR_GOOD_ROWS = 1000.0
#: Bad documents may trip few of the rules: weak, so that a bad class with a single rule is possible.
PRIOR_BAD_ROWS = 5.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_ASCII_SPACE = " \t\n\v\f\r"
_ONE_SYMBOL = bytes.maketrans(SYMBOLS.encode(), b"#" * len(SYMBOLS))
_UPPER, _LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()


def repeated_words(words: list) -> int:
    """Words inside a 3-word window found twice or more in the text, the first such window included."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    first: dict = {}
    again: set = set()
    for i, g in enumerate(grams):
        if first.setdefault(g, i) != i:
            again.add(i)
            again.add(first[g])
    return len({p for i in again for p in (i, i + 1, i + 2)})


def describe(text: str) -> tuple:
    """The COUNTS of one text; words are runs without ASCII white space."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(_ASCII_SPACE)]
    n_upper = len(raw) - len(raw.translate(None, _UPPER))
    n_letters = n_upper + len(raw) - len(raw.translate(None, _LOWER))
    n_symbols = sum(map(text.count, SYMBOLS))
    marked = raw.translate(_ONE_SYMBOL) if n_symbols else b""
    return (len(words), len(text) - sum(map(text.count, _ASCII_SPACE)), n_symbols,
            len(lines) - len(set(lines)), repeated_words(words), len(lines), n_upper, n_letters, text.count("!"),
            sum(map(bytes.__eq__, words, words[1:])), sum(b"#" in w for w in marked.split()), marked.count(b"##"))


def counts(text: str | Column) -> Column:
    return per_text(SCHEMA, lambda: describe)(text)


def vote(c, rule) -> Column:
    """1 good, 0 bad, -1 abstain; a text without the denominator abstains."""
    _, num, den, good, bad = rule
    ratio = F.when(c[den] > 0, c[num].cast("double") / c[den])
    return F.when(ratio <= good, 1).when(ratio >= bad, 0).otherwise(-1)


def base_failed(c) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


@dataclass
class VoteModel:
    """prior: share of good documents; table[y][rule][vote]: how often a rule that votes gives a vote on class y.

    An abstention says nothing about the class.
    """

    prior: float
    table: np.ndarray

    def weights(self) -> np.ndarray:
        """rule x vote + 1: what a vote adds to the log odds of being good."""
        return np.pad(np.log(self.table[1]) - np.log(self.table[0]), ((0, 0), (1, 0)))

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        return (np.log(self.prior / (1 - self.prior))
                + self.weights()[np.arange(len(RULES)), votes + 1].sum(axis=-1))

    def posterior(self, c) -> Column:
        total = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for rule, (_, bad, good) in zip(RULES, self.weights()):
            v = vote(c, rule)
            total = total + F.when(v == 1, float(good)).when(v == 0, float(bad)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def start_model() -> VoteModel:
    """Before any data: one good document in 500 gets a rule's bad vote, of the bad ones a third."""
    return VoteModel(0.8, np.stack([np.tile([1 / 3, 2 / 3], (len(RULES), 1)),
                                    np.tile([0.002, 0.998], (len(RULES), 1))]))


def fit(patterns: np.ndarray, weights: np.ndarray, rounds: int = 500, tolerance: float = 1e-9,
        prior_rows: float = 20.0) -> VoteModel:
    """EM over distinct vote patterns (rows x rules) with their document counts.

    Documents shaped like the start model are mixed into every estimate (a Dirichlet prior), which keeps
    the meaning of the two classes and every probability positive: ``prior_rows`` for the share of good
    ones, PRIOR_BAD_ROWS and PRIOR_GOOD_ROWS for the votes of either class.
    No patterns: the start model.
    """
    model, start = start_model(), start_model()
    if not len(patterns):
        return model
    strength = np.array([PRIOR_BAD_ROWS, PRIOR_GOOD_ROWS])[:, None, None]
    onehot = np.stack([patterns == v for v in (0, 1)], axis=-1).astype(float)  # pattern, rule, vote
    for _ in range(rounds):
        good = 1 / (1 + np.exp(-model.log_odds(patterns)))
        mass = np.stack([weights * (1 - good), weights * good])
        sums = np.einsum("yp,prv->yrv", mass, onehot) + strength * start.table
        table = sums / sums.sum(axis=-1, keepdims=True)
        total = mass.sum(axis=1)
        last, model = model, VoteModel(float((total[1] + prior_rows * start.prior) / (total.sum() + prior_rows)), table)
        if max(np.abs(model.table - last.table).max(), abs(model.prior - last.prior)) < tolerance:
            break
    return model


def learn(described: DataFrame) -> VoteModel:
    """Fit on every described document (column ``_c``) that the base rules let pass; base failures go anyway.

    Only the counts of vote patterns reach the driver: at most 3^9 rows, whatever the input.
    """
    names = [r[0] for r in RULES]
    rows = (described.where(~base_failed(F.col("_c")))
            .groupBy(*[vote(F.col("_c"), r).alias(r[0]) for r in RULES]).count().orderBy(*names).collect())
    votes = np.array([[r[n] for n in names] for r in rows], dtype=int).reshape(len(rows), len(names))
    return fit(votes, np.array([r["count"] for r in rows], dtype=float))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, every vote, posterior, base_failed and kept, one row per row of ``docs``.

    NULL or empty texts have no words and fail the base rules; repeated rows are judged alike; an
    empty table gives an empty result.  Texts are read once: the counts are written and reread.
    """
    described = checkpoint(docs.select(F.col(id_col).alias("doc_id"), counts(text_col).alias("_c")), "quality-counts")
    model = learn(described)
    c = F.col("_c")
    return described.select(
        "doc_id", *[c[n].alias(n) for n in COUNTS[:5]], base_failed(c).alias("base_failed"),
        (~base_failed(c) & (model.posterior(c) >= threshold)).alias("kept"),
        model.posterior(c).alias("posterior"), *[vote(c, r).alias(f"vote_{r[0]}") for r in RULES])


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, that ``judge`` keeps.

    Two passes over the texts and no shuffle of them: one for the pattern counts, one to filter.
    """
    model = learn(docs.select(counts(text_col).alias("_c")))
    name = "_rule_counts"
    while name in docs.columns:
        name += "_"
    c = F.col(name)
    return (docs.withColumn(name, counts(text_col))
            .where(~base_failed(c) & (model.posterior(c) >= threshold)).drop(name))
