"""Line dedup by winnowing.

A text is the sequence of its lines that hold a word, each with a 64-bit hash and its word count.  At each
line starts a gram: the shortest run of lines with at least NOISE words.  In every window (the shortest run
with at least GUARANTEE words) the smallest gram hash is selected, so nothing under NOISE words is ever
matched.  Besides, the windows themselves are marks: from every line the shortest run onwards, and to every
line the shortest run back, with at least GUARANTEE words.  Each mark's occurrences are joined to its first one
(smallest doc_id, then position); the match is extended line by line both ways, and the later run is deleted.

Every line of a run of GUARANTEE words or more that an earlier place also holds lies in a window inside the
run, so it meets an earlier text with all of that window and goes, however often its grams occur elsewhere.
The first occurrence of every mark stays, and a deleted line always has an equal one at an earlier place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, mix64, per_text, text_or_empty

NOISE = 25
GUARANTEE = 50
_SPACE = b" \t\n\v\f\r"


def line_hashes(lines: list[bytes]) -> np.ndarray:
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(x) for x in lines], dtype=np.uint64)


def worded_lines(text: str) -> tuple[list[int], list[bytes]]:
    """Places (among all lines) and stripped contents of the lines that hold a word."""
    lines = [x.strip(_SPACE) for x in text.encode("utf-8", "surrogatepass").split(b"\n")]
    at = [i for i, x in enumerate(lines) if x]
    return at, [lines[i] for i in at]


def run_ends(words: np.ndarray, least: int) -> np.ndarray:
    """For each line the end (exclusive) of the shortest run from it with ``least`` words; 0 if none."""
    total = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(total, total[:-1] + least, side="left")
    return np.where(ends <= len(words), ends, 0)


def grams(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each line's gram."""
    return run_hashes(hashes, np.arange(len(hashes)), ends)


def run_hashes(hashes: np.ndarray, start: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run: a polynomial of its lines' hashes in prefix sums (arithmetic modulo 2^64)."""
    n = len(hashes)
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, dtype=np.uint64), dtype=np.uint64)])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes) * powers[:n], dtype=np.uint64)])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    undo = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse, dtype=np.uint64), dtype=np.uint64)])
    value = (sums[np.maximum(ends, start)] - sums[start]) * undo[start]
    return mix64(value ^ (ends - start).astype(np.uint64))


def winnow(hashes: np.ndarray, words: np.ndarray, noise: int = NOISE, guarantee: int = GUARANTEE) -> list[tuple[int, int]]:
    """(line, gram hash) of the selected grams: the rightmost smallest of each window."""
    n = len(hashes)
    if not n or int(words.sum()) < guarantee:
        return []
    ends, windows = run_ends(words, noise), run_ends(words, guarantee)
    value = grams(hashes, ends)
    chosen: dict[int, int] = {}
    queue: list[int] = []  # candidate grams of the window, hashes ascending
    head, nxt = 0, 0
    for i in range(n):
        if not windows[i]:
            break
        while nxt < n and ends[nxt] and ends[nxt] <= windows[i]:
            while len(queue) > head and value[queue[-1]] >= value[nxt]:
                queue.pop()
            queue.append(nxt)
            nxt += 1
        while queue[head] < i:
            head += 1
        chosen[queue[head]] = int(value[queue[head]])
    return list(chosen.items())


def windows(hashes: np.ndarray, words: np.ndarray, guarantee: int = GUARANTEE) -> tuple[np.ndarray, np.ndarray]:
    """Start lines and hashes of the shortest runs with ``guarantee`` words from each line on and up to each line."""
    n = len(hashes)
    ends = run_ends(words, guarantee)
    back = n - run_ends(words[::-1], guarantee)[::-1]  # n: no run ends with this line
    onwards, upto = np.flatnonzero(ends), np.flatnonzero(back < n)
    upto = upto[ends[back[upto]] != upto + 1]  # the others are runs onwards too
    start, end = np.concatenate([onwards, back[upto]]), np.concatenate([ends[onwards], upto + 1])
    return start, run_hashes(hashes, start, end)


def _describe(text: str) -> tuple:
    _, lines = worded_lines(text)
    hashes = line_hashes(lines)
    words = np.array([len(x.split()) for x in lines], dtype=np.int64)
    picked = winnow(hashes, words)
    at, value = windows(hashes, words)
    signed = hashes.view(np.int64)
    marks = np.concatenate([np.array([h for _, h in picked], dtype=np.uint64), value]).view(np.int64)
    return signed.tolist(), words.tolist(), [p for p, _ in picked] + at.tolist(), marks.tolist()


def extend(own: np.ndarray, near: np.ndarray, diagonal: int, seeds: list[int], words: np.ndarray,
           noise: int = NOISE) -> list[tuple[int, int]]:
    """[start, end) in ``own`` of the runs through ``seeds`` where own[i] equals the other text's line i + diagonal.

    ``near`` holds the other text's lines from max(diagonal, 0) on.  Runs under ``noise`` words (a hash
    collision) are left out.
    """
    low = max(0, -diagonal)
    size = min(len(own) - low, len(near))
    equal = own[low: low + size] == near[:size]
    breaks = np.concatenate([[-1], np.flatnonzero(~equal), [size]])
    runs = set()
    for seed in seeds:
        at = seed - low
        if 0 <= at < size and equal[at]:
            k = np.searchsorted(breaks, at)
            runs.add((int(breaks[k - 1]) + 1 + low, int(breaks[k]) + low))
    return sorted((s, e) for s, e in runs if int(words[s:e].sum()) >= noise)


def _extend_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for i, digest, lines, words, near, d, seeds in zip(b["id"], b["digest"], b["lines"], b["words"], b["near"],
                                                           b["diagonal"], b["seeds"]):
            rows += [(i, digest, s, e) for s, e in extend(np.asarray(lines), np.asarray(near), int(d),
                                                          [int(x) for x in seeds], np.asarray(words))]
        yield pd.DataFrame(rows, columns=["id", "digest", "start", "end"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that repeat both id and text are one document; a NULL id is the empty one, after all others."""
    text = text_or_empty(text_col)
    return docs.select("*", F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__id"),
                       F.xxhash64(text).alias("__digest"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest, runs: for each document with repeated later runs their [start, end) in worded lines."""
    place = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("doc"))
    described = (_keyed(docs, id_col, text_col)
                 .select(F.col("__id").alias("id"), F.col("__digest").alias("digest"), place.alias("place"),
                         per_text("lines array<long>, words array<long>, pos array<long>, gram array<long>",
                                  lambda: _describe)(text_col).alias("d"))
                 .select("id", "digest", "place", "d.*"))
    described = checkpoint(described.where(F.size("pos") > 0).dropDuplicates(["id", "digest"]), "line-hashes")
    marks = described.select("id", "digest", "place", F.inline(F.arrays_zip("pos", "gram")))
    firsts = (marks.groupBy("gram")
              .agg(F.min(F.struct("place", "digest", "pos", "id")).alias("first"), F.count("*").alias("n"))
              .where(F.col("n") > 1).select("gram", "first"))
    same = (F.col("id") == F.col("first.id")) & (F.col("digest") == F.col("first.digest"))
    matches = checkpoint(
        marks.join(firsts, "gram").where(~(same & (F.col("pos") == F.col("first.pos"))))
        .groupBy("id", "digest", F.col("first.id").alias("f_id"), F.col("first.digest").alias("f_digest"),
                 (F.col("first.pos") - F.col("pos")).alias("diagonal"))
        .agg(F.collect_list("pos").alias("seeds")), "line-matches")  # at most a document's own grams
    lines = described.select("id", "digest", "lines", "words")
    others = described.select(F.col("id").alias("f_id"), F.col("digest").alias("f_digest"),
                              F.col("lines").alias("f_lines"))
    # Of the other text only the lines that can meet an own line go on.
    near = F.slice("f_lines", F.greatest(F.col("diagonal"), F.lit(0)).cast("int") + 1, F.size("lines"))
    runs = (matches.join(lines, ["id", "digest"]).join(others, ["f_id", "f_digest"])
            .select("id", "digest", "lines", "words", near.alias("near"), "diagonal", "seeds")
            .mapInPandas(_extend_all, "id string, digest long, start long, end long"))
    return runs.groupBy("id", "digest").agg(F.collect_set(F.struct("start", "end")).alias("runs"))


def drop_runs(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the runs' lines; lines and words deleted.  Blank lines stay."""
    at, lines = worded_lines(text)
    gone = sorted({i for s, e in runs for i in range(s, min(e, len(at)))})
    drop = {at[i] for i in gone}
    kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
    return kept, len(gone), sum(len(lines[i].split()) for i in gone)


def _dropped(text, runs) -> F.Column:
    @F.pandas_udf("text string, n_lines long, n_words long")
    def dropped(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = [(None, 0, 0) if t is None else drop_runs(t, [(int(r["start"]), int(r["end"])) for r in rs])
                for t, rs in zip(text, runs)]
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_words"])
    return dropped(text, runs)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: bool = False) -> DataFrame:
    """The rows of ``docs`` without repeated later runs; with ``report`` also removed_lines and removed_words.

    Every row stays, with all its columns; NULL texts stay NULL; a text all of whose lines are repeats
    becomes its blank lines or empty; an ``n_chars`` column follows the text.  Rows that repeat both id
    and text count as one document and are cleaned alike.  Lines are compared without the white space
    around them.  A gram of a third of all documents is one row per document in joins whose other side has
    one row per gram or document, so Spark can split it; nothing pairs the documents that share it.
    """
    names = docs.columns
    runs = repeated_runs(docs, id_col, text_col).select(F.col("id").alias("__id"), F.col("digest").alias("__digest"),
                                                        F.col("runs").alias("__runs"))
    text = F.col(f"`{text_col}`")
    found = (_keyed(docs, id_col, text_col).join(runs, ["__id", "__digest"], "left")
             .withColumn("__new", _dropped(F.when(F.col("__runs").isNotNull(), text), F.col("__runs"))))
    cleaned = F.coalesce(F.col("__new.text"), text)
    out = {text_col: cleaned}
    if "n_chars" in names:
        out["n_chars"] = F.when(F.col("__runs").isNull(), F.col("n_chars")).otherwise(F.length(cleaned)).cast(
            docs.schema["n_chars"].dataType)
    more = [F.col("__new.n_lines").alias("removed_lines"), F.col("__new.n_words").alias("removed_words")] * report
    return found.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in names], *(more if report else []))
