"""SentencePiece encoding and decoding by an Aho-Corasick automaton over the pieces.

One pass over a word's characters: at each position the automaton's output links give every piece that
ends there, and each is relaxed against what is known at the piece's start.

* Unigram models: the relaxation keeps the best sum of scores (Viterbi).
* BPE models have no additive score; a word's BPE encoding is the only path whose neighbouring pieces all
  stay apart when merged alone.  A step scores 0 if its piece does so behind the best path's last piece and
  minus infinity if not; the best sum is the library's encoding.

Words are cut where no piece can straddle: before a space, and between a letter and a sign that no piece of the model
joins.  Equal ones are encoded once per task (bounded memo).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from math import inf

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .tokenizing import resolve

SPACE = "▁"
#: Words of a generation; two are held.
MEMO_WORDS = 400_000
MEMO_CHARS = 64
MEMO_PAIRS = 300_000
#: Letters and signs between which words are cut if no piece of the model joins the two.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,!?;:#*$%&|<>()"


#: Model types in a model file.
UNIGRAM, BPE = 1, 2


def model_type(path: str) -> int:
    """The type that the model file states (trainer specification, field 3; unigram if it says nothing)."""
    def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                byte = raw[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(raw):
            key = number()
            if key & 7 == 0:
                yield key >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(key & 7) or number()
                yield key >> 3, raw[at: at + size]
                at += size

    with open(path, "rb") as f:
        spec = [v for k, v in fields(f.read()) if k == 2]
    return next((v for raw in spec for k, v in fields(raw) if k == 3), UNIGRAM)


class PieceCodec:
    def __init__(self, model: str = "piece_bpe_32k.model"):
        import sentencepiece
        path = resolve(model)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalise = sentencepiece.SentencePieceNormalizer(model_file=path).normalize
        self.names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.unknown = sp.unk_id()
        self.special = {i for i in range(len(self.names)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = {i: int(self.names[i][3:5], 16) for i in range(len(self.names)) if sp.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.score = {p: sp.get_score(i) for i, p in enumerate(self.names)
                      if i not in self.special and i not in self.bytes}
        self.ids = {p: i for i, p in enumerate(self.names) if p in self.score}
        self._raw = [bytes([self.bytes[i]]) if i in self.bytes else " ⁇ ".encode() if i == self.unknown
                     else b"" if i in self.special else p.encode() for i, p in enumerate(self.names)]
        self.is_bpe = model_type(path) == BPE
        self.automaton = ahocorasick.Automaton()
        for p in self.score:
            self.automaton.add_word(p, (len(p), p, {}))  # the last one: whether it stays apart behind a piece
        self.automaton.make_automaton()
        # Pieces of spaces alone are the only ones with a space after their first character.
        spaces_alone = all(SPACE not in p[1:] or not p.strip(SPACE) for p in self.score)
        self._words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") if spaces_alone else None
        joined = re.compile(f"[{LETTERS}]([{re.escape(SIGNS)}])|([{re.escape(SIGNS)}])[{LETTERS}]")
        sticky = {c for p in self.score for pair in joined.findall(p) for c in pair if c}
        apart = re.escape("".join(c for c in SIGNS if c not in sticky))
        # Unknown characters that meet become one unknown piece, unless they are written as bytes.
        self._cuts = re.compile(f"(?<=[{LETTERS}])(?=[{apart}])|(?<=[{apart}])(?=[{LETTERS}])") if apart and self.byte_ids else None
        singles = "".join(map(re.escape, sorted(p for p in self.score if len(p) == 1)))
        self._strangers = re.compile(f"([^{singles}])")
        self._pairs = 0
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    # BPE on a short string, by merging the best pair first and the leftmost among equals.
    def _merge(self, text: str) -> list[str]:
        parts, score = list(text), self.score.get
        if len(parts) <= 24:  # short: look through all pairs again after each merge
            pairs = [score(a + b, -inf) for a, b in zip(parts, parts[1:])]
            while pairs and (top := max(pairs)) > -inf:
                i = pairs.index(top)
                parts[i: i + 2] = [parts[i] + parts[i + 1]]
                del pairs[i]
                if i < len(pairs):
                    pairs[i] = score(parts[i] + parts[i + 1], -inf)
                if i:
                    pairs[i - 1] = score(parts[i - 1] + parts[i], -inf)
            return parts
        nxt, prv = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        alive = [True] * len(parts)
        heap: list = []

        def offer(i):
            j = nxt[i]
            if j < len(parts) and (s := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if alive[i] else len(parts)
            if not alive[i] or j >= len(parts) or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], nxt[i] = a + b, False, nxt[j]
            if nxt[j] < len(parts):
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return [p for p, ok in zip(parts, alive) if ok]

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether ``a`` then ``b`` is the encoding of their joined text."""
        return a + b not in self.score and self._merge(a + b) == [a, b] if a else self._merge(b) == [b]

    def _judge(self, before: str, piece: str, known: dict) -> bool:
        """``_stay_apart``, kept with the piece; all is forgotten when too many pairs are known."""
        self._pairs += 1
        if self._pairs > MEMO_PAIRS:
            self._pairs = 1
            for _, _, pairs in self.automaton.values():
                pairs.clear()
        known[before] = fits = self._stay_apart(before, piece)
        return fits

    def _path(self, word: str) -> list[str]:
        """The pieces of a word whose every character is a piece."""
        last: list = [""] * (len(word) + 1)  # last piece of the best path that ends at a position
        best = [-inf] * (len(word) + 1)
        best[0] = 0.0
        if self.is_bpe:  # a step scores 0 if its piece stays apart from the one before, else it is barred
            for end, (size, piece, known) in self.automaton.iter(word):
                at = end + 1
                if best[at - size] > best[at]:
                    before = last[at - size]
                    fits = known.get(before)
                    if fits or fits is None and self._judge(before, piece, known):
                        best[at], last[at] = best[at - size], piece
        else:
            for end, (size, piece, _) in self.automaton.iter(word):
                s = best[end + 1 - size] + self.score[piece]
                if s > best[end + 1]:
                    best[end + 1], last[end + 1] = s, piece
        out, at = [], len(word)
        while at > 0:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _word_ids(self, word: str) -> bytes:
        ids: list[int] = []
        # A character that is no piece stands alone, as bytes or as the unknown piece.
        for i, part in enumerate(self._strangers.split(word)):
            if i % 2 == 0:
                ids += map(self.ids.__getitem__, self._path(part))
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return np.array(ids, dtype=np.int32).tobytes()

    def _known_ids(self, part: str) -> bytes:
        ids = self._memo.get(part) or self._older.get(part)
        if ids is None:
            ids = self._word_ids(part)
            if len(part) <= MEMO_CHARS:
                self._memo[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        text = self.normalise(text)
        words = self._words.findall(text) if self._words else [text]
        memo = self._memo
        got = list(map(memo.get, words))
        for i, known in enumerate(got):
            if known is None:
                w = words[i]
                parts = self._cuts.split(w) if self._cuts else ()
                got[i] = b"".join(map(self._known_ids, parts)) if len(parts) > 1 else self._known_ids(w)
                if len(w) <= MEMO_CHARS:
                    memo[w] = got[i]
        if len(memo) > MEMO_WORDS:  # words not met again in one generation go with the next
            self._older, self._memo = memo, {}
        return np.frombuffer(b"".join(got), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: pieces joined, byte pieces as UTF-8, the first space mark dropped."""
        text = b"".join(map(self._raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_CODECS: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    if model not in _CODECS:
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


OUT_ROWS = 256


def round_trip(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
               text_col: str = "text", decoded: bool = True) -> DataFrame:
    """doc_id, ids, n_ids and, unless told not to, the text decoded from the ids, for every row.

    A NULL or empty text has no ids and decodes to an empty text.  Repeated rows repeat.  One pass, and a
    task's worker holds the results of OUT_ROWS texts at a time.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for b in batches:
            for s in range(0, len(b), OUT_ROWS):
                part = b.iloc[s: s + OUT_ROWS]
                ids = [c.encode(t) for t in part["text"]]
                out = {"doc_id": part["doc_id"], "ids": ids, "n_ids": [len(x) for x in ids]}
                if decoded:
                    out["decoded"] = [c.decode(x.tolist()) for x in ids]
                yield pd.DataFrame(out)

    # Ids pass as text: pandas would turn a column of longs with NULLs into doubles.
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), text_or_empty(text_col).alias("text"))
    done = texts.mapInPandas(run, "doc_id string, ids array<int>, n_ids long" + ", decoded string" * decoded)
    return done.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, ids, n_ids: ``round_trip`` without the decoded text."""
    return round_trip(docs, model, id_col, text_col, decoded=False)


def _decoded(model: str, ids) -> F.Column:
    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        c = codec(model)
        return pd.Series([c.decode([] if x is None else x.tolist()) for x in ids], dtype=object)
    return text(ids)


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """doc_id, text for every row; NULL ids give an empty text."""
    return encoded.select(F.col(id_col).alias("doc_id"), _decoded(model, F.col(ids_col)).alias("text"))
