"""Exact token ids with a bounded memo of words.

Where a tokenizer's pre-tokenizer always splits, the parts of a text are encoded apart, so a word that
comes again costs one dictionary lookup.  Texts outside the rules below go to the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from . import tokenizing

#: Words of a generation; two are held.
MEMO_WORDS = 600_000
MEMO_BYTES = 48
# Characters whose classes and case are alike in every Unicode version; single spaces and line feeds.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ \n]*")
# The tokenizer's pattern that this module knows, and what it finds in a plain text in lower case.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-įı-ſ]+|[0-9]|[^ \na-zß-öø-įı-ſ0-9]+")


def _parts_spaced(text: str) -> list[str] | None:
    """Parts of a byte-level tokenizer's text: a word takes the one space or line feed before it.

    None if white space meets white space in a way that the pre-tokenizer joins.
    """
    marked = text.replace("\n", " \n")
    if "  " in marked or "\n\n\n" in text or text[-1:] in (" ", "\n") or not _PLAIN.fullmatch(text):
        return None
    first, *rest = marked.split(" ")
    return ([first] if first else []) + [p if p[0] == "\n" else " " + p for p in rest]


class MemoEncoder:
    """text -> ids as the library gives them, without special tokens added."""

    def __init__(self, path_or_name: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizing.resolve(path_or_name)
        self.whole = tokenizing.encoder(path)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        # Byte-level with its own pattern keeps white space; a split that removes what it does not match drops it.
        self.spaced = steps[0]["type"] == "ByteLevel" and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]
        self.dropped = steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        # Lower case, parts by that pattern, and a last token that shows where a part ends.
        suffix = spec["model"].get("end_of_word_suffix")
        small = any(n["type"] == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", []))
        self.ends = None
        if self.dropped and suffix and small and steps[0]["pattern"].get("Regex") == _WORD_PATTERN:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo: dict = {}
        self.older: dict = {}

    def _encode(self, part: str) -> bytes:
        return np.array(self.whole(part), dtype=self.type).tobytes()

    def _bytes(self, text: str) -> list[bytes]:
        if any(a in text for a in self.added):
            return [self._encode(text)]
        if self.ends is not None and _PLAIN.fullmatch(text):
            parts = _WORDS.findall(text.lower())
        elif self.dropped:
            parts = text.encode("utf-8", "surrogatepass").split()  # at ASCII white space
        elif not self.spaced or (parts := _parts_spaced(text)) is None:
            return [self._encode(text)]
        memo = self.memo
        if unknown := set(parts).difference(memo):
            memo.update((p, self.older[p]) for p in unknown if p in self.older)
            if rest := [p for p in unknown if p not in memo]:
                memo.update(zip(rest, self._encode_apart(rest)))
        got = list(map(memo.__getitem__, parts))
        for p in unknown:
            if len(p) > MEMO_BYTES:
                del memo[p]
        if len(memo) > MEMO_WORDS:  # words not met again in one generation go with the next
            self.older, self.memo = memo, {}
        return got

    def _encode_apart(self, parts: list) -> list[bytes]:
        """Each part's ids, by one call: last tokens end the parts, or an added token between two keeps them apart."""
        texts = [p if isinstance(p, str) else p.decode("utf-8", "surrogatepass") for p in parts]
        if self.ends is not None and isinstance(parts[0], str):
            ids = np.array(self.whole(" ".join(texts)), dtype=self.type)
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) == len(texts) and at[-1] == len(ids):
                raw, width = ids.tobytes(), self.type.itemsize
                edges = [0, *(at * width).tolist()]
                return [raw[s:e] for s, e in zip(edges, edges[1:])]
        if self.added and len(texts) > 1:
            ids = np.array(self.whole(self.added[-1].join(texts)), dtype=self.type)
            at = np.flatnonzero(ids == self.tokenizer.token_to_id(self.added[-1]))
            if len(at) == len(texts) - 1:
                raw, width = ids.tobytes(), self.type.itemsize
                edges = [-1, *at.tolist(), len(ids)]
                return [raw[(s + 1) * width: e * width] for s, e in zip(edges, edges[1:])]
        return [self._encode(t) for t in texts]

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self._bytes(text)), dtype=self.type)

    def count(self, text: str) -> int:
        return sum(map(len, self._bytes(text))) // self.type.itemsize


_ENCODERS: dict[str, MemoEncoder] = {}


def encoder(path_or_name: str) -> MemoEncoder:
    """One per Python worker and tokenizer, so the memo outlives a task."""
    path = tokenizing.resolve(path_or_name)
    if path not in _ENCODERS:
        _ENCODERS[path] = MemoEncoder(path)
    return _ENCODERS[path]
