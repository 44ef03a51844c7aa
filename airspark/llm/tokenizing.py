"""Bounded-memory use of the public tokenizers inside tasks.

Tokenizer files are read where the task runs, from ``public_tokenizers.path(name)`` or a given
path; nothing is copied into the repository.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable

#: Longer texts are encoded in pieces of about so many characters.
PIECE_CHARS = 1 << 17
# Between an ASCII letter and " letter" both tokenizers' pre-tokenizers always split, no added
# token's text can straddle the cut, and normalisation acts on each side alone.
_CUT = re.compile(r"[A-Za-z](?= [A-Za-z])")


def resolve(path_or_name: str) -> str:
    if os.path.sep in path_or_name:
        return path_or_name
    import public_tokenizers
    return public_tokenizers.path(path_or_name)


def version_digest(path_or_name: str) -> str:
    """Digest of the tokenizer file: the tokenizer's version."""
    with open(resolve(path_or_name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cut a long text where its encoding splits anyway; a text without such a place stays whole."""
    if len(text) <= size:
        return [text]
    out, start = [], 0
    while len(text) - start > size:
        m = _CUT.search(text, start + size)
        if not m:
            break
        out.append(text[start:m.end()])
        start = m.end()
    out.append(text[start:])
    return out


_LOADED: dict[str, object] = {}


def encoder(path_or_name: str) -> Callable[[str], list[int]]:
    """text -> ids without special tokens added; loaded once per Python worker."""
    path = resolve(path_or_name)
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda text: sp.encode(text, add_bos=False, add_eos=False)
        else:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()

            def encode(text: str) -> list[int]:
                # The batch call without offsets; pieces one by one, so one piece's encoding is held at a time.
                ids: list[int] = []
                for part in pieces(text):
                    ids += tok.encode_batch_fast([part], add_special_tokens=False)[0].ids
                return ids

            _LOADED[path] = encode
    return _LOADED[path]
