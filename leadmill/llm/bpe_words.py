"""Byte-pair encoding with memory of words: what a text splits into at plain blanks is encoded
once and then looked up. Two generations bound the memory."""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache


class WordMemo(dict):
    """word -> encoded value. Holds at most two generations of `size` words; a word that is
    asked for again moves to the younger one."""

    def __init__(self, encode, size: int = 250_000, longest: int = 64):
        super().__init__()
        self.encode, self.size, self.longest, self.old = encode, size, longest, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.encode(word)
        if len(word) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def library(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class ByteBpe:
    """Ids of a byte-level BPE with the leading-blank pattern, equal to those of the tokenizers
    library's `encode(text, add_special_tokens=False)`.

    A text may be cut before each single blank that stands between two characters that are no
    white space: the pattern always ends a piece there and looks back at nothing. A text with
    other runs that hold a blank goes to the library whole. `ranks_path` names the same vocabulary
    as ranks: words that hold no special token are merged by it, which is quicker for single words.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.tok = library(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
            self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.memo = WordMemo(self._after_blank)

    def _ids(self, piece: str) -> bytes:
        if self.plain is None or any(s in piece for s in self.special):
            return packed(self.tok.encode(piece, add_special_tokens=False).ids)
        return packed(self.plain.encode_ordinary(piece))

    def _after_blank(self, word: str):
        if not word or word[0].isspace() or word[-1].isspace():
            return False  # the blank before it belongs to a longer run
        return self._ids(f" {word}")

    def encode(self, text: str) -> bytes:
        first, *words = text.split(" ")
        if words:
            rest = list(map(self.memo.__getitem__, words))
            if False not in rest and not (first and first[-1].isspace()):
                return self._ids(first) + b"".join(rest) if first else b"".join(rest)
        return packed(self.tok.encode(text, add_special_tokens=False).ids)
