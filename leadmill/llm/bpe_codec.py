"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over 16 code points cuts each text into chunks at places that only its content
decides, so passages shared by documents give equal chunks wherever they stand. A task keeps the
chunks that it has met: an equal chunk is encoded once. A chunk's first and last word may go on
beyond the chunk; these two fragments stay text. At each chunk join the fragments on both sides are
put together, over further chunks if one holds no blank, until they end at blanks, and are encoded
again: blanks end every piece of the tokenizer's pattern and no normalisation reaches over one, so
the ids then agree with those of the whole text.

The work is one narrow stage: no shuffle, so a lost executor costs only its own splits. Sharing
chunks over tasks would move each text and its ids over the network (2.8 times the input).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_words import WordMemo, library, packed
from .common import map_texts

WINDOW_DOUBLINGS = 4
BASE = 0x2C1B3C6D
MIX = 0x297A2D39


def chunk_ends(points: np.ndarray, mask: int) -> np.ndarray:
    """Ends (exclusive) of the chunks but the last: after each position whose hash of the last
    16 code points has zeros under `mask`."""
    h = points.astype(np.uint32)
    factor, step = np.uint32(BASE), 1
    for _ in range(WINDOW_DOUBLINGS):
        if len(h) <= step:
            return np.empty(0, np.int64)
        more = h.copy()
        more[step:] += h[:-step] * factor
        h, factor, step = more, np.uint32(int(factor) ** 2 & 0xFFFFFFFF), step * 2
    h *= np.uint32(MIX)
    ends = np.flatnonzero((h >> np.uint32(20)) & np.uint32(mask) == 0) + 1
    return ends[(ends >= step) & (ends < len(points))]


class ChunkCodec:
    """Encodes texts to the ids of a tokenizer that drops white space, and decodes them back."""

    def __init__(self, path: str, mean_chunk: int = 256, chunks: int = 20_000):
        self.tok = library(path)
        self.model = self.tok.model
        named = {i: t for t, i in self.tok.get_vocab(with_added_tokens=True).items()}
        self.names = [named.get(i, "") for i in range(max(named) + 1)]
        self.mask = (1 << max(0, min(12, mean_chunk.bit_length() - 1))) - 1
        self.words = WordMemo(self._word)
        self.chunks = WordMemo(self._chunk, chunks, longest=16 * mean_chunk)
        self.bytes_to_name = byte_names()

    def _word(self, word: str) -> bytes:
        """Ids of what stands between blanks."""
        core = word.rstrip(".,")
        if core.isalpha() and max(core) < "Ā":
            # One run of letters and perhaps one of marks; lower case and composed by itself.
            ids = [t.id for t in self.model.tokenize(self._named(core.lower()))]
            if len(core) < len(word):
                ids += [t.id for t in self.model.tokenize(word[len(core) :])]
        else:
            ids = self.tok.encode(word, add_special_tokens=False).ids if word else ()
        return packed(ids)

    def _named(self, piece: str) -> str:
        return piece if piece.isascii() else "".join([self.bytes_to_name[b] for b in piece.encode()])

    def _chunk(self, chunk: str) -> tuple[str, bytes | None, str]:
        """Fragment before the first blank, ids of the words between, fragment after the last
        blank; only a fragment if there is no blank."""
        head, *mid = chunk.replace("\n", " ").split(" ")
        if not mid:
            return head, None, ""
        tail = mid.pop()
        return head, b"".join(map(self.words.__getitem__, mid)), tail

    def encode(self, text: str) -> bytes:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        ids, at = [], 0
        open_: list[str] = []  # fragments since the last blank
        for end in [*chunk_ends(points, self.mask).tolist(), len(text)]:
            head, mid, tail = self.chunks[text[at:end]]
            at = end
            open_.append(head)
            if mid is not None:
                ids += self.words["".join(open_)], mid
                open_ = [tail]
        ids.append(self.words["".join(open_)])
        return b"".join(ids)

    def decode(self, ids: np.ndarray) -> str:
        """As the library, which has no decoder for this vocabulary: the tokens' names, with blanks
        between them."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def byte_names() -> list[str]:
    """The printable character by which byte-level vocabularies name each byte: itself where it is
    printable Latin-1, else the next free one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=1)
def codec(path: str, mean_chunk: int) -> ChunkCodec:
    return ChunkCodec(path, mean_chunk)


def encode_decode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", mean_chunk: int = 256, with_values: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; with_values adds ids (array) and decoded.

    A null text counts as empty: no ids, empty decoded text. Rows are taken as they come: repeated
    ids and texts give repeated rows, a null id stays null. Only `id_col` and `text_col` are read,
    so other columns may have any name. An empty table gives an empty result. Texts of any length
    are processed whole, one at a time.
    """
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_values:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(tokenizer_path, mean_chunk)
        for batch in batches:
            rows = []
            for text in batch["t"]:
                coded = c.encode(text or "")
                ids = np.frombuffer(coded, "<u4")
                said = c.decode(ids)
                row = (len(ids), hashlib.sha256(coded).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
                rows.append((*row, ids.astype(np.int32), said) if with_values else row)
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")][1:])
            out.insert(0, "id", batch["i"].astype("Int64").to_numpy(dtype=object, na_value=None))
            yield out

    source = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return map_texts(source, run, schema).withColumnRenamed("id", id_col)
