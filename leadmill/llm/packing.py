"""Vector bin packing of examples into training sequences.

An example asks for three things at once: tokens, segments (one) and loss-bearing tokens. A
sequence has a limit on each. The open sequence takes, again and again, the waiting example with
the largest dot product between what it asks for and what is left, both as shares of the limits,
among those that fit in all three; when none fits, it is closed. Documents may also be cut: then
the gap that no waiting piece fits is filled by the head of the best one, and a sequence that ends
short is dealt out as sequences whose lengths are powers of two, which need no padding.

Each task packs its own split with a bounded pool of waiting pieces: no shuffle, and a retried task
reads the same rows in the same order and gives the same sequences. A task's last sequences are
the only ones that lack partners, so padding per row falls as splits grow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_words import ByteBpe
from .common import kept, map_texts

ID_SHIFT = 40
END_ID = 1


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


@dataclass
class Piece:
    key: object
    start: int
    length: int
    loss: int
    total: int
    ids: bytes | memoryview = b""

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first n tokens and the rest, for pieces whose tokens all bear loss. Ids that are a view stay views of one buffer."""
        head = Piece(self.key, self.start, n, n, self.total, self.ids[: 4 * n])
        return head, Piece(self.key, self.start + n, self.length - n, self.length - n, self.total, self.ids[4 * n :])


class Packer:
    """The pool of waiting pieces and the dot-product rule."""

    def __init__(self, limits: Limits, cut: bool, pool: int = 512):
        self.most = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.cut, self.pool = cut, pool
        self.need = np.zeros((2 * pool, 3))
        self.waiting: list[Piece] = []

    def add(self, piece: Piece) -> None:
        self.need[len(self.waiting)] = piece.length, 1, piece.loss
        self.waiting.append(piece)

    def take(self, j: int) -> Piece:
        piece, last = self.waiting[j], self.waiting.pop()
        if last is not piece:
            self.waiting[j] = last
            self.need[j] = self.need[len(self.waiting)]
        return piece

    def next_sequence(self) -> list[Piece]:
        left, chosen = self.most.copy(), []
        while self.waiting and left[0] > 0:
            need = self.need[: len(self.waiting)]
            worth = need @ (left / self.most**2)
            fits = (need <= left).all(axis=1)
            if fits.any():
                piece = self.take(int(np.where(fits, worth, -1.0).argmax()))
            elif self.cut and (n := int(min(left[0], left[2]))) > 0 and left[1] >= 1:
                piece, rest = self.take(int(worth.argmax())).cut(n)
                self.add(rest)
            else:
                break
            chosen.append(piece)
            left -= (piece.length, 1, piece.loss)
        return chosen

    def ready(self, last: bool = False) -> Iterator[list[Piece]]:
        if last or len(self.waiting) >= self.pool:
            while len(self.waiting) > (0 if last else self.pool // 2):
                yield self.next_sequence()


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces dealt, in order, over sequences whose lengths are powers of two, longest first."""
    total = sum(p.length for p in pieces)
    pieces = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        if room := total & (1 << bit):
            run = []
            while room:
                piece = pieces.pop()
                if piece.length > room:
                    piece, rest = piece.cut(room)
                    pieces.append(rest)
                run.append(piece)
                room -= piece.length
            yield run


def pack(pieces: Iterable[Piece], limits: Limits, cut: bool) -> Iterator[list[Piece]]:
    """Sequences of whole pieces, or with `cut` of parts of them."""
    packer = Packer(limits, cut)
    whole = min(limits.tokens, limits.loss_tokens)

    def closed(sequence: list[Piece]) -> Iterator[list[Piece]]:
        short = sum(p.length for p in sequence) < limits.tokens
        yield from powers(sequence) if cut and short else [sequence]

    for piece in pieces:
        if cut and piece.length > whole:
            piece.ids = memoryview(piece.ids)
            while piece.length > whole:
                head, piece = piece.cut(whole)
                yield from closed([head])
            piece.ids = bytes(piece.ids)  # what waits must not hold the whole text's ids
        packer.add(piece)
        for sequence in packer.ready():
            yield from closed(sequence)
    for sequence in packer.ready(last=True):
        yield from closed(sequence)


def numbered(sequences: Iterable[list[Piece]], with_ids: bool) -> Iterator[pd.DataFrame]:
    """Rows of pieces with sequence ids that no other task gives, about 20,000 at a time."""
    names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "loss_tokens", "ids_crc32"]
    base, rows = TaskContext.get().partitionId() << ID_SHIFT, []

    def frame():
        out = pd.DataFrame(rows, columns=names)
        out["id"] = out["id"].astype("Int64")
        return out if with_ids else out.drop(columns="ids_crc32")

    for n, sequence in enumerate(sequences):
        offset, filled = 0, sum(p.length for p in sequence)
        for p in sequence:
            rows.append((p.key, p.start, p.length, p.total, base + n, offset, filled, p.loss, zlib.crc32(p.ids)))
            offset += p.length
        if len(rows) >= 20_000:
            yield frame()
            rows.clear()
    if rows:
        yield frame()


ROW = "id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, loss_tokens long"


def pack_documents(docs: DataFrame, tokenizer_path: str, *, ranks_path: str | None = None, pattern: str | None = None, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs whole texts, cut freely, into sequences; one row per piece.

    Columns: id, start (the document's ids before the piece), length, ids_crc32, doc_tokens (with
    the end id 1), sequence_id, offset, sequence_tokens (filled part of the sequence), loss_tokens
    (all tokens bear loss). Every id lies in exactly one piece; a sequence holds `limits.tokens`, or a
    power of two.

    A null or empty text is the end id alone. Null ids stay null, repeated rows are packed each.
    Only the two named columns are read. An empty table gives no rows. A very long text becomes
    full sequences and one rest, whatever its length.
    """

    key = ("packing", tokenizer_path, ranks_path, pattern)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = kept(key, lambda: ByteBpe(*key[1:]))
        end = END_ID.to_bytes(4, "little")

        def pieces():
            for batch in batches:
                keys = batch["i"].astype("Int64").to_numpy(dtype=object, na_value=None)
                for key, text in zip(keys, batch["t"]):
                    ids = (bpe.encode(text) if text else b"") + end
                    n = len(ids) // 4
                    yield Piece(key, 0, n, n, n, ids)

        yield from numbered(pack(pieces(), limits, cut=True), with_ids=True)

    source = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return map_texts(source, run, f"{ROW}, ids_crc32 long", keep=key).withColumnRenamed("id", id_col)


def pack_examples(examples: DataFrame, limits: Limits = Limits(), *, id_col: str = "example_id", tokens_col: str = "tokens", loss_col: str = "loss_tokens") -> DataFrame:
    """Packs instruction examples whole, by their token and loss-bearing token counts.

    Null counts are zero; an example without tokens still takes a segment. An example that exceeds
    a limit alone gets a sequence of its own, to be cut or refused by the caller
    (`sequence_tokens` or `loss_tokens` shows it). Ids may be null or repeated.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def too_large(p: Piece) -> bool:
            return p.length > limits.tokens or p.loss > limits.loss_tokens

        alone: list[list[Piece]] = []

        def pieces():
            for batch in batches:
                keys = batch["i"].astype("Int64").to_numpy(dtype=object, na_value=None)
                for key, n, loss in zip(keys, batch["n"], batch["l"]):
                    p = Piece(key, 0, int(n), int(loss), int(n))
                    if too_large(p):
                        alone.append([p])
                    else:
                        yield p

        def sequences():
            for sequence in pack(pieces(), limits, cut=False):
                yield sequence
                while alone:
                    yield alone.pop()
            yield from alone

        yield from numbered(sequences(), with_ids=False)

    count = lambda c: F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0))
    source = examples.select(F.col(id_col).cast("long").alias("i"), count(tokens_col).alias("n"), count(loss_col).alias("l"))
    return map_texts(source, run, ROW).withColumnRenamed("id", id_col)
