"""Document fingerprints by locally consistent parsing.

Each level parses a sequence of names into phrases and names these. Runs of one name become one symbol.
Deterministic coin tossing then shrinks the names to labels: a symbol's label is the place of the lowest bit
in which it differs from the symbol before it, with the value of that bit; neighbours keep different
labels, and three rounds leave less than eight of them. Phrases start at the local maxima of the labels.
All of this looks at a few neighbours only, so equal substrings are parsed alike but for their
margins, wherever they stand, and their inner phrases get equal names, level after level.

A fingerprint holds, for three levels, the smallest hashes of the phrase names, each with its number among
equal ones; the likeness of two is the estimated share of common names, averaged over the levels.

As a cut is known from four symbols before it and one after it, a long text goes through all levels slice by slice: each level
keeps its open phrase and these neighbours, so memory follows the names of the second level and not the characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, partitions

LEVELS = (2, 3, 4)
KEEP = 24
ROUNDS = 3
STEP = 128  # of the two-step search for a block
MOST_BLOCKS = 32_768
SLICE = 400_000

_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread one-to-one map of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowest_bit(x: np.ndarray) -> np.ndarray:
    """Place of the lowest set bit (of numbers that are not zero)."""
    low = x & (~x + np.uint64(1))
    return np.frexp(low.astype(np.float64))[1].astype(np.uint64) - np.uint64(1)


def toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round: each symbol against the one before it; a text's first symbol against its bit 0."""
    place = np.zeros(len(x), np.uint64)
    place[1:] = lowest_bit(np.where(first[1:], np.uint64(1), x[1:] ^ x[:-1]))
    return (place << np.uint64(1)) | ((x >> place) & np.uint64(1))


def parse(x: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The next level's names, and which of them are the first of a text."""
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | first[1:]
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(x))).astype(np.uint64)
    x, first = x[at], first[at]
    x = np.where(run > 1, mix(x + run * np.uint64(0xD6E8FEB86659FD93)), x)
    label = x
    for _ in range(ROUNDS):
        label = toss(label, first)
    up = np.ones(len(x), bool)
    up[1:] = (label[1:] > label[:-1]) | first[1:]
    down = np.ones(len(x), bool)
    down[:-1] = (label[:-1] > label[1:]) | first[1:]
    start = np.flatnonzero((up & down & ~np.append(first[1:], True)) | first)
    return names(x, start, level), first[start]


def names(x: np.ndarray, start: np.ndarray, level: int) -> np.ndarray:
    """The names of the phrases of `x` that start at `start`, the first at 0."""
    place = np.arange(len(x)) - np.repeat(start, np.diff(np.append(start, len(x))))
    return mix(np.add.reduceat(mix(x) * _POWERS[place % 64], start) + np.uint64(level))


class Level:
    """A level over one text that comes in slices: the names that `parse` gives, as far as they are settled."""

    def __init__(self, level: int):
        self.level = level
        self.run: tuple[np.ndarray, int] | None = None  # the open run: its symbol and length
        self.held = np.empty(0, np.uint64)  # the open phrase and what its neighbours need
        self.open = 0  # where the open phrase starts in it
        self.settled = 1  # cuts before this place are known
        self.whole = True  # `held` starts where the text does

    def runs(self, x: np.ndarray, last: bool) -> np.ndarray:
        """The symbols of the runs that have ended."""
        at = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, int)
        run, x = np.diff(np.append(at, len(x))).astype(np.uint64), x[at]
        if self.run is not None:
            symbol, n = self.run
            if len(x) and x[0] == symbol[0]:
                run[0] += np.uint64(n)
            else:
                x, run = np.append(symbol, x), np.append(np.uint64(n), run)
        self.run = None
        if not last and len(x):
            self.run = (x[-1:].copy(), int(run[-1]))
            x, run = x[:-1], run[:-1]
        return np.where(run > 1, mix(x + run * np.uint64(0xD6E8FEB86659FD93)), x)

    def feed(self, x: np.ndarray, last: bool) -> np.ndarray:
        y = np.append(self.held, self.runs(x, last))
        if not len(y):
            return y
        first = np.zeros(len(y), bool)
        first[0] = self.whole
        label = y
        for _ in range(ROUNDS):
            label = toss(label, first)
        peak = np.flatnonzero((label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])) + 1
        start = np.append(self.open, peak[peak >= self.settled])
        end = len(y) if last else int(start[-1])
        done = names(y[self.open : end], (start if last else start[:-1]) - self.open, self.level) if end > self.open else y[:0]
        base = max(0, int(start[-1]) - ROUNDS - 1)
        self.held, self.open, self.settled = y[base:].copy(), int(start[-1]) - base, max(1, len(y) - 1 - base)
        self.whole = self.whole and base == 0
        return done


def smallest(x: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For each text the KEEP smallest hashes of its names. The second, third, ... of one name have
    hashes of their own, so that a name counts as often as it stands."""
    text = (np.cumsum(first) - 1).astype(np.uint64) << np.uint64(32)

    def hashed(h: np.ndarray) -> np.ndarray:
        return np.sort(text | (mix(h) >> np.uint64(32)))

    h = hashed(x)
    start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    nth = (np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))).astype(np.uint64)
    h = hashed((h & np.uint64(0xFFFFFFFF)) + (nth << np.uint64(32)) + np.uint64(1))
    edges = np.append(np.searchsorted(h, np.unique(text)), len(h))
    low = h.astype(np.uint32)
    return [np.unique(low[a:b][: 2 * KEEP])[:KEEP] for a, b in zip(edges, edges[1:])]


def symbols(text: str) -> np.ndarray:
    return mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))


def long_fingerprint(text: str) -> tuple[np.ndarray, ...]:
    """The fingerprint of one text, of which a slice is parsed at a time."""
    levels, kept = [Level(n) for n in range(1, max(LEVELS) + 1)], {n: [] for n in LEVELS}
    for at in range(0, len(text), SLICE):
        x = symbols(text[at : at + SLICE])
        for level in levels:
            x = level.feed(x, at + SLICE >= len(text))
            if level.level in kept:
                kept[level.level].append(x)
    out = ()
    for n in LEVELS:
        x = np.concatenate(kept.pop(n))
        out += tuple(smallest(x, np.append(True, np.zeros(len(x) - 1, bool))))
    return out


def fingerprints(texts: list[str]) -> list[tuple[np.ndarray, ...]]:
    """For each text, per level, its smallest name hashes (32 bits), ascending; none if it is empty."""
    full = [i for i, t in enumerate(texts) if 0 < len(t) <= SLICE]
    out: list[tuple[np.ndarray, ...]] = [long_fingerprint(t) if len(t) > SLICE else () for t in texts]
    if not full:
        return out
    lengths = [len(texts[i]) for i in full]
    first = np.zeros(sum(lengths), bool)
    first[np.cumsum([0, *lengths])[:-1]] = True
    x = symbols("".join(texts[i] for i in full))
    for level in range(1, max(LEVELS) + 1):
        x, first = parse(x, first, level)
        if level in LEVELS:
            for i, low in zip(full, smallest(x, first)):
                out[i] += (low,)
    return out


def likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    total = 0.0
    for x, y in zip(a, b):
        both = np.sort(np.concatenate([x, y]))
        same = both[1:][both[1:] == both[:-1]]
        union = len(both) - len(same)
        if union > KEEP:  # only what lies under the k-th smallest of the union is known of both
            least = np.unique(both)[KEEP - 1]
            total += (same <= least).sum() / KEEP
        else:
            total += len(same) / union
    return total / len(LEVELS)


def written(f: tuple[np.ndarray, ...]) -> str:
    return "-".join(x.astype(">u4").tobytes().hex() for x in f)


def edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(i, t, block, extra), where every block holds consecutive documents by descending id and,
    marked `extra`, the one that follows its last; sorted so within partitions.

    Only ids go to the driver, two for each of at most 32,768 blocks. The text is shuffled once.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    blocks = max(1, min(MOST_BLOCKS, 8 * partitions(spark)))
    shares = [k / blocks for k in range(1, blocks)] or [0.5]
    cuts = docs.agg(F.percentile_approx(key, shares, min(20 * blocks, 200_000)).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    array = lambda values: F.lit(values).cast("array<long>") if values else F.array().cast("array<long>")
    under = lambda a: F.size(F.filter(a, lambda c: c < key)).cast("int")
    coarse = under(array(cuts[STEP - 1 :: STEP]))
    block = coarse * STEP + under(F.slice(array(cuts), coarse * STEP + 1, STEP))
    heads = sorted((r["b"], r["h"]) for r in docs.groupBy(block.alias("b")).agg(F.max(key).alias("h")).collect())
    head, above = [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    for k, (b, h) in enumerate(heads):
        head[b], above[b] = h, heads[(k + 1) % len(heads)][0]
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), key.alias("key"), block.alias("b"))
    here = F.struct(F.col("b").cast("long").alias("block"), F.lit(False).alias("extra"))
    there = F.struct(F.element_at(array(above), F.col("b") + 1).alias("block"), F.lit(True).alias("extra"))
    is_head = F.col("key") == F.element_at(array(head), F.col("b") + 1)
    rows = rows.select("i", "t", "key", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here))).alias("at"))
    rows = rows.select("i", "t", "key", "at.block", "at.extra").repartition(partitions(spark), "block")
    return rows.sortWithinPartitions("block", "extra", F.desc("key"), "t").select("i", "t", "block", "extra")


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third (floor) replaced by as much of the head of the document that
    follows by descending id, the first after the last. A null text counts as empty; an empty text
    has an empty fingerprint, like only another empty one (1.0). Null ids come last; rows of one id
    follow each other by text. A single row follows itself. Only the two named columns are read; an
    empty table gives no rows. Whole texts are parsed, very long ones slice by slice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def slices():
            """Lists of rows, the first of each being the last of the one before it."""
            held, size = [], 0
            for batch in batches:
                ids = batch["i"].astype("Int64").to_numpy(dtype=object, na_value=None)
                for row in zip(ids, batch["t"], batch["block"], batch["extra"]):
                    held.append(row)
                    size += len(row[1])
                    if size >= SLICE and len(held) > 1:
                        yield held
                        held, size = held[-1:], len(row[1])
            if len(held) > 1:
                yield held

        for rows in slices():
            pairs = [(k, k + 1) for k, row in enumerate(rows[:-1]) if not row[3] and rows[k + 1][2] == row[2]]
            own = fingerprints([t for _, t, _, _ in rows])
            changed = [edited(rows[k][1], rows[n][1]) for k, n in pairs]
            out = []
            for (k, n), text, f in zip(pairs, changed, fingerprints(changed)):
                sha = hashlib.sha256(text.encode()).hexdigest()
                out.append((rows[k][0], len(rows[k][1]), sha, written(own[k]), written(f), likeness(own[k], f), likeness(own[k], own[n])))
            frame = pd.DataFrame(out, columns=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            frame["id"] = frame["id"].astype("Int64")
            yield frame

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_texts(in_order(docs, id_col, text_col), run, schema).withColumnRenamed("id", id_col)
