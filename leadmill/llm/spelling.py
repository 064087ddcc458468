"""Spelling variants: words one edit apart, found by probing Bloom filters of the vocabulary.

Tasks count the words of their texts before anything is shuffled. The vocabulary goes, shard by shard of word lengths, into blocked Bloom
filters (a word sets five bits of one 64-bit block). These are broadcast, and every word asks them for its deletions and for its
replacements by later letters: each pair of near words is met once, from the longer or from the smaller word. Hashes of all edits
come from a polynomial hash of the word, in numpy, without making the edited words. Only what the filters know is written out as a
word and joined with the vocabulary, which removes what they were wrong about.

Filters take 3 bytes a word. They are cut into segments, and a round broadcasts at most ROUND_BYTES of them; a larger vocabulary takes
more rounds, in each of which only the words of neighbouring lengths probe. Nothing is left out at any size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, spool

HELD = 200_000  # words that a task counts before it passes them on
BITS_A_WORD, SEGMENT = 24, 1 << 15  # blocks of a segment: 256 KB
ROUND_BYTES = 64 << 20
ROWS = 2000  # words probed at once
RATIO = 10  # of a form's occurrences to those of its variant

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # of Latin-1

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_CODES = _mixed(np.arange(1, 257, dtype=np.uint64))  # a number for each letter
_BASE = 0xD1342543DE82EF95
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_BITS = np.zeros(1 << 16, np.uint64)  # five bits of a block, by the low half of a hash's low word
for _k in range(5):
    _BITS |= np.uint64(1) << (_mixed(np.arange(1 << 16, dtype=np.uint64) + np.uint64((_k + 1) << 20)) & np.uint64(63))


def powers(n: int) -> np.ndarray:
    return np.array([pow(_BASE, k, 1 << 64) for k in range(n)], np.uint64)


def letters_of(words: list[bytes]) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def hashes(letters: np.ndarray) -> np.ndarray:
    return (_CODES[letters] * powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def placed(mixed: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each hash."""
    return ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def blocks_of(words: int) -> int:
    """Blocks of a filter for so many words: whole segments, or less than one."""
    n = -(-words * BITS_A_WORD // 64)
    return n if n <= SEGMENT else -(-n // SEGMENT) * SEGMENT


class Shard:
    """The part of one length's filter that a round holds: the blocks from `low` on."""

    def __init__(self, blocks: int, low: int, bits: np.ndarray):
        self.blocks, self.low, self.bits = blocks, np.uint64(low), bits

    def knows(self, hash_: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be words'."""
        mixed = _mixed(hash_)
        at = placed(mixed, self.blocks) - self.low  # wraps round below `low`
        marks = _BITS[(mixed & np.uint64(0xFFFF)).astype(np.intp)]
        if len(self.bits) == self.blocks:
            return np.flatnonzero(self.bits[at.astype(np.intp)] & marks == marks)
        here = np.flatnonzero(at < np.uint64(len(self.bits)))
        marks = marks[here]
        return here[self.bits[at[here].astype(np.intp)] & marks == marks]


def known_edits(letters: np.ndarray, alphabet: np.ndarray, same: Shard | None, shorter: Shard | None) -> Iterator[tuple[int, bytes]]:
    """(row, edited word) of the deletions and of the replacements by later letters that the filters know, each once."""
    n, length = letters.shape
    power = powers(length)
    codes = _CODES[letters] * power
    before = np.cumsum(codes, axis=1, dtype=np.uint64)
    whole = before[:, -1]
    if shorter is not None and length > 1:
        for i in range(length):
            rows = np.arange(n) if i == 0 else np.flatnonzero(letters[:, i] != letters[:, i - 1])  # of a run of letters the first
            head = before[rows, i] - codes[rows, i]
            for k in shorter.knows(head + (whole[rows] - before[rows, i]) * _BACK):
                word = letters[rows[k]].tobytes()
                yield int(rows[k]), word[:i] + word[i + 1 :]
    if same is not None:
        for i in range(length):
            rows, new = np.nonzero(letters[:, i, None] < alphabet[None])
            h = whole[rows] - codes[rows, i] + (_CODES[alphabet] * power[i])[new]
            for k in same.knows(h):
                word = letters[rows[k]].tobytes()
                yield int(rows[k]), word[:i] + alphabet[new[k]].tobytes() + word[i + 1 :]


def counted(docs: DataFrame, id_col: str, text_col: str, least: int, typos: int | None) -> DataFrame:
    """word, n of all words of at least `least` letters."""
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()

        def told() -> pd.DataFrame:
            out = pd.DataFrame({"word": [w.decode("latin-1") for w in seen], "n": list(seen.values())})
            seen.clear()
            return out

        for batch in batches:
            for key, text in zip(batch["i"], batch["t"]):
                # What is no Latin-1 becomes a question mark, which is no letter.
                for found in run.finditer(text.encode("latin-1", "replace").translate(_LOWER)):
                    word = found[0]
                    if typos:
                        h = zlib.crc32((f"{key}:" + word.decode("latin-1")).encode())
                        if h % typos == 0:
                            if len(word) == least:
                                continue
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    seen[word] += 1
                    if len(seen) >= HELD:
                        yield told()
        yield told()

    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(ident.alias("i"), F.col(text_col).cast("string").alias("t")).filter("t is not null")
    return map_texts(rows, words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segments(vocabulary: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """length, segment, bits, letters of all filters: a group holds the words of one segment only."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby("length"):
                letters = letters_of([w.encode("latin-1") for w in part["word"]])
                mixed = _mixed(hashes(letters))
                place = placed(mixed, blocks_of(sizes[length])).astype(np.int64)
                seen = np.unique(letters).tobytes()
                yield pd.DataFrame({"length": length, "segment": place // SEGMENT, "place": place % SEGMENT, "low": (mixed & np.uint64(0xFFFF)).astype(np.int64), "letters": [seen] + [None] * (len(part) - 1)})

    def built(group: pd.DataFrame) -> pd.DataFrame:
        length, segment = int(group["length"].iloc[0]), int(group["segment"].iloc[0])
        bits = np.zeros(min(SEGMENT, blocks_of(sizes[length])), np.uint64)
        np.bitwise_or.at(bits, group["place"].to_numpy(), _BITS[group["low"].to_numpy()])
        seen = bytes(sorted(set(b"".join(x for x in group["letters"] if x is not None))))
        return pd.DataFrame([(length, segment, bits.tobytes(), seen)], columns=["length", "segment", "bits", "letters"])

    rows = map_texts(vocabulary.select("word", "length"), hashed, "length int, segment int, place long, low long, letters binary")
    return rows.groupBy("length", "segment").applyInPandas(built, "length int, segment int, bits binary, letters binary")


def near_pairs(vocabulary: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """word, n, other, other_n: each pair of words of the vocabulary (word, n, length) at one edit, once."""
    spark = vocabulary.sparkSession
    sizes = {r["length"]: r["count"] for r in vocabulary.groupBy("length").count().collect()}
    filters = spool(segments(vocabulary, sizes), "filters")
    alphabet = np.frombuffer(bytes(sorted({b for r in filters.select("letters").distinct().collect() for b in r[0]})), np.uint8)

    def probe(held):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shards = {length: Shard(blocks, low, np.frombuffer(bits, np.uint64)) for length, (blocks, low, bits) in held.value.items()}
            for batch in batches:
                for length, part in batch.groupby("length"):
                    same, shorter = shards.get(length), shards.get(length - 1)
                    if same is None and shorter is None:
                        continue
                    names, n = part["word"].to_numpy(), part["n"].to_numpy()
                    for at in range(0, len(part), ROWS):
                        letters = letters_of([w.encode("latin-1") for w in names[at : at + ROWS]])
                        found = list(known_edits(letters, alphabet, same, shorter))
                        rows = at + np.array([i for i, _ in found], np.int64)
                        yield pd.DataFrame({"word": names[rows], "n": n[rows], "other": [w.decode("latin-1") for _, w in found]})

        return run

    positives = None
    for chosen in rounds({length: blocks_of(n) for length, n in sizes.items()}, round_bytes):
        held = {}
        for length, (first, last) in chosen.items():
            parts = filters.filter((F.col("length") == length) & F.col("segment").between(first, last)).select("segment", "bits").collect()
            blocks = blocks_of(sizes[length])
            width = 8 * min(SEGMENT, blocks)
            bits = bytearray(width * (last - first + 1))
            for r in parts:
                bits[width * (r.segment - first) : width * (r.segment - first + 1)] = r.bits
            held[length] = (blocks, first * SEGMENT, bytes(bits))
        lengths = sorted({x for length in held for x in (length, length + 1) if x in sizes})
        asked = vocabulary.filter(F.col("length").isin(lengths)).select("word", "n", "length")
        found = map_texts(asked, probe(spark.sparkContext.broadcast(held)), "word string, n long, other string")
        positives = found if positives is None else positives.unionByName(found)
    if positives is None:
        positives = vocabulary.select("word", "n", F.col("word").alias("other")).limit(0)
    known = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return positives.join(known, "other").select("word", "n", "other", "other_n")


def rounds(blocks: dict[int, int], most: int) -> list[dict[int, tuple[int, int]]]:
    """Segments (first and last, by length) of each round, at most `most` bytes together, one at least."""
    out: list[dict[int, tuple[int, int]]] = []
    used = 0
    for length in sorted(blocks):
        for segment in range(-(-blocks[length] // SEGMENT)):
            size = 8 * min(SEGMENT, blocks[length])
            if not out or used + size > most:
                out.append({})
                used = 0
            out[-1][length] = (out[-1].get(length, (segment, 0))[0], segment)
            used += size
    return out


def with_roots(words: DataFrame) -> DataFrame:
    """`words` (word, form, ...) with root, the end of the chain of forms; a form is more frequent than its variants, so chains are no
    rings and short. Only words with a form are joined; each round doubles what is followed."""
    own = words.filter("form is null").withColumn("root", F.col("word"))
    chain = spool(words.filter("form is not null").withColumn("root", F.col("form")), "chain")
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = spool(chain.join(further, "root", "left"), "chain")
        chain = joined.withColumn("root", F.coalesce("next", "root")).drop("next")
        if joined.filter("next is not null").isEmpty():
            return own.unionByName(chain)


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 7, least_n: int = 2, typos: int | None = None, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z, of at least `least_letters` and with at least `least_n`
    occurrences. Two are near at one inserted, deleted or replaced letter. A word's form is its near word with the most occurrences, ties
    to the smaller in code-point order, if it has RATIO times the word's; root follows forms to the end. With `typos`, one in so many
    runs, by the crc32 of `id:run`, loses a letter first.

    Null and empty texts have no words; a null id reads as empty. Repeated rows count each time. Other columns may have any
    name. Without words there are no rows. Texts are read whole, one after another.
    """
    words = counted(docs, id_col, text_col, least_letters, typos).filter(F.col("n") >= least_n)
    vocabulary = spool(words.withColumn("length", F.char_length("word")), "vocabulary")
    pairs = spool(near_pairs(vocabulary, round_bytes), "pairs")
    none = lambda kind: F.lit(None).cast(kind)
    told = vocabulary.select("word", "n", none("string").alias("other"), none("long").alias("other_n"))
    told = told.unionByName(pairs.select("word", none("long").alias("n"), "other", "other_n"))
    told = told.unionByName(pairs.select(F.col("other").alias("word"), none("long").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("minus"), "other"))).alias("best")
    found = told.groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best)
    enough = -F.col("best.minus") >= RATIO * F.col("n")
    found = found.select("word", "n", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"))
    return with_roots(spool(found, "words")).select("word", "form", "root", "n", "n_near", "form_n")
