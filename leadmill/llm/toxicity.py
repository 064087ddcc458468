"""Toxicity by class-conditional Kneser-Ney language models.

Toxic and ordinary documents have one model each. A model's probability of a word is that of
Kneser-Ney's lower order: not how often the class has the word, but after how many different words. What many
documents say in many places has many; what a few copies of one text repeat has one, and the discount takes it.
Both models back off to one shared level, the number of different words that a word follows over all
documents, labelled or not, so a rare expression that neither class knows well gets the same probability
from both, up to a constant.

    p(w | class) = max(n(class, w) - d, 0) / n(class) + taken(class) / n(class) * shared(w)

with n(class, w) the different words before w in the class, the start of each document being one of its own, and a
discount d of two. Above it stands the order of word pairs given the class, by how often they occur:

    p(w | v, class) = max(n(class, v, w) - d, 0) / n(class, v) + left(class, v) * p(w | class)

with left(class, v) what the discount takes after v. Where a class does not know v, and for a document's first word, the lower order stands alone.

A document's log-likelihood ratio of both classes is normalised by length: over the whole text, over
its most toxic window of 16 words, and over its three most toxic words, by the lower order and by that of pairs. A logistic unit turns these into
a score; it is fitted on a bounded sample of labelled documents that gave no counts. All other labelled
documents to learn from give counts, by exact different pairs of words. At the shared level different preceding words are
estimated by bitmaps of 64 bins at 14 levels (exact pairs of the whole corpus would be more shuffle than the check
allows), each level taking a quarter of the words of the one before: the first level that is not full and all
later ones tell the number, to about a sixth, up to billions. Bitmaps add up by OR, so the pass over the corpus
sends one row for each different word of a batch. Ratios of up to a million
words are a table that tasks hold. More words than that are joined: texts become slices of about a million
words, a row for each different word of a slice and the documents as numbers of these, and the ratios
come back to the slices. Either way every word beyond the discount has its own ratio.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pandas.util import hash_array
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, spool
from .linedup import small

WORD = re.compile(r"[^\W_]+")
DISCOUNT = 2
WINDOW = 16
TOP = 3
BROADCAST_IDS = 2_000_000
FIRST = np.int64(0x51ED270B)  # stands before a text's first word
COUNT_SLICE = 1_000_000
LEVELS = 14
FULL = 56  # bins of 64
TABLE_WORDS = 1_000_000  # of 16 bytes; beyond that a join
TABLE_PAIRS = 2_000_000  # the same of pairs
KNOWN = 200_000  # words that a task knows at once
SCORE_SLICE = 100_000
SLOTS = 28  # bits of a slot of the filter of pairs
PAIR_COLUMNS = ("pair_doc_ratio", "pair_window_ratio", "pair_top_ratio")
N_FEATURES = 3 + len(PAIR_COLUMNS)
FEATURES = "i long, m binary, " + ", ".join(f"x{k} double" for k in range(N_FEATURES))


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes (SipHash) of words."""
    return hash_array(np.array(words, object), categorize=False).view(np.int64) if words else np.zeros(0, np.int64)


def word_hash(word: str) -> int:
    return int(word_hashes([word])[0])


class Words:
    """Numbers of the words met, from 0, and their hashes, for which all new words are taken at once."""

    def __init__(self):
        self.of, self.hashes = defaultdict(itertools.count().__next__), np.zeros(0, np.int64)

    def numbers(self, text: str | None) -> np.ndarray:
        words = split(text)
        return np.fromiter(map(self.of.__getitem__, words), np.int32, len(words))

    def settle(self) -> np.ndarray:
        """The hashes of the words met since the last time."""
        new = word_hashes(list(itertools.islice(self.of, len(self.hashes), None)))
        self.hashes = np.concatenate([self.hashes, new])
        return new


def split(text: str | None) -> list[str]:
    """The lower-cased words."""
    return WORD.findall(text.lower()) if text else []


def joined(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts the words in turn, the texts' lengths, and the places of first words."""
    lengths = np.array(list(map(len, held)), np.int64)
    return np.concatenate(held).astype(np.int64), lengths, (np.cumsum(lengths) - lengths)[lengths > 0]


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order, and the place of each there."""
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    return keys[order], rank


def bits(v: np.ndarray) -> np.ndarray:
    """31 bits of words."""
    return v & np.int64(0xFFFFFFFE)


def pair_keys(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Keys of pairs of a word and 31 bits of the one before."""
    return w ^ v << np.int64(32)


def level(h: np.ndarray) -> np.ndarray:
    """The level of each hash: k for a share of 3 / 4 ** (k + 1), the last for the rest."""
    rest = (h.view(np.uint64) >> np.uint64(6)).view(np.int64) | np.int64(1 << 2 * (LEVELS - 1))
    return np.log2(rest & -rest).astype(np.int64) // 2


def shared_counts(docs: DataFrame) -> DataFrame:
    """w, follows of the words of (t): the estimated number of different words before it."""
    seen = [f"seen{k}" for k in range(LEVELS)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met, held, size = Words(), [], 0

        def out() -> pd.DataFrame:
            met.settle()
            keys, rank = ranked(met.hashes)
            w, _, starts = joined(held)
            last = np.append(met.hashes, FIRST)
            kinds = (last & np.int64(63)) | (level(last) << np.int64(6))
            v = np.append(np.int64(len(keys)), w[:-1])
            v[starts] = len(keys)
            code = np.unique(rank[w] << np.int64(10) | kinds[v])  # different ones, by word
            key, kind = code >> np.int64(10), code & np.int64(1023)
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            place, at = np.int64(1) << (kind & np.int64(63)), kind >> np.int64(6)
            bins = {n: np.bitwise_or.reduceat(np.where(at == k, place, np.int64(0)), start) for k, n in enumerate(seen)}
            return pd.DataFrame({"w": keys[key[start]], **bins})

        for batch in batches:
            for text in batch["t"]:
                held.append(met.numbers(text))
                size += len(held[-1])
                if size >= COUNT_SLICE:
                    yield out()
                    met, held, size = Words(), [], 0
        if size:
            yield out()

    rows = map_texts(docs.select("t"), run, f"w long, {', '.join(f'{n} long' for n in seen)}")
    total = rows.groupBy("w").agg(*(F.bit_count(F.bit_or(n)).alias(n) for n in seen))
    number = [-64 * F.log(F.lit(1.0) - F.least(F.col(n), F.lit(63)) / 64) for n in seen]
    upon = [sum(number[k + 1 :], number[k]) * float(4**k) for k in range(LEVELS)]
    return total.select("w", F.coalesce(*(F.when(F.col(n) <= FULL, u) for n, u in zip(seen, upon)), upon[-1]).alias("follows"))


def class_counts(docs: DataFrame) -> DataFrame:
    """w, c0, c1, t0, t1, kept of the words of (t, y): the different words before it in ordinary (y = 0) and in toxic (1)
    documents, each document's start being one; how often a word comes after it there; and of the pairs of a class that occur more often than the
    discount the word before (31 bits and the class) with their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met, held, kinds, names, size, nth = Words(), [], [], [], 0, TaskContext.get().partitionId() << 33

        def out() -> pd.DataFrame:
            met.settle()
            keys, rank = ranked(met.hashes)
            lasts, last = ranked(bits(met.hashes))
            n, lengths, starts = joined(held)
            w, y = rank[n], np.repeat(np.array(kinds, np.int64), lengths)
            v = np.append(np.int64(0), last[n[:-1]]) + 1
            v[starts] = len(keys) + 1 + np.arange(len(starts))
            inner = np.ones(len(w), bool)
            inner[np.append(starts[1:], len(w)) - 1] = False  # all but last words stand before others: 0
            most = np.int64(len(keys) + len(starts) + 1)
            code = np.concatenate([(w * most + v) << np.int64(1) | y, (w[inner] * most) << np.int64(1) | y[inner]])
            code, number = np.unique(code, return_counts=True)  # equal words stand together in what is shuffled
            pair, y = code >> np.int64(1), code & np.int64(1)
            own = bits(word_hashes([x for x, m in zip(names, lengths) if m]))
            v = np.concatenate([[0], lasts, own])[pair % most]
            return pd.DataFrame({"w": keys[pair // most], "v": np.where(pair % most == 0, -1 - y, v | y), "n": number})

        for batch in batches:
            for text, y in zip(batch["t"], batch["y"]):
                nth += 1
                held.append(met.numbers(text))
                kinds.append(y)
                names.append(str(nth))
                size += len(held[-1])
                if size >= COUNT_SLICE:
                    yield out()
                    met, held, kinds, names, size = Words(), [], [], [], 0
        if size:
            yield out()

    pairs = map_texts(docs.select("t", F.col("y").cast("int").alias("y")), run, "w long, v long, n long").groupBy("w", "v").agg(F.sum("n").alias("n"))
    pair, toxic, n = F.col("v") >= 0, F.col("v").bitwiseAND(F.lit(1)), F.col("n")
    sums = {"c0": F.when(pair, 1 - toxic), "c1": F.when(pair, toxic), "t0": F.when(F.col("v") == -1, n), "t1": F.when(F.col("v") == -2, n), "n": n}
    own = F.when(pair & (n > DISCOUNT), F.col("v")).alias("own")
    rows = spool(pairs.groupBy("w", own).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items())), "classes")
    kept = rows.filter("own is not null").groupBy("w").agg(F.collect_list(F.struct(F.col("own").alias("v"), "n")).alias("kept"))
    return rows.groupBy("w").agg(*(F.sum(c).alias(c) for c in ("c0", "c1", "t0", "t1"))).join(kept, "w", "left")


def word_counts(docs: DataFrame) -> DataFrame:
    """w, c0, c1, follows, t0, t1, kept of the words of (t, y), where y may be null: as class_counts and shared_counts."""
    both = shared_counts(docs).join(class_counts(docs.filter("y is not null")), "w", "left")
    return both.select("w", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("c0", "c1")), "follows", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("t0", "t1")), "kept")


def features(ratio: np.ndarray) -> list[float]:
    """Mean ratio of a word: over the text, over its window with the highest, over its three highest."""
    if not len(ratio):
        return [0.0, 0.0, 0.0]
    s = np.concatenate([[0.0], ratio.cumsum()])
    window = (s[WINDOW:] - s[:-WINDOW]).max() / WINDOW if len(ratio) >= WINDOW else s[-1] / WINDOW
    top = np.partition(ratio, max(0, len(ratio) - TOP))[-TOP:].sum() / TOP
    return [ratio.mean(), window, top]


def all_features(ratio: np.ndarray, back: np.ndarray, at: np.ndarray, own: np.ndarray) -> list[float]:
    """The features of the words alone, then of pairs: a word's ratio and the backing off of the one before, or the pair's own ratio, at those places."""
    pair = ratio.copy()
    pair[1:] += back[:-1]
    pair[at] = own
    return features(ratio) + features(pair)


def found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `asked` are among the sorted keys, and where there."""
    at = np.minimum(np.searchsorted(keys, asked), max(0, len(keys) - 1))
    some = np.flatnonzero(keys[at] == asked) if len(keys) else at[:0]
    return some, at[some]


def tables(model: Model) -> Broadcast:
    """The model for tasks to hold: sorted keys and values of words, of backing off and of pairs, and the default. It reaches the driver in packed rows, is sent
    out once, and is not kept there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"keys": [batch["k"].to_numpy(np.int64).tobytes()], "held": [batch["x"].to_numpy(float).tobytes()]})

    out = []
    for df in (model.ratios, model.backs, model.pairs):
        key, value = df.columns
        rows = map_texts(df.select(F.col(key).alias("k"), F.col(value).alias("x")), run, "keys binary, held binary").collect()
        keys, values = (np.frombuffer(b"".join(r[c] for r in rows), kind) for c, kind in (("keys", np.int64), ("held", float)))
        del rows
        order = np.argsort(keys)
        out.append((keys[order], values[order]))
    return model.ratios.sparkSession.sparkContext.broadcast((*out, model.default))


def by_table(text: DataFrame, model: Broadcast) -> DataFrame:
    """i, m, x0 to x5: the features of the documents (i, m, t), by the model's tables, which tasks hold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        *words, (keys, own), default = model.value
        shift = np.int64(64 - max(10, len(keys).bit_length() + 3))  # by its first bits a key is mostly known not to be there
        mask = np.int64((1 << 64 - int(shift)) - 1)
        able = np.zeros(int(mask) + 1, bool)
        able[keys >> shift & mask] = True
        met, values, held, rows = Words(), np.zeros((2, 0)), [], []

        def valued(h: np.ndarray) -> np.ndarray:
            """The ratio and the backing off of new words."""
            out = np.stack([np.full(len(h), default), np.zeros(len(h))])
            for x, (of, value), key in zip(out, words, (h, h & np.int64(0xFFFFFFFE))):
                some, at = found(of, key)
                x[some] = value[at]
            return out

        def settle() -> None:
            nonlocal values
            values = np.hstack([values, valued(met.settle())])
            n, lengths, starts = joined(held)
            w, (ratio, back) = met.hashes[n], values[:, n]
            asked = pair_keys(w[1:], bits(w[:-1]))
            some = np.flatnonzero(able[asked >> shift & mask])
            which, at = found(keys, asked[some])
            pair = ratio.copy()
            pair[1:] += back[:-1]
            pair[some[which] + 1] = own[at]
            pair[starts] = ratio[starts]  # no word stands before
            for b, length in zip(np.cumsum(lengths), lengths):
                rows.append(features(ratio[b - length : b]) + features(pair[b - length : b]))

        for batch in batches:
            size, last = 0, len(batch) - 1
            for nth, t in enumerate(batch["t"]):
                held.append(met.numbers(t))
                size += len(held[-1])
                if size >= SCORE_SLICE or nth == last:
                    settle()
                    held.clear()
                    size = 0
                    if len(met.of) > KNOWN:
                        met, values = Words(), np.zeros((2, 0))
            x = np.array(rows).reshape(-1, N_FEATURES)
            rows.clear()
            yield pd.DataFrame({"i": batch["i"].astype("Int64"), "m": batch["m"], **{f"x{k}": x[:, k] for k in range(N_FEATURES)}})

    return map_texts(text.select("i", "m", "t"), run, FEATURES)


def packed(codes: np.ndarray, width: int) -> bytes:
    """The lowest `width` bytes of each code."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpacked(codes: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(codes) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(codes, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel().astype(np.int64)


def slots(pairs: DataFrame) -> np.ndarray:
    """A filter of the keys of pairs: the bits of their slots."""
    slot = F.col("key").bitwiseAND(F.lit((1 << SLOTS) - 1))
    rows = pairs.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << SLOTS - 6, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def slices(text: DataFrame, able: np.ndarray) -> DataFrame:
    """The documents (i, m, t) in slices: for each different word of a slice a row (slice, w, code) with
    width 0; for each different pair that the filter lets through a row (slice, w: its key, code, last: the code of the word before) with
    width -1; for each document a row (slice, i, m) with the codes of its words, each of `width` bytes."""
    able = text.sparkSession.sparkContext.broadcast(able)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def words_of(name: int, w: np.ndarray, code: np.ndarray, last, width: int) -> pd.DataFrame:
            return pd.DataFrame({"slice": name, "w": w, "code": code, "last": last, "i": pd.array([pd.NA] * len(w), "Int64"), "m": None, "width": width, "codes": None})

        def out() -> Iterator[pd.DataFrame]:
            name = uuid.uuid4().int >> 65
            lengths = [len(w) for _, _, w in held]
            own, code = np.unique(np.concatenate([w for _, _, w in held]), return_inverse=True)
            width = max(1, (len(own).bit_length() + 7) // 8)
            yield words_of(name, own, np.arange(len(own)), 0, 0)
            inner = np.ones(len(code), bool)
            inner[np.cumsum([0, *lengths[:-1]])[np.array(lengths) > 0]] = False  # first words of documents
            inner = np.flatnonzero(inner)
            both = np.unique(code[inner - 1] * len(own) + code[inner])
            v, w = (both // max(1, len(own)), both % max(1, len(own)))
            key = pair_keys(own[w], bits(own[v]))
            slot = key & np.int64((1 << SLOTS) - 1)
            some = (able.value[slot >> np.int64(6)] >> (slot & np.int64(63))) & np.int64(1) == 1
            yield words_of(name, key[some], w[some], v[some], -1)
            parts = np.split(code, np.cumsum(lengths)[:-1])
            yield pd.DataFrame({"slice": name, "w": 0, "code": 0, "last": 0, "i": pd.array([i for i, _, _ in held], "Int64"), "m": [m for _, m, _ in held], "width": width, "codes": [packed(x, width) for x in parts]})

        for batch in batches:
            for i, m, t in zip(batch["i"].astype("Int64"), batch["m"], batch["t"]):
                held.append((i, m, word_hashes(split(t))))
                size += len(held[-1][2]) + 1
                if size >= COUNT_SLICE:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    return map_texts(text.select("i", "m", "t"), run, "slice long, w long, code int, last int, i long, m binary, width int, codes binary")


def by_join(text: DataFrame, model: Model) -> DataFrame:
    """As by_table, for any number of words and pairs."""
    default = model.default

    def run(known: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        codes = [unpacked(c, n) for c, n in zip(rows["codes"], rows["width"])]
        size = max((int(c.max()) for c in codes if len(c)), default=0) + 1
        ratios, backs, pairs = (known[known["kind"] == k] for k in range(3))
        ratio, back = np.full(size, default), np.zeros(size)
        for values, of in ((ratio, ratios), (back, backs)):
            values[of["code"].to_numpy(np.int64)] = of["value"].to_numpy(float)
        keys = pairs["last"].to_numpy(np.int64) * size + pairs["code"].to_numpy(np.int64)
        order = np.argsort(keys)
        keys, own = keys[order], pairs["value"].to_numpy(float)[order]
        x = []
        for c in codes:
            which, at = found(keys, c[:-1] * size + c[1:])
            x.append(all_features(ratio[c], back[c], which + 1, own[at]))
        x = np.array(x).reshape(-1, N_FEATURES)
        return pd.DataFrame({"i": rows["i"].astype("Int64"), "m": rows["m"], **{f"x{k}": x[:, k] for k in range(N_FEATURES)}})

    parts = spool(slices(text, slots(model.pairs)), "slices")
    own = parts.filter("width = 0")
    ask = (
        (own, "w", model.ratios),
        (own.withColumn("w", F.col("w").bitwiseAND(F.lit(0xFFFFFFFE))), "v", model.backs),
        (parts.filter("width = -1"), "key", model.pairs),
    )
    known = None
    for kind, (rows, key, table) in enumerate(ask):
        name, value = table.columns
        got = rows.select("slice", "code", "last", "w").join(table.select(F.col(name).alias("w"), F.col(value).alias("value")), "w")
        got = got.select(F.col("slice").alias("of"), "code", "last", F.lit(kind).alias("kind"), "value")
        known = got if known is None else known.unionByName(got)
    rows = parts.filter("width > 0").select("slice", "i", "m", "width", "codes")
    return known.groupBy("of").cogroup(rows.groupBy("slice")).applyInPandas(run, FEATURES)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps on the weighted logistic loss with ridge on the slopes."""
    a, w = np.hstack([np.ones((len(x), 1)), x]), np.zeros(x.shape[1] + 1)
    keep = ridge * np.diag([1e-3] + [1.0] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + keep, a.T @ (weight * (y - p)) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model(NamedTuple):
    """Log-ratios of the classes: (w, ratio) of words, that of all other words; (v, back) of backing off after a word (31 bits), else 0; (key, ratio)
    of pairs."""

    ratios: DataFrame
    default: float
    backs: DataFrame
    pairs: DataFrame


def word_level(counts: DataFrame) -> Model | None:
    """log p(w | toxic) / p(w | ordinary) of all words beyond the discount in either class, and
    that of all others; the same of pairs of words, and of backing off from them; None without words of both classes."""
    kinds = (("n", F.sum), ("taken", lambda c: F.sum(F.least(F.col(c), F.lit(DISCOUNT)))))
    t = counts.agg(F.sum("follows").alias("follows"), *(f(c).alias(f"{c}_{n}") for c in ("c0", "c1") for n, f in kinds)).first()
    n = [t["c0_n"] or 0, t["c1_n"] or 0]
    if not min(n):
        return None
    taken = [t[f"c{k}_taken"] / n[k] for k in (0, 1)]
    # Other words have no more than the shared level in either class, as unknown ones.
    kept = counts.filter((F.col("c0") > DISCOUNT) | (F.col("c1") > DISCOUNT))
    p = [F.greatest(F.col(f"c{k}") - DISCOUNT, F.lit(0)) / float(n[k]) + F.col("follows") * (taken[k] / t["follows"]) for k in (0, 1)]
    return Model(kept.select("w", F.log(p[1] / p[0]).alias("ratio")), float(np.log(taken[1] / taken[0])), *pair_level(counts, p))


def pair_level(counts: DataFrame, p: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(v, back) and (key, ratio) of the highest order: max(n(v, w) - d, 0) / n(v) + left(v) * p(w), where left(v) is what the discount takes after v, and p the
    lower order of both classes. Pairs that no class has beyond the discount only back off."""
    both = (0, 1)
    pairs = counts.filter("kept is not null").select("w", *(p[k].alias(f"p{k}") for k in both), F.explode("kept").alias("x"))
    pairs = pairs.select("w", "p0", "p1", F.col("x.v").bitwiseAND(F.lit(0xFFFFFFFE)).alias("v"), F.col("x.v").bitwiseAND(F.lit(1)).alias("y"), (F.col("x.n") - DISCOUNT).alias("more"))
    more = [F.sum(F.when(F.col("y") == k, F.col("more")).otherwise(0)).alias(f"m{k}") for k in both]
    pairs = spool(pairs.groupBy("w", "v").agg(*more, *(F.first(f"p{k}").alias(f"p{k}") for k in both)), "pairs")
    over = pairs.groupBy("v").agg(*(F.sum(f"m{k}").alias(f"o{k}") for k in both))
    seen = counts.filter("t0 + t1 > 0").groupBy(F.col("w").bitwiseAND(F.lit(0xFFFFFFFE)).alias("v")).agg(*(F.sum(f"t{k}").alias(f"t{k}") for k in both))
    total = [F.greatest(f"t{k}", F.lit(1)) for k in both]
    left = over.join(seen, "v").select("v", *(total[k].alias(f"t{k}") for k in both), *((1 - F.col(f"o{k}") / total[k]).alias(f"l{k}") for k in both))
    left = spool(left, "left")
    high = [F.col(f"m{k}") / F.col(f"t{k}") + F.col(f"l{k}") * F.col(f"p{k}") for k in both]
    key = F.col("w").bitwiseXOR(F.shiftleft("v", 32))
    own = spool(pairs.join(left, "v").select(key.alias("key"), F.log(high[1] / high[0]).alias("ratio")), "ratios")
    return left.select("v", F.log(F.col("l1") / F.col("l0")).alias("back")), own


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, *, id_col: str, text_col: str, toxic_col: str, most: int, seed: int = 3, mark: Column | None = None) -> tuple[DataFrame, np.ndarray] | None:
    """The features (i, m, x0 to x5) of all documents, where m is `mark`, by models of the labelled rows to
    learn from, and the weights of the logistic unit; of every five labelled rows the fifth may go to
    the unit, which takes at most `most` rows of each class, those whose ids hash lowest. All others give counts. None without
    words of both labels."""
    spark = docs.sparkSession
    one = labels.filter(learn_from & F.col(toxic_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("i")).agg(F.max(toxic_col).cast("int").alias("y"))
    one = spool(one.withColumn("o", F.xxhash64(F.lit(seed), F.col("i"))).withColumn("held", F.pmod("o", F.lit(5)) == 4), "labels")
    mark = F.lit(None).cast("binary") if mark is None else mark
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"), mark.alias("m"))
    held = one.filter("held")
    sizes = dict(held.groupBy("y").count().collect())
    some = pd.concat([held.filter(F.col("y") == k).orderBy("o", "i").limit(most).toPandas() for k in (0, 1)])
    chosen = spark.createDataFrame(some[["i", "y"]], "i long, y int")  # at most 2 * most rows
    counted = one.join(F.broadcast(chosen.select("i")), "i", "left_anti").select("i", "y")
    counted = F.broadcast(counted) if counted.count() <= BROADCAST_IDS else counted
    model = word_level(spool(word_counts(text.join(counted, "i", "left")), "words"))
    if model is None:
        return None
    fits = model.ratios.count() <= TABLE_WORDS and model.pairs.count() <= TABLE_PAIRS
    by, model = (by_table, tables(model)) if fits else (by_join, model)
    sample = text.join(F.broadcast(chosen.select("i")), "i", "left_semi")
    x = [f"x{k}" for k in range(N_FEATURES)]
    got = by(sample, model).select("i", *x).toPandas().merge(some[["i", "y"]], on="i")
    weights = np.array([-4.0, 0.5, 0.5, 0.5, 0.0, 0.0, 0.0])
    # The sample holds the classes in other shares than the labels do: rows weigh accordingly.
    if got["y"].nunique() == 2:
        y = got["y"].to_numpy(float)
        share = np.array([sizes[k] / (y == k).sum() for k in (0, 1)])
        weights = fit_logistic(got[x].to_numpy(float), y, share[y.astype(int)])
    return by(text, model), weights


def score(weights: np.ndarray) -> Column:
    z = sum((F.col(f"x{k}") * float(weights[k + 1]) for k in range(N_FEATURES)), F.lit(float(weights[0])))
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column, *, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", most: int = 3000) -> DataFrame:
    """Per row: id, score (0 to 1), predicted (1 from one half on), doc_ratio, window_ratio, top_ratio, and the same of pairs of words.

    `learn_from` is a condition on the rows of `labels`; labels that are null or neither 0 nor 1 are
    left out, and a row labelled both ways counts as toxic. A null or empty text has no ratio: it
    gets the score of ratios zero. Without labels of both classes every score is 0. Null and
    repeated ids stay as they are, one row each. Only the named columns are read; an empty table
    gives no rows; whole texts are scored.
    """
    model = train(docs, labels, learn_from, id_col=id_col, text_col=text_col, toxic_col=toxic_col, most=most)
    if model is None:
        zero = F.lit(0.0)
        return docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), zero.alias("score"), F.lit(0).alias("predicted"), zero.alias("doc_ratio"), zero.alias("window_ratio"), zero.alias("top_ratio"), *(zero.alias(c) for c in PAIR_COLUMNS))
    found, weights = model
    scored = found.withColumn("score", score(weights))
    return scored.select(F.col("i").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("x0").alias("doc_ratio"), F.col("x1").alias("window_ratio"), F.col("x2").alias("top_ratio"), *(F.col(f"x{k}").alias(c) for k, c in enumerate(PAIR_COLUMNS, 3)))


def reject_toxic(docs: DataFrame, labels: DataFrame, learn_from: Column, *, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", most: int = 3000) -> DataFrame:
    """The rows of `docs` whose text scores under one half, with all their columns.

    A null or empty text scores as ratios of zero. Without labels of both classes all rows stay.
    """
    mark = F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")))  # equal texts score equally
    model = train(docs, labels, learn_from, id_col=id_col, text_col=text_col, toxic_col=toxic_col, most=most, mark=mark)
    if model is None:
        return docs
    found, weights = model
    own = f"m_{uuid.uuid4().hex}"
    toxic = spool(found.filter(score(weights) >= 0.5).select(F.col("m").alias(own)).distinct(), "toxic")
    return docs.join(small(toxic, 40), mark == F.col(own), "left_anti")
