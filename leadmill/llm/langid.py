"""Language identification by multilingual mixture inference.

Each language has a distribution over hashed character trigrams, counted over all training documents
and smoothed with the average of the languages. A document is a mixture: expectation-maximisation finds the
proportions of the languages in it from its trigram counts. The set of languages starts with the
likeliest one and takes in, one at a time, the language that raises the likelihood most, as long as the
rise exceeds a penalty (a multiple of half the logarithm of the number of trigrams). As the likelihood is
concave in a proportion, its slope at zero bounds the rise: most languages are refused by that alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

BITS = 15
BINS = 1 << BITS
MOST_LANGUAGES = 256  # of 256 KB in a task
BLANK = 32
TABLE = 0x20000
SLICE = 1 << 20
UNKNOWN = "und"

_folded: np.ndarray | None = None


def folded() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else a blank."""
    global _folded
    if _folded is None:
        _folded = np.array([ord(chr(i).lower()[0]) if chr(i).isalpha() else BLANK for i in range(TABLE)], np.uint32)
    return _folded


def letters(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = folded()[np.minimum(points, TABLE - 1)]
    for i in np.flatnonzero(points >= TABLE):
        out[i] = points[i] if chr(points[i]).isalpha() else BLANK
    return out


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the text's trigrams and their counts; none if it has no letter. Runs of anything
    but letters count as one blank."""
    total = np.zeros(BINS, np.int64)
    last = np.array([BLANK], np.uint32)
    for at in range(0, len(text), SLICE):
        x = np.concatenate([last, letters(text[at : at + SLICE])])
        if at + SLICE >= len(text):
            x = np.append(x, np.uint32(BLANK))
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != BLANK) | (x[:-1] != BLANK)
        x = x[keep]
        last = x[-2:]
        if len(x) < 3:
            continue
        h = x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F)
        total += np.bincount(h >> np.uint32(32 - BITS), minlength=BINS)
    bins = np.flatnonzero(total)
    return bins, total[bins]


def count_languages(docs: DataFrame, *, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """The languages, and the trigram counts of all documents of each: BINS numbers a language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["t"], batch["l"]):
                bins, n = trigrams(text)
                if len(bins):
                    sums.setdefault(lang, np.zeros(BINS, np.int64))[bins] += n
        for lang, total in sums.items():
            bins = np.flatnonzero(total)
            yield pd.DataFrame({"l": lang, "b": bins.astype(np.int32), "n": total[bins]})

    rows = docs.select(F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("l")).filter("t is not null and l is not null")
    if rows.select("l").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} holds more than {MOST_LANGUAGES} languages: every task holds the counts of all of them")
    got = map_texts(rows, run, "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["l"].unique())
    counts = np.zeros((len(langs), BINS))
    counts[got["l"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int), got["b"].to_numpy()] = got["n"].to_numpy()
    return langs, counts


def probabilities(counts: np.ndarray, weight: float = 2000.0) -> np.ndarray:
    """BINS x languages: counts smoothed with `weight` trigrams of the languages' average."""
    if not len(counts):
        return np.zeros((BINS, 0))
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    average = share.mean(axis=0) * (1 - 1e-3) + 1e-3 / BINS
    return ((counts + weight * average) / (counts.sum(axis=1, keepdims=True) + weight)).T.copy()


def mixture(p: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log-likelihood."""
    share, total = start, n.sum()
    for _ in range(rounds):
        mixed = p @ share
        share = share * (p.T @ (n / mixed)) / total
    return share, float(n @ np.log(p @ share))


def infer(bins: np.ndarray, n: np.ndarray, probs: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
    """The proportions of all languages in a document, zero outside the chosen set."""
    p, n = probs[bins], n.astype(float)
    single = n @ np.log(p)
    chosen, best, cost = [int(single.argmax())], float(single.max()), penalty * 0.5 * np.log(max(2.0, n.sum()))
    share = np.ones(1)
    while len(chosen) < p.shape[1]:
        mixed = p[:, chosen] @ share
        rise = p.T @ (n / mixed) - n.sum()  # the slope at zero: no language can add more
        found = None
        for lang in np.flatnonzero(rise > cost):
            if lang not in chosen:
                new, value = mixture(p[:, [*chosen, lang]], n, np.append(share * 0.8, 0.2), rounds)
                if value - best > cost and (found is None or value > found[1]):
                    found = ([*chosen, int(lang)], value, new)
        if found is None:
            break
        chosen, best, share = found
    out = np.zeros(p.shape[1])
    out[chosen] = share
    return out


def identify(docs: DataFrame, learn_from: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", penalty: float = 8.0, rounds: int = 12) -> DataFrame:
    """Per row: id, lang_pred, score (the proportion of that language), n_langs, mixture (lang=share).

    Learns from the rows of `docs` for which `learn_from` holds, with text and language; labels are
    no input of a prediction. More than 256 languages are refused with ValueError. A text that is null or has no letter is `und` with score 0, as is every
    text if no language could be learned; ties go to the language first by name. Null and repeated
    ids stay as they are, one row each. Only the named columns are read; an empty table gives no
    rows; long texts count whole, in slices.
    """
    langs, counts = count_languages(docs.filter(learn_from), text_col=text_col, lang_col=lang_col)
    probs = probabilities(counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["t"]:
                bins, n = trigrams(text or "")
                if not len(bins) or not langs:
                    rows.append((UNKNOWN, 0.0, 0, ""))
                    continue
                share = infer(bins, n, probs, penalty, rounds)
                top = int(share.argmax())
                parts = [f"{langs[i]}={share[i]:.4f}" for i in np.argsort(-share, kind="stable") if share[i] > 0]
                rows.append((langs[top], min(1.0, float(share[top])), len(parts), " ".join(parts)))
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "n_langs", "mixture"])
            out.insert(0, "id", batch["i"].astype("Int64"))
            yield out

    source = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return map_texts(source, run, "id long, lang_pred string, score double, n_langs int, mixture string").withColumnRenamed("id", id_col)
