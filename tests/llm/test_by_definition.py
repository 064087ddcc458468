"""Fingerprints, languages and the toxicity stage by their definitions, in plain Python that shares no code with the operators."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import pytest

from leadmill.llm import parsing
from leadmill.llm.common import table
from leadmill.llm.queries import QUERIES

from .conftest import prose

BITS = 2**64 - 1


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & BITS
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & BITS
    return x ^ (x >> 31)


def phrases(xs, level):
    y = []
    for v, g in itertools.groupby(xs):
        n = len(list(g))
        y.append(v if n == 1 else mix((v + n * 0xD6E8FEB86659FD93) & BITS))
    label = y
    for _ in range(3):
        new = [label[0] & 1]
        for a, b in itertools.pairwise(label):
            d = a ^ b
            p = (d & -d).bit_length() - 1
            new.append(2 * p + (b >> p & 1))
        label = new
    cuts = [0, *(i for i in range(1, len(y) - 1) if label[i - 1] < label[i] > label[i + 1]), len(y)]
    out = []
    for a, b in itertools.pairwise(cuts):
        total, power = 0, 1
        for v in y[a:b]:
            power = power * 0x9E3779B97F4A7C15 & BITS
            total += mix(v) * power
        out.append(mix((total + level) & BITS))
    return out


def fingerprint(text):
    if not text:
        return ()
    out, xs = [], [mix(ord(c) + 1) for c in text]
    for level in (1, 2, 3, 4):
        xs = phrases(xs, level)
        if level > 1:
            n = Counter(mix(x) >> 32 for x in xs)
            out.append(sorted({mix(h + (k << 32) + 1) >> 32 for h, times in n.items() for k in range(times)})[:24])
    return tuple(out)


def likeness(a, b):
    if not a or not b:
        return float(a == b)
    shares = []
    for x, y in zip(a, b):
        union = sorted({*x, *y})[:24] if len({*x, *y}) > 24 else {*x, *y}
        shares.append(sum(v in x and v in y for v in union) / len(union))
    return sum(shares) / 3


def written(f):
    return "-".join("".join(f"{v:08x}" for v in x) for x in f)


def test_fingerprints(spark, data):
    texts = {r.doc_id: r.text or "" for r in table(spark, data, "documents", "doc_id", "text").collect()}
    got = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, data).collect()}
    assert set(got) == set(texts)
    ids = sorted(texts, reverse=True)
    own = {i: fingerprint(texts[i]) for i in ids}
    for i, following in zip(ids, [*ids[1:], ids[0]]):
        t, n = texts[i], len(texts[i]) // 3
        changed = t[: len(t) - n] + texts[following][:n]
        other = fingerprint(changed)
        x = got[i]
        assert (x.n_chars, x.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (x.fingerprint, x.edited_fingerprint) == (written(own[i]), written(other))
        assert (x.near_edited, x.near_next) == pytest.approx((likeness(own[i], other), likeness(own[i], own[following])))


def test_slices_of_a_text_are_parsed_as_the_whole(monkeypatch):
    r = random.Random(5)
    for _ in range(25):
        letters = r.choice(["ab", "a", "abcdefghij kl", "éü日本x "])
        text = "".join(r.choice(letters) * r.choice([1, 1, 2, 9, 40]) for _ in range(r.randrange(1, 60)))
        for size in (1, 2, 5, 64):
            monkeypatch.setattr(parsing, "SLICE", size)
            assert tuple(x.tolist() for x in parsing.long_fingerprint(text)) == fingerprint(text)


def test_texts_beyond_a_slice(spark):
    r = random.Random(6)
    base = prose(r, 30_000)
    texts = {9: base * 4, 8: "z" * 1_000_000, 7: None, 6: prose(r, 50), 5: base + "é" * 500_000 + base}
    assert sum(len(t or "") > 2 * parsing.SLICE for t in texts.values()) == 3
    got = {x.doc_id: x for x in parsing.fingerprint_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i, text in texts.items():
        assert got[i].fingerprint == written(fingerprint(text))


FOLD = {}


def grams(text):
    """Counts of the bins of three letters, all but letters being one blank."""
    out, run = Counter(), [32]
    for c in text:
        if c not in FOLD:
            FOLD[c] = ord(c.lower()[0]) if c.isalpha() else 32
        if FOLD[c] != 32 or run[-1] != 32:
            run.append(FOLD[c])
    run += [32] * (run[-1] != 32)
    for a, b, c in zip(run, run[1:], run[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA6B ^ c * 0xC2B2AE35) % 2**32
        h = (h ^ (h >> 15)) * 0x27D4EB2F % 2**32
        out[h >> 17] += 1
    return out


def proportions(n, p, langs):
    """Languages join one at a time while the best gain, of all that are not in, pays the penalty."""

    def em(start):
        share, total = dict(start), sum(n.values())
        for _ in range(12):
            new = dict.fromkeys(share, 0.0)
            for g, k in n.items():
                mixed = sum(s * p[x][g] for x, s in share.items())
                for x, s in share.items():
                    new[x] += k * s * p[x][g] / mixed
            share = {x: v / total for x, v in new.items()}
        return share, sum(k * math.log(sum(s * p[x][g] for x, s in share.items())) for g, k in n.items())

    cost = 4.0 * math.log(max(2, sum(n.values())))
    alone = {x: sum(k * math.log(p[x][g]) for g, k in n.items()) for x in langs}
    top = max(langs, key=lambda x: alone[x])
    share, best = {top: 1.0}, alone[top]
    while len(share) < len(langs):
        tried = [em({**{x: 0.8 * s for x, s in share.items()}, lang: 0.2}) for lang in langs if lang not in share]
        new, value = max(tried, key=lambda x: x[1])
        if value - best <= cost:
            break
        share, best = new, value
    return share


def test_languages(spark, data):
    rows = table(spark, data, "documents", "doc_id", "text", "lang").collect()
    counts = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.text is not None and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(grams(r.text))
    langs = sorted(counts)
    total = {x: sum(counts[x].values()) for x in langs}
    average = [sum(counts[x][g] / total[x] for x in langs) / len(langs) * 0.999 + 0.001 / 2**15 for g in range(2**15)]
    p = {x: [(counts[x][g] + 2000 * average[g]) / (total[x] + 2000) for g in range(2**15)] for x in langs}
    got = {x.doc_id: x for x in QUERIES["op3_language"](spark, data).collect()}
    for r in rows:
        x, n = got[r.doc_id], grams(r.text or "")
        if not n:
            assert (x.lang_pred, x.score) == ("und", 0.0)
            continue
        share = proportions(n, p, langs)
        top = max(sorted(share), key=lambda lang: share[lang])
        assert (x.lang_pred, x.n_langs) == (top, len(share)) and x.score == pytest.approx(share[top], abs=1e-6)


def test_the_toxicity_stage_follows_the_scores(spark, data):
    """What stays is what op8_toxicity predicts not to be toxic; its ratios are recomputed in test_queries_by_hand. The smallest
    tables hold too few toxic documents to reject any, so the next size is taken."""
    data = f"{data.rpartition('/')[0]}/sf0.01"
    docs = table(spark, data, "documents")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, data).collect()}
    decided = {r.doc_id: r.predicted for r in QUERIES["op8_toxicity"](spark, data).collect()}
    assert kept == {i for i, toxic in decided.items() if not toxic} and 0 < len(kept) < len(decided)
