"""Scoring looks words up by slices, not one by one, with what looking up each gives."""

import math
from types import SimpleNamespace

import numpy as np
import pandas as pd

from leadmill.llm import toxicity


def scored(monkeypatch, texts, ratios, backs, pairs, default):
    """The features of texts by tables of words and pairs, and the number of searches."""
    tables = [tuple(map(np.array, zip(*sorted(x.items())))) for x in (ratios, backs, pairs)]
    with monkeypatch.context() as m:
        held, searches, plain = [], [], np.searchsorted
        m.setattr(toxicity, "map_texts", lambda df, run, schema: held.append(run))
        m.setattr(np, "searchsorted", lambda *a, **k: (searches.append(1), plain(*a, **k))[1])
        toxicity.by_table(SimpleNamespace(select=lambda *c: None), SimpleNamespace(value=(*tables, default)))
        batches = [pd.DataFrame({"i": range(len(part)), "m": None, "t": part}) for part in (texts[:3], texts[3:])]
        return pd.concat(held[0](iter(batches))).filter(like="x").to_numpy(float), len(searches)


def test_scores_by_slices(monkeypatch):
    names = [f"w{k}" for k in range(3000)]
    h = {w: toxicity.word_hash(w) for w in names}
    ratio = {w: math.sin(k) for k, w in enumerate(names) if k % 3}
    back = {w: math.cos(k) for k, w in enumerate(names) if k % 5}
    texts = [" ".join(names[a : a + n]) for a, n in ((0, 900), (500, 0), (100, 2), (700, 1500), (0, 1), (2200, 800))] + [None]
    pair = {(a, b): math.sin(3 * k) for k, (a, b) in enumerate(zip(names, names[1:])) if k % 2}
    keys = {int(toxicity.pair_keys(np.int64(h[b]), toxicity.bits(np.int64(h[a])))): x for (a, b), x in pair.items()}
    tables = {h[w]: x for w, x in ratio.items()}, {h[w] & 0xFFFFFFFE: x for w, x in back.items()}, keys
    got, searches = scored(monkeypatch, texts, *tables, -0.25)
    for row, text in zip(got, texts):
        words = (text or "").split()
        alone = [ratio.get(w, -0.25) for w in words]
        both = [pair.get((a, b), back.get(a, 0.0) + x) for a, b, x in zip(words, words[1:], alone[1:])]
        want = [f for r in (alone, alone[:1] + both) for f in toxicity.features(np.array(r))]
        assert np.allclose(row, want, atol=1e-12)
    assert searches < 20  # of 3,000 words
    monkeypatch.setattr(toxicity, "SCORE_SLICE", 400)
    monkeypatch.setattr(toxicity, "KNOWN", 1000)
    assert np.array_equal(scored(monkeypatch, texts, *tables, -0.25)[0], got)
