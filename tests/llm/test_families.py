"""Families of near copies, each close to one text and far from the others: most of their links are found inside groups."""

import random

import numpy as np
import pandas as pd
import pytest

from leadmill.llm import minhash

from .conftest import prose
from .test_brute_force import jaccard_components


def family(r, copies):
    """A text, and copies of it with five other words each: 0.82 like the text, and about 0.66 like each other."""
    base = prose(r, 200).split()
    texts = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for at in r.sample(range(4, 196), 5):
            words[at] = f"w{r.randrange(10**9)}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("block", [2000, 1_000_000])
def test_families_are_whole(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    r = random.Random(17)
    texts = [t for copies in (1, 5, 25, 80) for t in family(r, copies)]
    r.shuffle(texts)
    rows = dict(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), size=4).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == jaccard_components(rows, 4, 80)


def test_links_of_hashed_sets():
    """Sets as tasks hold them: hashes in the order of unsigned numbers, held as signed ones."""
    hashes, r = minhash.memo(), random.Random(5)
    sets = [minhash.shingles(t, 4, hashes).astype(np.int64) for t in family(r, 30)]
    assert (sets[0][1:] < sets[0][:-1]).any()
    m, same = len(sets), np.zeros(minhash.FUNCTIONS, np.uint8).tobytes()
    g = pd.DataFrame({"k": range(m), "n": [len(s) for s in sets], "c": range(m), "far": [True] * m, "part": [0] * m, "signature": [same] * m, "s": sets})
    links = minhash.joining_links(g, 80)
    whole = [set(s.tolist()) for s in sets]
    assert all(100 * len(whole[a] & whole[b]) >= 80 * len(whole[a] | whole[b]) for a, b in links)
    alike = [b for b in range(1, m) if 100 * len(whole[0] & whole[b]) >= 80 * len(whole[0] | whole[b])]
    assert len(alike) == 30 and len(links) == 30
