"""Links inside a group against all pairs, and their cost where nearly all text is shared."""

import random
import time

import numpy as np
import pandas as pd
import pytest

from leadmill.llm import minhash


def group(sets, c, far, part):
    """Signatures that leave every pair to the full sets."""
    same = np.zeros(minhash.FUNCTIONS, np.uint8).tobytes()
    arrays = [np.array(sorted(s), np.int64) for s in sets]
    return pd.DataFrame({"k": range(len(sets)), "n": [len(s) for s in sets], "c": c, "far": far, "part": part, "signature": [same] * len(sets), "s": arrays})


def joined(n, c, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    first = {}
    for x in range(n):  # rows of one component are one from the start
        a, b = find(x), find(first.setdefault(c[x], x))
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(12))
def test_links_join_what_all_pairs_join(seed):
    r = random.Random(seed)
    sets = []
    for _ in range(60):
        if sets and r.random() < 0.8:
            s = set(r.choice(sets))
            for x in r.sample(sorted(s), r.randrange(0, 1 + len(s) // 6)):
                s.discard(x)
                if r.random() < 0.7:
                    s.add(r.randrange(10**6))
            sets.append(s or {1})
        else:
            sets.append({r.randrange(10**6) for _ in range(r.randrange(1, 60))})
    c = [r.randrange(60) if r.random() < 0.5 else i for i in range(60)]
    far = [r.random() < 0.5 for _ in range(60)]
    part = [r.randrange(2) if seed % 2 else 0 for _ in range(60)]
    two = len(set(part)) == 2
    links = minhash.joining_links(group(sets, c, far, part), 80)
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    every = [(a, b) for a in range(60) for b in range(a) if (far[a] or far[b]) and (part[a] != part[b] or not two) and alike(a, b)]
    assert all(alike(a, b) for a, b in links)
    assert joined(60, c, links) == joined(60, c, every)
    assert len(links) < 60


def test_shared_text_costs_in_proportion():
    """Sets that share four fifths of what they hold, just under the threshold: no links, and twice the sets take about twice the time."""

    def cost(m):
        r = np.random.default_rng(1)
        base = set(r.integers(0, 2**62, 300).tolist())
        g = group([base | set(r.integers(0, 2**62, 80).tolist()) for _ in range(m)], range(m), [True] * m, [0] * m)
        start = time.process_time()
        assert minhash.joining_links(g, 80) == []
        return time.process_time() - start

    cost(500)
    assert min(cost(8000) for _ in range(2)) < 2.5 * min(cost(4000) for _ in range(2))
