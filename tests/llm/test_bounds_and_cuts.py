"""What the bounds of the search leave, and the cost of cutting long texts."""

import time

import numpy as np
import pytest

from leadmill.llm import packing, topk


def whole_table(data):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{data}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pydict()
    return np.array(t["vec_id"]), np.floor(256 * np.array(t["embedding"], float))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_bounds_leave_few_rows(data, sf):
    ids, x = whole_table(f"{data.rpartition('/')[0]}/{sf}")
    search = topk.Search(ids, x, topk.turned(x[:2048]))
    for i in np.flatnonzero(ids % 50 == 0):
        rows, score = search.best(ids[i], x[i], 5)
        order = np.lexsort((ids[rows], -score))[:5]
        exact = x @ x[i]
        others = np.flatnonzero(ids != ids[i])
        want = others[np.lexsort((ids[others], -exact[others]))[:5]]
        assert ids[rows][order].tolist() == ids[want].tolist()
    if sf == "sf0.1":
        assert search.scored / search.met < 0.1


def test_bounds_hold_at_every_level():
    r = np.random.default_rng(1)
    x, q = np.floor(r.normal(0, 90, (300, 24))), np.floor(r.normal(0, 90, 24))
    for turn in (None, topk.turned(x)):
        search = topk.Search(np.arange(300), x, turn)
        yq = (q if turn is None else q @ turn)[None]
        last = np.full(300, np.inf)
        for n, (front, tail) in enumerate(zip(search.fronts, search.tails), 1):
            bound = np.hstack(search.parts[:n]) @ yq[0, :front] + tail @ topk.tail_statistics(yq, front)[0]
            assert (bound >= x @ q - 1e-6).all()
            last = bound
        assert (last < np.abs(q).sum() * np.abs(x).max()).all()


def test_long_texts_are_cut_in_linear_time():
    ids = np.arange(16_000_000, dtype=np.uint32).tobytes()
    start = time.process_time()
    cut = [(p.start, p.length) for s in packing.pack([packing.Piece(0, 0, 16_000_000, 16_000_000, 16_000_000, ids)], packing.Limits(), cut=True) for p in s]
    assert time.process_time() - start < 2
    assert sum(n for _, n in cut) == 16_000_000 and all(a + n == b for (a, n), (b, _) in zip(sorted(cut), sorted(cut)[1:]))


def test_a_waiting_rest_holds_only_its_own_ids():
    ids = np.arange(10_001, dtype=np.uint32).tobytes()
    packer_pieces = [packing.Piece(k, 0, 10_001, 10_001, 10_001, ids) for k in range(300)]
    got = {}
    for s in packing.pack(packer_pieces, packing.Limits(), cut=True):
        for p in s:
            got.setdefault(p.key, {})[p.start] = bytes(p.ids)
    assert all(b"".join(v for _, v in sorted(pieces.items())) == ids for pieces in got.values()) and len(got) == 300
