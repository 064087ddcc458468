"""Steps that are whole or not at all, clusters that grow, similarity joins by the index and from a store."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.jobs import screening
from leadmill.operators import cluster, similarity
from leadmill.schema import Settings
from leadmill.store import Campaign, file_system

from .test_screening import numbered, prepare, score, search

FPS = "id long, fp array<long>, n long"


def sparse(r, words=32, bits=40):
    return sorted(r.sample(range(32 * words), bits))


def packed(bits, words=32):
    fp = [0] * words
    for b in bits:
        fp[b // 32] |= 1 << (b % 32)
    return fp


def families(seed, n, words=32, bits=40, changes=8):
    """n sets of bits, of which many are near others; some equal, one empty."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        if out and r.random() < 0.7:
            bits_of = set(r.choice(out))
            for b in r.sample(sorted(bits_of), min(len(bits_of), r.randrange(0, changes))):
                bits_of.discard(b)
                bits_of.add(r.randrange(32 * words))
        else:
            bits_of = set(sparse(r, words, bits))
        out.append(frozenset(bits_of))
    out[n // 2] = frozenset()
    return out


def table(spark, sets, start=1, words=32):
    return spark.createDataFrame([(start + i, packed(s, words), len(s)) for i, s in enumerate(sets)], FPS)


def alike(a, b, percent):
    return bool(a or b) and 100 * len(a & b) >= percent * len(a | b)


def sequential(sets, percent):
    """id -> (leader, sim) by a pass in id order."""
    led = []
    for i, s in enumerate(sets, 1):
        if not any(alike(s, sets[j - 1], percent) for j in led):
            led.append(i)
    best = {i: (i, 1.0) for i in led}
    for i, s in enumerate(sets, 1):
        if i not in best:
            near = [(-len(s & sets[j - 1]) / len(s | sets[j - 1]), j) for j in led if alike(s, sets[j - 1], percent)]
            best[i] = (min(near)[1], -min(near)[0])
    return best


def clusters_of(df):
    return {r.compound_id: (r.cluster_id, r.sim) for r in df.collect()}


@pytest.mark.parametrize("percent", [30, 60, 85])
def test_index_finds_all_pairs_once(spark, percent, monkeypatch):
    monkeypatch.setattr(similarity, "LISTED", 20)  # frequent bits are dealt over parts
    sets = families(1, 200)
    df = table(spark, sets)
    got = sorted((r.q, r.h, r.sim) for r in similarity.indexed_pairs(df.filter("id % 3 = 0"), df, percent).collect())
    want = [(q, h, len(a & b) / len(a | b)) for q, a in enumerate(sets, 1) for h, b in enumerate(sets, 1) if q % 3 == 0 and q != h and alike(a, b, percent)]
    assert got == sorted(want)


def test_many_queries_shuffle_in_proportion_to_rows(spark, monkeypatch):
    """10,000 queries meet twice as many rows: the joined lists grow with the rows, not with their product."""
    monkeypatch.setattr(similarity, "BROADCAST_BYTES", 1 << 20)
    r = random.Random(2)
    sets = [frozenset(sparse(r, 8, 24)) for _ in range(5000)]
    sets += [frozenset(list(s)[:-2]) for s in sets]
    df = table(spark, sets, words=8)
    queries = df.unionByName(df.selectExpr("id + 20000 id", "fp", "n")).filter("id <= 10000")
    assert queries.count() == 10_000
    pairs = similarity.similar_pairs(queries, df, 80)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "rare" in plan and "BroadcastNestedLoop" not in plan and "CartesianProduct" not in plan
    got = {(x.q, x.h) for x in pairs.collect()}
    assert got == {(i, i + 5000) for i in range(1, 5001)} | {(i + 5000, i) for i in range(1, 5001)}


@pytest.mark.parametrize("percent", [40, 70])
def test_leaders_as_in_sequence(spark, percent, monkeypatch):
    sets = families(3, 260, words=4, bits=30)
    for batch in (8192, 30):
        monkeypatch.setattr(cluster, "BATCH", batch)
        got = sorted(r.id for r in cluster.leaders(table(spark, sets, words=4), percent, batch).collect())
        want = sequential(sets, percent)
        assert got == sorted({lead for lead, _ in want.values()})
    assert clusters_of(cluster.leader_clusters(table(spark, sets, words=4), percent)) == want


def test_clusters_grow_as_if_made_anew(spark):
    sets = families(4, 400, words=4, bits=30)
    rows = table(spark, sets, words=4)
    clusters = cluster.leader_clusters(rows.filter("id <= 100"), 55)
    for upto in (200, 201, 400):
        clusters = cluster.grown_clusters(spark.createDataFrame(clusters.collect(), clusters.schema), rows.filter(F.col("id") <= upto), 55)
        assert clusters_of(clusters) == sequential(sets[:upto], 55)


def test_store_reads_what_the_threshold_leaves(spark, tmp_path):
    r = random.Random(5)
    sets = [frozenset(r.sample(range(128), r.randrange(1, 100))) for _ in range(400)]
    df = table(spark, sets, words=4)
    similarity.write_store(df, f"file://{tmp_path}/store", 8)
    queries = df.filter("id % 40 = 0 and n between 40 and 50")
    assert queries.count() > 0
    files = []
    for percent in (20, 50, 80):
        before = {(x.q, x.h) for x in similarity.similar_pairs(queries, df, percent).collect()}
        pairs = similarity.stored_pairs(queries, f"file://{tmp_path}/store", 8, percent)
        assert {(x.q, x.h) for x in pairs.collect()} == before
        files.append(scanned_files(pairs, "store"))
    assert files[0] > files[1] > files[2] > 0


def scanned_files(df, part):
    """Files that the scan of a table read, by its own metric."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "FileSourceScanExec" and part in node.relation().location().rootPaths().mkString():
            found += node.metrics().apply("numFiles").value()
    return found


class Broken(RuntimeError):
    pass


class Faulty(Campaign):
    """Fails at every write and every publication of a cycle and of docking once, after half of it."""

    failed: set = set()

    def _fail(self, what):
        key = (what, self.progress())
        if key not in self.failed and self.progress() in (1, 4):  # the first cycle, and docking
            self.failed.add(key)
            raise Broken(str(key))

    def write(self, name, df):
        number = sum(1 for n in (self._pending or {}) if n == name), (self._pending or {}).get(name) is not None
        version = (self._folders(name) or [0])[-1] + 1
        try:
            self._fail((name, number))
        except Broken:
            fs, where = file_system(self.spark, f"{self.path}/{name}/v={version}/_temporary")
            fs.mkdirs(where)
            raise
        return super().write(name, df)

    def _publish(self, versions):
        self._fail(("publish", tuple(sorted(versions))))
        super()._publish(versions)


def contents(campaign):
    names = ("compounds", "clusters", "counters", "progress", "models")
    drop = ("path",)
    return {n: sorted((tuple(r) for r in campaign.read(n).drop(*drop).collect()), key=repr) for n in names}


def test_a_round_goes_on_after_every_broken_write(spark, tmp_path):
    settings = Settings(queries_per_cycle=4, docked_per_round=5)
    paths = [f"file://{tmp_path}/{n}" for n in ("whole", "broken")]
    for path in paths:
        screening.import_seeds(Campaign(spark, path), numbered(spark), prepare, docked=True, settings=settings)
    whole = Campaign(spark, paths[0])
    screening.screening_round(whole, search, prepare, score, settings)
    Faulty.failed, breaks = set(), 0
    while True:
        try:
            screening.screening_round(Faulty(spark, paths[1]), search, prepare, score, settings)
            break
        except Broken:
            breaks += 1
            half = Campaign(spark, paths[1])  # what others read meanwhile is a whole step's state
            assert half.read("compounds").count() == half.read("clusters").count()
            assert half.read("compounds").agg(F.max("query_cycle")).first()[0] in (None, half.counters()["cycle"])
    assert breaks >= 7
    broken = Campaign(spark, paths[1])
    assert contents(broken) == contents(whole)
    broken.clean()
    assert all(len(broken.versions(n)) == 1 == len(broken._folders(n)) for n in ("compounds", "clusters", "counters"))
    assert contents(broken) == contents(whole)


def test_half_written_versions_do_not_count(spark, tmp_path):
    campaign = Campaign(spark, f"file://{tmp_path}/c")
    campaign.write("t", spark.range(3))
    (tmp_path / "c" / "t" / "v=2" / "_temporary").mkdir(parents=True)
    assert campaign.read("t").count() == 3 and campaign.versions("t") == [1]
    campaign.write("t", spark.range(5))
    assert campaign.read("t").count() == 5 and campaign.versions("t") == [1, 3]
    with pytest.raises(Broken), campaign.step():
        campaign.write("t", spark.range(7))
        assert campaign.read("t").count() == 7
        raise Broken
    assert campaign.read("t").count() == 5


def dense(n, seed=6, bits=64):
    """Half of the bits each, with copies and near copies, and one set without a bit."""
    r = random.Random(seed)
    sets = [frozenset(r.sample(range(bits), r.randrange(24, 41))) for _ in range(n - n // 4 - 1)]
    return [*sets, frozenset(), *(frozenset(list(r.choice(sets))[r.randrange(2) :]) for _ in range(n // 4))]


def by_tanimoto(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("percent", [35, 60, 90])
def test_dense_rows_meet_in_blocks_once(spark, percent, monkeypatch):
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 70)
    monkeypatch.setattr(similarity, "QUERY_TILE", 16)
    monkeypatch.setattr(similarity, "ROW_TILE", 32)
    sets = dense(300)
    pairs = similarity.self_pairs(table(spark, sets, words=2), percent)
    assert "rare" not in pairs._jdf.queryExecution().executedPlan().toString()  # lists would hold more than all pairs
    want = [(q, h, by_tanimoto(a, b)) for q, a in enumerate(sets, 1) for h, b in enumerate(sets, 1) if q < h and alike(a, b, percent)]
    assert sorted((r.q, r.h, r.sim) for r in pairs.collect()) == want
    df = table(spark, sets, words=2)
    got = sorted((r.q, r.h, r.sim) for r in similarity.block_pairs(df.filter("id % 3 = 0"), df, percent).collect())
    assert got == [(q, h, by_tanimoto(a, b)) for q, a in enumerate(sets, 1) for h, b in enumerate(sets, 1) if q % 3 == 0 and q != h and alike(a, b, percent)]


def test_sparse_rows_still_meet_by_the_index(spark):
    r = random.Random(3)
    df = table(spark, [frozenset(sparse(r, 8, 24)) for _ in range(3000)], words=8)
    assert "rare" in similarity.self_pairs(df, 80)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k, percent", [(1, 0), (5, 0), (5, 60), (400, 0)])
def test_top_rows_of_each_query(spark, k, percent, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 90)
    monkeypatch.setattr(similarity, "QUERY_TILE", 16)
    sets = dense(320, seed=8)
    df = table(spark, sets, words=2)
    found = similarity.top_per_query(df.filter("id % 4 = 0"), df, k, percent)
    want = []
    for q, a in enumerate(sets, 1):
        if q % 4 == 0:
            near = sorted((-by_tanimoto(a, b), h) for h, b in enumerate(sets, 1) if h != q and a | b and 100 * len(a & b) >= percent * len(a | b))
            want += [(q, h, -s, at) for at, (s, h) in enumerate(near[:k], 1)]
    assert sorted((r.q, r.h, r.sim, r.rank) for r in found.collect()) == sorted(want, key=lambda x: (x[0], x[1]))


def test_blocks_yield_the_top_rows_only(spark):
    """Of all pairs of two blocks k a query leave them, exactly the best, with fingerprints of 64 and of 2,560 bits."""
    for words, k in ((2, 5), (80, 3)):
        sets = [frozenset(random.Random(i).sample(range(32 * words), 14 * words)) for i in range(300)]
        bits = [np.array([packed(s, words) for s in sets], np.uint32).tobytes(), np.array([len(s) for s in sets]).tobytes(), np.arange(300).tobytes()]
        block = similarity.Block(0, bits[2], bits[1], bits[0])
        got = [x for a, b, sim in similarity.most_similar(block, block, k, 0) for x in zip(a.tolist(), b.tolist(), sim.tolist())]
        want = [(q, h, -s) for q, a in enumerate(sets) for s, h in sorted((-by_tanimoto(a, b), h) for h, b in enumerate(sets) if h != q)[:k]]
        assert got == want


def test_rows_meet_their_nearest_centre_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 90)
    sets = dense(320, seed=8)
    df = table(spark, sets, words=2)
    got = similarity.assign_to_nearest(df.filter("id % 9 = 0"), df)
    want = []
    for h, b in enumerate(sets, 1):
        near = min((-by_tanimoto(a, b), q) for q, a in enumerate(sets, 1) if q % 9 == 0 and (a or b)) if h % 9 else (-1.0, h)
        want.append((h, near[1], -near[0]))
    assert "band" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(similarity, "FEW_PAIRS", 0)
    for found in (got, similarity.assign_to_nearest(df.filter("id % 9 = 0"), df)):
        assert sorted((r.h, r.q, r.sim) for r in found.collect()) == want
