"""Picks in place against a sort, with ties at the cut, odd numbers, and no task that gathers them."""

import math
import random

import pytest

from leadmill.operators import acquire, select, surrogate


def key(row):
    return (math.isnan(row[1]), row[1] if not math.isnan(row[1]) else 0, row[0])


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    odd = [float("nan"), float("inf"), -float("inf"), 1e308, -1e308, 5e-324, 0.0]
    rows = [(i, r.choice([r.gauss(0, 1), 1.0, 1.0, 2.0, *odd])) for i in range(4000)]
    return rows + [(i, None) for i in range(4000, 4040)]


@pytest.mark.parametrize("ranked", [0, 50, 10**6])
@pytest.mark.parametrize("k", [0, 1, 700, 2000, 3999, 4000, 9999])
def test_equal_to_a_sort(spark, rows, k, ranked, monkeypatch):
    monkeypatch.setattr(select, "RANKED", ranked)
    df = spark.createDataFrame(rows, "compound_id long, s double")
    want = sorted((r for r in rows if r[1] is not None), key=key)[:k]
    got = [tuple(r) for r in select.smallest(df, "s", ["compound_id"], k).collect()]
    assert repr(sorted(got, key=key)) == repr(want)


def test_all_equal_scores(spark):
    df = spark.range(5000).selectExpr("id compound_id", "1.5D s")
    assert sorted(r[0] for r in select.smallest(df, "s", ["compound_id"], 1234).collect()) == list(range(1234))
    assert select.smallest(df.limit(0), "s", ["compound_id"], 5).collect() == []


def test_large_picks_leave_no_single_partition(spark, monkeypatch):
    monkeypatch.setattr(acquire, "ONE_TASK", 100)
    monkeypatch.setattr(surrogate, "ONE_TASK", 100)
    df = spark.range(0, 3000, 1, 6).selectExpr("id compound_id", "cast(id % 10 as double) pred_score", "cast(null as double) dock_score", "cast(null as int) query_cycle")
    picked = acquire.pick_to_dock(df, 750)
    sample = surrogate.exact_sample(df, 750, 3, "compound_id")
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in (picked, sample)):
        assert "TakeOrderedAndProject" not in plan and "SinglePartition" not in plan and "GlobalLimit" not in plan
    want = sorted((i % 10, i) for i in range(3000))[:750]
    assert sorted((r.pred_score, r.compound_id) for r in picked.collect()) == want
    clusters = df.selectExpr("compound_id", "compound_id div 2 cluster_id")
    got = acquire.pick_to_dock(df, 150, clusters).collect()
    best = sorted(min((i % 10, i) for i in (2 * c, 2 * c + 1)) for c in range(1500))[:150]
    assert sorted((r.pred_score, r.compound_id) for r in got) == best
    monkeypatch.setattr(surrogate, "ONE_TASK", 10**6)
    one = surrogate.exact_sample(df, 750, 3, "compound_id")
    assert sorted(r.compound_id for r in sample.collect()) == sorted(r.compound_id for r in one.collect())
