"""Ties, nulls, NaN, empty inputs: the cases that a campaign meets."""

import math
import random

import pytest
from pyspark.sql import functions as F

from leadmill.operators import acquire, cluster, filters, merge, similarity, surrogate
from leadmill.schema import CLUSTERS, COMPOUNDS

STATE = "compound_id long, smilesid string, dock_score double, pred_score double, query_cycle int, dock_iteration int"


@pytest.fixture
def state(spark):
    rows = [(1, "a", None, -5.0, None, None), (2, "b", None, -5.0, None, None), (3, "c", -7.0, -9.0, None, 1), (4, "d", None, None, None, None), (5, "e", -7.0, None, 1, 1), (6, "f", float("nan"), None, None, 0), (7, "g", None, -6.0, 2, None)]
    return spark.createDataFrame(rows, STATE)


def ids(df):
    return [r[0] for r in df.collect()]


def test_greedy_picks_break_ties_by_id(state):
    assert ids(acquire.pick_to_dock(state, 2)) == [7, 1]
    assert ids(acquire.pick_queries(state, 9, predicted=True)) == [1, 2]
    assert ids(acquire.pick_queries(state, 9, predicted=False)) == [3, 6]  # NaN is a score, the worst
    assert ids(acquire.greedy(state, acquire.CANDIDATE, "pred_score", -1)) == [7, 1, 2]
    assert sorted(ids(acquire.undocked(state))) == [1, 2, 4, 7]


def test_cluster_picks_lose_unclustered_rows(spark, state):
    clusters = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], CLUSTERS)
    assert [tuple(r) for r in acquire.pick_to_dock(state, 5, clusters).collect()] == [(1, 10, -5.0)]


def test_marks_touch_only_picked_rows(state):
    marked = acquire.mark_queries(state, acquire.pick_to_dock(state, 1), 9)
    assert {r.compound_id: r.query_cycle for r in marked.collect()} == {1: None, 2: None, 3: None, 4: None, 5: 1, 6: None, 7: 9}


def test_best_score_skips_nan_but_keeps_the_title(spark, state):
    nan = float("nan")
    results = spark.createDataFrame([(1, nan), (1, -3.0), (2, nan), (2, nan)], "title long, score double")
    best = merge.best_score_per_title(results, "title", "score")
    assert {r[0]: r[1] for r in best.collect()} == {1: -3.0, 2: None}
    after = {r.compound_id: (r.dock_score, r.dock_iteration) for r in merge.store_scores(state, best, 4).collect()}
    assert after[1] == (-3.0, 4) and after[2] == (None, 4) and after[3] == (-7.0, 1) and math.isnan(after[6][0])


def test_training_set_leaves_out_nan(state):
    assert {r[0] for r in surrogate.training_set(state, 10.0).collect()} == {"c", "e"}


def test_similarities_are_null_where_a_method_found_nothing(spark):
    hits = spark.createDataFrame([("a", 1, 5, 0.6), ("a", 1, 6, 0.7), ("b", 2, 7, 0.9), ("a", 2, 9, 0.5)], "method string, k long, title long, sim double")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    got = {r.id: (r.sim_a, r.sim_b) for r in merge.attach_similarities(rows, hits, "id").collect()}
    assert got == {1: (0.7, None), 2: (0.5, 0.9), 3: (None, None)}
    assert {r.k: (r.title, r.method) for r in merge.first_title(hits).collect()} == {1: (5, "a"), 2: (9, "a")}
    assert merge.overlap_counts(hits.limit(0)).first().asDict() == {"n_a": 0, "n_b": 0, "only_a": 0, "only_b": 0}


def test_anti_join_keeps_null_keys_and_copies(spark):
    hits = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "h string")
    assert sorted(str(r[0]) for r in merge.not_known(hits, spark.createDataFrame([("y",), (None,)], "h string"), "h").collect()) == ["None", "x", "x"]


@pytest.mark.parametrize("n", [0, 1, 149])
def test_dense_ids_and_chunks_lose_no_row(spark, n):
    rows = spark.range(n).select((F.col("id") * 7).alias("key"))
    got = merge.with_dense_ids(rows, "key", 100).orderBy("key").collect()
    assert [r.new_id for r in got] == list(range(101, 101 + n))
    assert surrogate.chunks(rows, "key", 10).filter("chunk is not null").count() == n


def test_export_names_and_cutoff(spark, state):
    clusters = spark.createDataFrame([(3, 1), (6, 1)], CLUSTERS)
    assert [(r.smilesid, r.dock_score) for r in merge.export(state, clusters, -7.0).collect()] == [("c/3", -7.0)]


def test_tail_split_and_scaling(spark):
    split = {r[0]: r[1] for r in surrogate.tail_split(spark.range(25).withColumnRenamed("id", "i"), "i").collect()}
    assert [i for i in split if split[i] == "val"] and {i for i in split if split[i] == "val"} == {23, 24}
    assert surrogate.scaling(spark.range(3).select(F.lit(2.0).alias("y")), "y") == (2.0, 1.0)
    assert surrogate.exact_sample(spark.range(9), 4, 1, "id").count() == 4


def test_ranges_include_their_ends(spark):
    rows = spark.createDataFrame([(0.0,), (500.0,), (500.1,), (None,)], "mw double")
    assert [r[0] for r in rows.filter(filters.within({"mw": (0, 500)})).collect()] == [0.0, 500.0]


def test_text_helpers(spark):
    lines = spark.createDataFrame([("FORCEFIELD x",), ("  GRIDFILE y",), ("",), ("  ",), ("PRECISION z",)], "value string")
    assert [r[0] for r in filters.template_lines(lines).collect()] == ["FORCEFIELD x", "PRECISION z"]
    assert filters.has_any(lines, ("GRIDFILE", "X")) and not filters.has_any(lines, ("NOPE",))
    record = spark.createDataFrame([("h§CCO§a§b",), ("h§C",)], "r string").select(filters.split_record(F.col("r")).alias("s")).select("s.*")
    assert [tuple(r) for r in record.collect()] == [("h", "CCO", "a§b"), ("h", "C", None)]
    text = spark.createDataFrame([("/x/job.v1.dbsh", "run_iter12", "1e3"), ("job", "run", "abc")], "p string, n string, v string")
    got = text.select(filters.job_name(F.col("p")), filters.iteration_of(F.col("n")), filters.is_number(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("job", 12, True), ("job", None, False)]
    with pytest.raises(ValueError):
        filters.require(lines, "missing")


def sequential(fps, percent):
    lead, own = [], {}
    for i, f in sorted(fps.items()):
        if not any(100 * (f & g).bit_count() >= percent * (f | g).bit_count() and f | g for _, g in lead):
            lead.append((i, f))
    for i, f in fps.items():
        best = max(((f & g).bit_count() / (f | g).bit_count() if f | g else 0.0, -j) for j, g in lead)
        own[i] = i if (i, f) in lead else -best[1]
    return own


@pytest.mark.parametrize("batch", [3, 2048])
def test_leaders_equal_the_sequential_algorithm(spark, monkeypatch, batch):
    monkeypatch.setattr(cluster, "BATCH", batch)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(4)]
    fps = {i: r.choice(base) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for i in range(40)}
    rows = spark.createDataFrame([(i, [f & 0xFFFFFFFF, f >> 32]) for i, f in fps.items()], "id long, fp array<long>")
    rows = similarity.fingerprints(rows, "id", F.col("fp"))
    got = {x.compound_id: x.cluster_id for x in cluster.leader_clusters(rows, 60).collect()}
    assert got == sequential(fps, 60)


def test_state_schema():
    assert [f.name for f in COMPOUNDS][:2] == ["compound_id", "reghash"] and not COMPOUNDS["compound_id"].nullable


def test_shuffled_rows_are_dealt_evenly(spark):
    rows = surrogate.shuffled(spark.range(4000), 8, 3, "id").withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in rows.groupBy("part").count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 4000 and min(sizes) > 350
    assert rows.select("id").distinct().count() == 4000


def test_epochs_have_orders_of_their_own(spark):
    rows = spark.range(200).withColumnRenamed("id", "k")
    order = lambda rows, epoch: [r.k for r in surrogate.epoch_order(rows, epoch, 7, "k").orderBy("place").collect()]
    first = order(rows, 1)
    assert sorted(first) == list(range(200)) and first != sorted(first)
    assert first == order(rows.repartition(7), 1)
    assert first != order(rows, 2)
    assert surrogate.epoch_order(rows.limit(0), 1, 7, "k").count() == 0
