"""What the network of the secret scan learns from: texts apart, plain candidates as negatives."""

import random
import warnings

import numpy as np
from pyspark.sql import functions as F

from leadmill.llm import secrets

from .conftest import prose


def rows_with_keys(seed=9, n=800):
    r = random.Random(seed)
    key = lambda k: "".join(r.choice(secrets.ALPHABETS[0]) for _ in range(k))
    return [(i, f"{prose(r, 30)} {'mixture ' * 3}{prose(r, 5).title()}" + (f" token = {key(r.randrange(16, 40))} for {prose(r, 3)}" if i % 10 == 0 else "")) for i in range(n)], r, key


def test_no_window_of_a_learnt_text_is_held_out(spark):
    rows, *_ = rows_with_keys()
    rows += [(5000 + i, t) for i, t in rows[:200]]  # copies are on one side
    got = secrets.sample(spark.createDataFrame(rows, "doc_id long, text string").select(F.col("text").alias("t")), 10_000)
    learnt = {x for _, text in rows if not secrets.is_held(text) for x in secrets.labelled(text)}
    held = {x for _, text in rows if secrets.is_held(text) for x in secrets.labelled(text)} - learnt
    sides = {True: set(), False: set()}
    for w, y, h in zip(got["w"], got["y"], got["held"]):
        sides[bool(h)].add((w, y))
    assert sides[True] <= held and sides[False] <= learnt
    assert {y for _, y in sides[True]} == {0, 1} == {y for _, y in sides[False]}


def test_capitals_and_numbers_in_prose_are_no_secrets(spark):
    rows, r, key = rows_with_keys()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.train(docs, text_col="text")
    assert model.recall >= 0.95
    loud = [(i, f"{prose(r, 8)} {prose(r, 9).replace(' ', '').upper()[:r.randrange(16, 40)]}{r.choice(['.', '', ','])} {r.randrange(10**19, 10**20)} {prose(r, 8)}") for i in range(300)]
    found = secrets.find_secrets(spark.createDataFrame(loud, "doc_id long, text string"), model=model)
    # So few texts teach few forms of capitals.
    assert found.filter("n_model > 0").count() <= 60
    numbers = spark.createDataFrame([(i, f"{prose(r, 8)} {r.randrange(10**19, 10**20)} {prose(r, 8)}") for i in range(300)], "doc_id long, text string")
    assert secrets.find_secrets(numbers, model=model).filter("n_model > 0").isEmpty()
    planted = [(i, f"{prose(r, 8)} {key(32)} {prose(r, 8)}") for i in range(200)]
    assert secrets.find_secrets(spark.createDataFrame(planted, "doc_id long, text string"), model=model).filter("n_model > 0").count() >= 190


def test_too_few_findings_are_told(spark):
    docs = spark.createDataFrame([(1, "plain words only")], "doc_id long, text string")
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert secrets.train(docs, text_col="text") is None
    assert any("only the rules find" in str(w.message) for w in told)


def test_all_windows_are_learnt_from_or_held_out(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SHARD", 4000)
    rows, *_ = rows_with_keys()
    rows += [(5000 + i, t) for i, t in rows[:200]]
    learnt = {x for _, text in rows if not secrets.is_held(text) for x in secrets.labelled(text)}
    held = {x for _, text in rows if secrets.is_held(text) for x in secrets.labelled(text)} - learnt
    asked, spools = [], {}
    calibrate, spool = secrets.CharCnn.calibrate, secrets.spool

    def counted(self, z, y, count, recall):
        asked.append({k: count[y == k].sum() for k in (0, 1)})
        calibrate(self, z, y, count, recall)

    monkeypatch.setattr(secrets.CharCnn, "calibrate", counted)
    monkeypatch.setattr(secrets, "spool", lambda df, tag: spools.setdefault(tag, spool(df, tag)))
    model = secrets.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), text_col="text", sample_windows=1000)
    shards = spools["shards"].filter("n > 0").select("n", "params").collect()
    assert len(shards) > 2 and sum(x.n for x in shards) == len(learnt)
    assert asked == [{k: sum(y == k for _, y in held) for k in (0, 1)}]
    mean = sum(x.n * np.array(x.params) for x in shards) / len(learnt)
    assert abs(mean - np.concatenate([model.params[k].ravel() for k in sorted(model.params)])).max() < 1e-9
    assert model.recall >= 0.95 and model.false_alarms < 0.01
