"""The network: gradients, a curved target, the best epoch after a restart, batch inference."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.jobs import screening
from leadmill.operators import network, surrogate
from leadmill.schema import Settings
from leadmill.store import Campaign

from .test_screening import numbered, prepare

ROWS = "id long, v array<double>, y double"


@pytest.fixture(scope="module")
def curved(spark):
    r = random.Random(1)
    rows = []
    for i in range(1500):
        a, b, c = (r.uniform(-2, 2) for _ in range(3))
        rows.append((i, [a, b, c], math.sin(2 * a) + b * b - 1.5 + 0.1 * c))
    return spark.createDataFrame(rows, ROWS).repartition(5)


def test_gradients_are_the_slopes_of_the_loss():
    r = np.random.default_rng(2)
    net = network.Network([r.normal(size=(4, 5)), r.normal(size=(6, 4)), r.normal(size=(5, 1))], np.ones(3), np.full(3, 2.0), 0.5, 3.0)
    x, y = r.normal(size=(7, 3)), r.normal(size=7)
    gradient, _ = net.gradient(x, y)
    for k in range(0, len(gradient), 5):
        step = np.zeros(len(gradient))
        step[k] = 1e-6
        up, down = (net.with_flat(net.flat() + s).gradient(x, y)[1] for s in (step, -step))
        assert abs((up - down) / 2e-6 - gradient[k]) < 1e-5 * (1 + abs(gradient[k]))


def test_beats_the_linear_model_on_a_curved_target(spark, curved):
    net = network.train(curved, "v", "y", "id", epochs=40)
    losses = [held for _, held in net.history]
    assert len(losses) == 40 and net.best_epoch == losses.index(min(losses)) and min(losses) < losses[0] / 4
    held = curved.filter("id >= 1350")
    error = lambda m: surrogate.predict(m, held, "v", 1).agg(F.avg((F.col("pred_score") - F.col("y")) ** 2)).first()[0]
    linear = surrogate.train(curved, "v", "y", "id")
    assert error(net) < 0.3 * error(linear)
    assert abs(error(net) / net.deviation**2 / 2 - min(losses)) < 1e-6  # the kept weights are the best epoch's


def test_batches_keep_order_and_odd_rows(spark, curved):
    net = network.train(curved, "v", "y", "id", hidden=(4,), epochs=3)
    again = network.Network.from_bytes(net.to_bytes())
    odd = spark.createDataFrame([(5, None, None), (6, [1.0, None, 2.0], None), (7, [1.0], None), (8, [1.0, 2.0, 3.0], None)], ROWS)
    got = [(r.id, r.p) for r in curved.coalesce(1).orderBy("id").unionByName(odd).coalesce(1).select("id", network.predicted(spark, net, F.col("v"), 100).alias("p")).collect()]
    rows = curved.orderBy("id").collect()
    assert [i for i, _ in got] == [r.id for r in rows] + [5, 6, 7, 8]
    assert np.allclose([p for _, p in got[: len(rows)]], again.predict(np.array([r.v for r in rows])))
    assert [p for _, p in got[-4:-1]] == [None] * 3 and abs(got[-1][1] - net.predict([[1.0, 2.0, 3.0]])[0]) < 1e-9
    assert surrogate.predict(net, curved.limit(0), "v", 1).collect() == []
    with pytest.raises(ValueError):
        network.train(curved.limit(0), "v", "y", "id")


def test_the_best_epoch_is_restored_after_a_restart(spark, tmp_path):
    campaign = Campaign(spark, f"file://{tmp_path}/job")
    screening.import_seeds(campaign, numbered(spark), prepare, docked=True)
    settings = Settings(surrogate="network", hidden=(6,), epochs=12)
    model = screening.train_model(campaign, settings)
    again = screening.load_model(Campaign(spark, campaign.path))
    assert again.best_epoch == model.best_epoch and again.history == model.history and len(again.history) == 12
    assert np.array_equal(again.flat(), model.flat())
    assert again.history[again.best_epoch][1] == min(held for _, held in again.history)
    state = screening.repredict(campaign, again)
    assert state.filter("dock_score is null and pred_version <> 1").isEmpty()
    linear = screening.train_model(campaign, Settings())
    assert isinstance(linear, tuple) and isinstance(screening.load_model(campaign), tuple)
    assert screening.load_model(campaign, 1).best_epoch == model.best_epoch
    with pytest.raises(ValueError):
        screening.train_model(campaign, Settings(surrogate="chance"))
