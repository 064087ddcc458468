"""Leaders of a dense collection are found without a list of its similar pairs."""

import random

from leadmill.functions.fingerprint import popcount
from leadmill.operators import cluster


def test_no_list_of_pairs(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a list of similar pairs")

    r = random.Random(11)
    sets = [r.getrandbits(64) | 1 for _ in range(600)]
    rows = spark.createDataFrame([(k, [x & 0xFFFFFFFF, x >> 32]) for k, x in enumerate(sets)], "id long, fp array<long>").withColumn("n", popcount("fp"))
    led = []
    for k, x in enumerate(sets):
        if all(100 * (x & sets[a]).bit_count() < 30 * (x | sets[a]).bit_count() for a in led):
            led.append(k)
    monkeypatch.setattr(cluster, "BATCH", 256)
    monkeypatch.setattr(cluster, "similar_pairs", refuse)
    monkeypatch.setattr(cluster, "DENSE", 2)
    assert sorted(x.id for x in cluster.leaders(rows, 30, 256).collect()) == led
