"""Sphere-exclusion clustering: leaders in id order, then each row to its most similar leader.

Leaders are picked in Spark, by batches of the open rows with the smallest ids; the leaders of a batch then close rows beyond it. A batch of up to BATCH rows
is passed in id order by one task, so of dense collections no list of similar pairs is made. Batches double while few of their rows are similar to one
another, so rounds grow with the logarithm of sparse collections; a larger batch is joined with itself, and in it a row without an open similar row of smaller
id leads and closes the rows similar to it, again and again until none is open. No row reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import spool
from .acquire import best_ids
from .similarity import QUERY_TILE, assign_to_nearest, nearest, nearest_centre, similar_pairs, without_similar

BATCH = 8192
DENSE = 8  # similar pairs for each row of a batch above which batches shrink


def independent(ids: DataFrame, links: DataFrame) -> DataFrame:
    """The greedy independent set by id: of `ids` (id) and `links` (a, b), a < b, those that a pass in id order would take. A row that no
    open link leads to from below leads; what it links to is covered; in the end all that is not covered has been taken."""
    while not links.isEmpty():
        first = links.select("a").join(links.select(F.col("b").alias("a")), "a", "left_anti")
        covered = spool(links.join(first, "a", "left_semi").select(F.col("b").alias("id")).distinct(), "covered")
        ids = ids.join(covered, "id", "left_anti")
        gone = lambda side: covered.select(F.col("id").alias(side))
        links = spool(links.join(gone("a"), "a", "left_anti").join(gone("b"), "b", "left_anti").select("a", "b"), "links")
    return ids


def passed(some: DataFrame, percent: int) -> DataFrame:
    """Of rows (id, fp, n), no more than a batch and none without bits, those that a pass in id order takes: similar to none that it took before. One task."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")
        words = max(map(len, part["fp"]))
        bits = np.array([[*x, *[0] * (words - len(x))] for x in part["fp"]], np.uint64)
        n, place, took = part["n"].to_numpy(np.int64), np.arange(len(part)), []
        while len(place):
            first = place[0]
            took.append(first)
            both = np.bitwise_count(bits[place] & bits[first]).sum(axis=1, dtype=np.int64)
            alike = (100 + percent) * both >= percent * (n[place] + n[first])
            alike[0] = True
            place = place[~alike]
        return part.iloc[took]

    return some.groupBy().applyInPandas(run, some.schema)


def leaders(rows: DataFrame, percent: int, batch: int = BATCH) -> DataFrame:
    """id, fp, n of the leaders among rows (id, fp, n): in id order, a row that is similar to no
    leader before it is one. Of equal fingerprints only the smallest id can lead, so copies meet no pairs. A fingerprint without a bit is similar
    to nothing and leads itself."""
    empty = rows.filter("n = 0").select("id", "fp", "n")
    open_ = spool(rows.filter("n > 0").groupBy("fp").agg(F.min("id").alias("id"), F.first("n").alias("n")).select("id", "fp", "n"), "open")
    found = []
    while not open_.isEmpty():
        ids = spool(best_ids(open_, batch), "ids")
        some = open_.join(ids, "id", "left_semi")
        if batch <= BATCH:
            new = spool(passed(some, percent), "new")
            few = new.count()
            sparse = DENSE * few > batch
        else:
            links = spool(similar_pairs(some, some, percent).filter("q < h").select(F.col("q").alias("a"), F.col("h").alias("b")), "pairs")
            new = spool(some.join(independent(ids, links), "id", "left_semi"), "new")
            few, sparse = new.count(), links.count() <= DENSE * batch
        found.append(new)
        rest = open_.join(ids, "id", "left_anti")
        if few <= QUERY_TILE:
            rest = without_similar(rest, new, percent)
        else:
            rest = rest.join(similar_pairs(new, rest, percent).select(F.col("h").alias("id")), "id", "left_anti")
        open_ = spool(rest, "open")
        batch = 2 * batch if sparse else max(min(batch, BATCH), batch // 2)
    for new in found:
        empty = empty.unionByName(new)
    return empty


def leader_clusters(rows: DataFrame, percent: int) -> DataFrame:
    """compound_id, cluster_id (its leader's id), sim: every row with its most similar leader, which is
    similar to at least percent / 100."""
    lead = spool(leaders(rows, percent), "leaders")
    return assign_to_nearest(lead, rows, percent).select(F.col("h").alias("compound_id"), F.col("q").alias("cluster_id"), "sim")


def grown_clusters(clusters: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The clusters of `rows` where `clusters` (compound_id, cluster_id, sim) has those of the rows of smaller ids: equal to `leader_clusters` of all rows.

    A pass in id order picks the old leaders first, so they stay. New rows that are similar to none of them give the new leaders; new rows
    then meet all leaders, old rows the new leaders only. Old rows are never compared with old ones."""
    known = clusters.select(F.col("compound_id").alias("id"), "cluster_id", "sim")
    old_leaders = rows.join(known.filter("id = cluster_id").select("id"), "id", "left_semi")
    new = spool(rows.join(known.select("id"), "id", "left_anti").select("id", "fp", "n"), "new")
    by_old = spool(nearest_centre(old_leaders, new, percent), "by_old")
    open_ = new.join(by_old.select(F.col("h").alias("id")), "id", "left_anti")
    fresh = spool(leaders(open_, percent), "leaders")
    found = by_old.unionByName(nearest_centre(fresh, new, percent))
    # An old row may be nearer to a new leader; a leader is its own, and of equal similarities the older leader counts.
    kept = known.select(F.col("id").alias("h"), F.col("cluster_id").alias("q"), "sim")
    others = rows.join(known.filter("id <> cluster_id").select("id"), "id", "left_semi")
    found = found.unionByName(kept).unionByName(nearest_centre(fresh, others, percent))
    own = fresh.select(F.col("id").alias("h"), F.col("id").alias("q"), F.lit(1.0).alias("sim"))
    every = nearest(found).join(own.select("h"), "h", "left_anti").unionByName(own)
    return every.select(F.col("h").alias("compound_id"), F.col("q").alias("cluster_id"), "sim")
