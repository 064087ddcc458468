"""Which compounds come next: greedy and best-per-cluster picks, and marking what was picked.

Ties go to the smaller compound_id. NULL scores never count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import ONE_TASK, smallest

DOCKED = "dock_score is not null"
CANDIDATE = "pred_score is not null and dock_score is null"
UNUSED = "query_cycle is null"


def undocked(state: DataFrame) -> DataFrame:
    return state.filter("dock_score is null").select("compound_id", "smilesid")


def best(rows: DataFrame, score: str, k: int | None) -> DataFrame:
    """The k rows of the lowest score (all if k is None or negative): in order by one top-k while they are few, else picked in place, in no
    order."""
    if k is None or k < 0:
        return rows.orderBy(score, "compound_id")
    return rows.orderBy(score, "compound_id").limit(k) if k <= ONE_TASK else smallest(rows, score, ["compound_id"], k)


def best_ids(rows: DataFrame, k: int) -> DataFrame:
    """The k smallest values of `id`, which has no repeats."""
    return rows.select("id").orderBy("id").limit(k) if k <= ONE_TASK else smallest(rows.select("id"), "id", ["id"], k)


def greedy(state: DataFrame, where: str | Column, score: str, k: int | None) -> DataFrame:
    """The k best by `score`."""
    return best(state.filter(where).select("compound_id", score), score, k)


def best_of_clusters(state: DataFrame, clusters: DataFrame, where: str | Column, score: str, k: int) -> DataFrame:
    """The best compound of each cluster, then the k best of these. Unclustered compounds take no
    part. Rows are cut to the first of each cluster before they are shuffled."""
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(score, "compound_id"))
    first = state.filter(where).join(clusters, "compound_id").withColumn("rank", rank).filter("rank = 1")
    return best(first.select("compound_id", "cluster_id", score), score, k)


def pick_to_dock(state: DataFrame, k: int, clusters: DataFrame | None = None) -> DataFrame:
    return greedy(state, CANDIDATE, "pred_score", k) if clusters is None else best_of_clusters(state, clusters, CANDIDATE, "pred_score", k)


def pick_queries(state: DataFrame, k: int, predicted: bool, clusters: DataFrame | None = None) -> DataFrame:
    """Compounds that were no query yet: the best docked, or the best predicted ones."""
    where, score = (f"{UNUSED} and {CANDIDATE}", "pred_score") if predicted else (f"{UNUSED} and {DOCKED}", "dock_score")
    return greedy(state, where, score, k) if clusters is None else best_of_clusters(state, clusters, where, score, k)


def mark_queries(state: DataFrame, picked: DataFrame, cycle: int) -> DataFrame:
    """The state with query_cycle = cycle for the picked compounds (at most one cycle's queries)."""
    marks = picked.select("compound_id", F.lit(cycle).cast("int").alias("marked"))
    joined = state.join(marks, "compound_id", "left")
    return joined.withColumn("query_cycle", F.coalesce("marked", "query_cycle")).drop("marked")
