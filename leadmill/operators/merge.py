"""Merging results into the state: best scores, similarities, representatives, new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import spool


def best_score_per_title(results: DataFrame, title: str, score: str) -> DataFrame:
    """The lowest score of each title over its variants; NaN counts as missing."""
    return results.groupBy(F.col(title).alias("title")).agg(F.min(F.nanvl(F.col(score), F.lit(None).cast("double"))).alias("r_i_docking_score"))


def max_similarity(hits: DataFrame) -> DataFrame:
    """Of hits (method, k, title, sim): the highest similarity of each method and key."""
    return hits.groupBy("method", "k").agg(F.max("sim").alias("similarity"))


def first_title(hits: DataFrame) -> DataFrame:
    """One title for each key: of the method first by name, then the smallest."""
    return hits.groupBy("k").agg(F.min(F.struct("method", "title")).alias("m")).select("k", "m.title", "m.method")


def representatives(predicted: DataFrame, key: str, id_col: str, score: str) -> DataFrame:
    """For each key its lowest score and, as representative, its row with the smallest id."""
    return predicted.groupBy(key).agg(F.min(id_col).alias(id_col), F.min(score).alias("pred_score")).select(id_col, "pred_score")


def unique_by(rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """The smallest id of each key, and how many rows share it."""
    return rows.groupBy(key).agg(F.min(id_col).alias(id_col), F.count("*").alias("n")).select(id_col, "n")


def not_known(hits: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Hits whose key the state does not hold; a null key is never known."""
    return hits.join(known.select(key), key, "left_anti")


def with_dense_ids(new: DataFrame, order: str, start: int, id_col: str = "new_id") -> DataFrame:
    """Ids start + 1, start + 2, ... in the order of a unique, non-null column (a struct for several), without a global
    window: rows are range-partitioned and written, partitions counted, and each numbers its own rows
    from the count of those before it. One number for each partition reaches the driver."""
    parts = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = new.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id())
    placed = spool(ranged, "ranged")
    sizes = sorted(placed.groupBy("_part").count().collect())
    before, offsets = start, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    offset = placed.sparkSession.createDataFrame(offsets, "_part int, _before long")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return placed.join(F.broadcast(offset), "_part").withColumn(id_col, F.col("_before") + rank).drop("_part", "_before")


def overlap_counts(hits: DataFrame) -> DataFrame:
    """How many keys each of two methods found, and found alone."""
    a, b = (F.max((F.col("method") == m).cast("int")).alias(m) for m in ("a", "b"))
    found = hits.groupBy("k").agg(a, b)
    only = lambda x, y: F.count_if((F.col(x) == 1) & (F.col(y) == 0)).alias(f"only_{x}")
    return found.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_b"), only("a", "b"), only("b", "a"))


def attach_similarities(rows: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """rows with the highest similarity of both methods, null where a method has none."""
    best = hits.groupBy("k").agg(*(F.max(F.when(F.col("method") == m, F.col("sim"))).alias(f"sim_{m}") for m in ("a", "b")))
    return rows.join(best, rows[key] == best["k"], "left").drop("k")


def update(state: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The state with `columns` taken from `new` for the keys that it holds; a null there keeps the
    old value."""
    fresh = new.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = state.join(fresh, state[key] == F.col("_key"), "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in state.columns))


def store_scores(state: DataFrame, scores: DataFrame, iteration: int) -> DataFrame:
    """Scores by (title, r_i_docking_score). A title without any number keeps its score null but gets
    the iteration; compounds without a row keep both."""
    new = scores.select(F.col("title").alias("_key"), F.col("r_i_docking_score").alias("_score"), F.lit(iteration).cast("int").alias("_iter"))
    joined = state.join(new, state["compound_id"] == F.col("_key"), "left")
    values = {"dock_score": F.when(F.col("_key").isNotNull(), F.col("_score")).otherwise(F.col("dock_score")), "dock_iteration": F.coalesce("_iter", "dock_iteration")}
    return joined.select(*(values.get(c, F.col(c)).alias(c) for c in state.columns))


def export(state: DataFrame, clusters: DataFrame, cutoff: float) -> DataFrame:
    """Scored compounds up to the cutoff that have a cluster, best first; titles carry the id."""
    hits = state.filter(F.col("dock_score") <= cutoff).join(clusters.select("compound_id", "cluster_id"), "compound_id")
    title = F.concat_ws("/", "smilesid", F.col("compound_id").cast("string"))
    return hits.orderBy("dock_score", "compound_id").withColumn("smilesid", title).drop("compound_id")


def export_found(state: DataFrame, cutoff: float) -> DataFrame:
    """As `export`, of compounds that a similarity search found, clustered or not."""
    hits = state.filter((F.col("dock_score") <= cutoff) & (F.col("sim_fp").isNotNull() | F.col("sim_pharm").isNotNull()))
    return hits.orderBy("dock_score", "compound_id").withColumn("smilesid", F.concat_ws("/", "smilesid", F.col("compound_id").cast("string"))).drop("compound_id")


EXPORTED = ("smiles", "smilesid", "dock_score", "pred_score", "sim_fp", "sim_pharm", "dock_iteration", "cluster_id")


def export_table(state: DataFrame, clusters: DataFrame, cutoff: float) -> DataFrame:
    """As `export`, with the eight columns of a result file in their order."""
    return export(state, clusters, cutoff).select(*EXPORTED)


def titles_of(ids: DataFrame, state: DataFrame) -> DataFrame:
    """compound_id, smilesid of the ids asked for; an unknown id has a null title."""
    return ids.select("compound_id").distinct().join(state.select("compound_id", "smilesid"), "compound_id", "left")


def best_hits_per_query(hits: DataFrame, most: int) -> DataFrame:
    """Of hits (method, query, k, title, sim) the `most` with the highest similarity of each query and method, ties to the
    smaller key and title. Tasks cut their own rows before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("method", "query").orderBy(F.desc("sim"), "k", "title"))
    return hits.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")
