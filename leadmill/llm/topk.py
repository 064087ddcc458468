"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are turned first, by an orthogonal transform from a bounded sample, so that their energy falls from component to component;
inner products stay as they are. A level cuts the turned vectors into segments: single components at the front, two long segments behind.
With a segment's mean m and deviation s (the root of the sum of squares about the mean), the inner product of two vectors is at most the
sum over segments of len * m * m' + s * s', so its negative, the distance here, is bounded from below; a segment of one component is exact. Levels go
from coarse to fine, each adds to what the one before has summed, and rows whose bound is under the k-th score known go. The survivors are
ranked by their bound and scored exactly until the bounds fall under the k-th score.

The queries are a stated set, so both sides are dealt into blocks of bounded size and each pair of a
query block and a vector block is one group: it returns the block's k best rows for each query, and
one small aggregation merges the blocks. No side is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (1 / 16, 1 / 4, 1 / 2, 3 / 4, 7 / 8)  # of the components that stand alone
TAIL = 2  # segments behind them
SAMPLE, WIDEST = 2048, 1024  # rows of the sample; components that are turned at most
CHUNK = 64  # survivors scored at once
SLACK = 1e-9
EXACT = float(2**53)
LONG = 2**63


def turned(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix that brings the directions of most energy in `sample` to the front."""
    energy, axes = np.linalg.eigh(sample.T @ sample)
    return axes[:, np.argsort(-energy)]


def tail_statistics(y: np.ndarray, front: int) -> np.ndarray:
    """Row-wise [sqrt(len) * mean, deviation] of the segments behind the first `front` components: the dot product of two such rows
    bounds these components' part of the inner product from above."""
    edges = np.linspace(front, y.shape[1], TAIL + 1).astype(int)
    parts = [y[:, a:b] for a, b in zip(edges, edges[1:]) if b > a]
    if not parts:
        return np.zeros((len(y), 1))
    mean = np.stack([p.sum(axis=1) / np.sqrt(p.shape[1]) for p in parts], axis=1)
    square = np.stack([(p**2).sum(axis=1) for p in parts], axis=1)
    return np.hstack([mean, np.sqrt(np.maximum(square - mean**2, 0) + SLACK * square)])


class Search:
    """A block of vectors, searched query by query; `scored` and `met` count the rows that were scored exactly, and all."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, turn: np.ndarray | None):
        self.ids, self.x, self.turn = ids, x, turn
        dim = x.shape[1]
        self.fronts = sorted({int(dim * share) for share in LEVELS})
        y = x if turn is None else x @ turn
        self.parts = [np.ascontiguousarray(y[:, a:b]) for a, b in zip([0, *self.fronts], self.fronts)]  # what each level adds
        self.tails = [tail_statistics(y, f) for f in self.fronts]
        self.norm = np.sqrt((x**2).sum(axis=1))
        self.scored = self.met = 0

    def best(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores that hold the k best, but the query's own row."""
        left = np.flatnonzero(self.ids != query)
        self.met += len(left)
        yq = (q if self.turn is None else q @ self.turn)[None]
        slack = SLACK * (1 + np.sqrt((q**2).sum()) * self.norm[left])
        seen, rows_seen, scores = np.zeros(len(self.ids), bool), np.empty(0, np.int64), np.empty(0)  # scored exactly so far
        done, at, bound, least = np.zeros(len(left)), 0, np.full(len(left), np.inf), -np.inf

        def score(rows: np.ndarray) -> None:
            nonlocal least, rows_seen, scores
            rows = rows[~seen[rows]]
            seen[rows] = True
            rows_seen, scores = np.append(rows_seen, rows), np.append(scores, self.x[rows] @ q)
            self.scored += len(rows)
            if len(scores) >= k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]

        for front, part, tail in zip(self.fronts, self.parts, self.tails):
            if len(left) <= 4 * k:
                break
            whole = len(left) + 1 >= len(self.ids)  # products of all rows need no copy of them
            more, rest = part @ yq[0, at:front] if whole else part[left] @ yq[0, at:front], tail_statistics(yq, front)[0]
            done = done + (more[left] if whole else more)
            at = front
            bound = done + ((tail @ rest)[left] if whole else tail[left] @ rest) + slack
            score(left[np.argpartition(-bound, k - 1)[:k]])
            stay = bound >= least
            left, done, bound, slack = left[stay], done[stay], bound[stay], slack[stay]
        order = np.argsort(-bound, kind="stable")
        for start in range(0, len(order), CHUNK):
            if bound[order[start]] < least:
                break
            score(left[order[start : start + CHUNK]])
        return rows_seen, scores


def best_in_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, turn: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query id, vector id, score) of each query's k best rows of the block, without its own."""
    top = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    safe = top * top * max(1, x.shape[1]) < EXACT
    repeats = len(np.unique(ids)) < len(ids)  # then the k best rows may be fewer ids
    search = Search(ids, x, turn) if safe and not repeats else None
    exact_x = x if safe else np.array([[int(v) for v in row] for row in x], dtype=object)
    exact_q = q if safe else np.array([[int(v) for v in row] for row in q], dtype=object)
    out = []
    for i, query in enumerate(q_ids):
        if search is not None:
            left, score = search.best(query, exact_q[i], k)
        else:
            left = np.flatnonzero(ids != query)
            score = exact_x[left] @ exact_q[i]
        order = np.lexsort((ids[left], -score)) if safe else sorted(range(len(left)), key=lambda j: (-score[j], ids[left[j]]))
        if repeats:
            order = [order[j] for j in sorted(np.unique(ids[left[order]], return_index=True)[1])]
        out += [(int(query), int(ids[left[j]]), min(LONG - 1, max(-LONG, int(score[j])))) for j in order[:k]]
    return out


def transforms(rows: DataFrame, scale: int) -> dict[int, np.ndarray]:
    """For each length of vectors in a sample of SAMPLE rows, those whose ids hash lowest, the transform that orders their energy. Vectors of more
    than WIDEST components, or of a length that the sample lacks, are searched as they are; results do not depend on it."""
    few = rows.filter(F.col("dim").between(1, WIDEST)).select("id", "v", "dim").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    return {int(dim): turned(np.floor(scale * np.clip(np.stack(part["v"].to_numpy()).astype(float), -1e9, 1e9))) for dim, part in few.groupby("dim")}


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, vector_block: int = 8192, query_block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best other rows, ties to the smaller id.

    Scores are inner products of floor(scale * component), exact; they are held at the ends of long
    if they exceed it. Rows with a null id, a null vector, or a null or non-finite component take no
    part. Vectors of different lengths are not compared. The id names the row: rows that repeat an
    id count once, with their best score, and are no answer to a query of that id. A query without
    other rows gives no row; fewer than k rows give all of them; empty tables give none. Other
    columns are not read.
    """
    finite = F.forall(F.col("v"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite).withColumn("dim", F.size("v"))
    turns = transforms(rows, scale)
    n, queries = rows.agg(F.count("*"), F.count_if("q")).first()
    vector_blocks, query_blocks = -(-n // vector_block) or 1, -(-queries // query_block) or 1
    deal = F.xxhash64(F.monotonically_increasing_id())  # evenly, whatever the partitions' sizes and the ids
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.filter("q").select("id", "v", "dim", F.pmod(deal, F.lit(query_blocks)).cast("int").alias("qb")).withColumn("vb", every(vector_blocks))
    right = rows.select("id", "v", "dim", F.pmod(deal, F.lit(vector_blocks)).cast("int").alias("vb")).withColumn("qb", every(query_blocks))

    def block(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        whole = lambda f: np.floor(scale * np.stack(f["v"].to_numpy()).astype(float))
        found = best_in_block(q["id"].to_numpy(), whole(q), x["id"].to_numpy(), whole(x), k, turns.get(int(x["dim"].iloc[0])))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ("dim", "qb", "vb")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(block, "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
