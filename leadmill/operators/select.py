"""The k smallest rows, for k up to billions: no task gathers what was picked.

A histogram of the score finds the bucket in which the k-th row lies; while that bucket is wide and full, it gets a histogram of its own. What
lies below is taken in place, by a filter; only the rows of that one bucket are ranked, in range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import with_dense_ids

ONE_TASK = 10_000  # rows up to which one top-k is cheaper
BUCKETS = 4096  # of a histogram: the numbers that reach the driver
RANKED = 1_000_000  # rows that a bucket may hold before it is ranked
INFINITY = float("inf")


def _bucket(score: Column, low: float, high: float) -> Column:
    """0 to BUCKETS + 2, never falling with the score: -infinity, BUCKETS even ones, infinity, NaN. Scores outside the range go to the ends."""
    width = high / BUCKETS - low / BUCKETS
    inside = F.floor(score / width - low / width) if width > 0 and low / width > -1e15 and high / width < 1e15 else F.lit(0)
    even = F.least(F.greatest(inside.cast("double"), F.lit(0.0)), F.lit(BUCKETS - 1.0)).cast("int") + 1
    # Infinite scores never reach the division: a conversion of theirs would fail.
    return F.when(F.isnan(score), BUCKETS + 2).when(score == INFINITY, BUCKETS + 1).when(score == -INFINITY, 0).otherwise(even)


def threshold(scores: DataFrame, score: str, k: int) -> tuple[Column, Column, int]:
    """Of the rows of `scores`: a condition of those among the k smallest whatever their ties, one of those at the cut, and how many of
    the latter are wanted. `scores` has no nulls and more than k rows."""
    x = F.col(score).cast("double")
    sure, here, wanted = F.lit(False), F.lit(True), k
    while True:
        finite = (x > -INFINITY) & (x < INFINITY)
        open_ = scores.filter(here)
        low, high = open_.filter(finite).agg(F.min(x), F.max(x)).first()
        bucket = _bucket(x, 0.0 if low is None else low, 0.0 if high is None else high)
        counts = open_.groupBy(bucket.alias("bucket")).count().collect()
        below = 0
        for at, n in sorted(tuple(r) for r in counts):
            if below + n >= wanted:
                break
            below += n
        sure, here, wanted = sure | (here & (bucket < at)), here & (bucket == at), wanted - below
        # A bucket of one value, or one that no longer shrinks, goes to the ranks however large it is.
        if n <= RANKED or n == wanted or len(counts) == 1:
            return sure, here, wanted


def smallest(rows: DataFrame, score: str, ties: list[str], k: int) -> DataFrame:
    """The k rows of the lowest score (NaN last), ties by `ties`, which with the score name a row; all, if there are no more. Rows without a
    score take no part. The result is in no order."""
    rows = rows.filter(F.col(score).isNotNull())
    if k <= 0:
        return rows.limit(0)
    if rows.count() <= k:
        return rows
    sure, here, wanted = threshold(rows.select(score), score, k)
    order = F.struct(*dict.fromkeys((score, *ties)))
    ranked = with_dense_ids(rows.filter(here).withColumn("_order", order), "_order", 0, "_place")
    return rows.filter(sure).unionByName(ranked.filter(F.col("_place") <= wanted).drop("_order", "_place"))
