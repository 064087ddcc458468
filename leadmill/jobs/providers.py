"""Providers of a campaign as table functions: a function of one row that gives none to many.

A class with `eval(self, row)` and `@udtf` (pyspark.sql.functions) becomes a provider of the loop: it gets the rows as a partitioned table argument, so an instance
serves one partition and what it loads it loads once for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_table_function(function, parts: int, by: str = "compound_id") -> Callable[[DataFrame], DataFrame]:
    """A provider that gives each row to `function`, over `parts` partitions by the hash of a column."""

    def provide(rows: DataFrame) -> DataFrame:
        dealt = rows.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
        return function(dealt.asTable().partitionBy("_part").orderBy(by))

    return provide
