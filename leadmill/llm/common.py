"""What the operators share: table access, spooling of intermediate tables, small text helpers."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import shared_dir, spool  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of `sf_dir`, with only the named columns."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


BATCH_BYTES, BATCH_ROWS = 8 << 20, 20_000


def small_batches(spark: SparkSession) -> None:
    """Bounds what goes to Python at once by 8 MB, where the session does not ask for less (by default it is 64 MB)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` gives, which a worker keeps from task to task under this key, until a task of `map_texts` keeps something else or nothing."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go(keep: Hashable) -> None:
    """Drops what is kept under another key. (By its name in this module, so that a task meets its worker's own.)"""
    if any(key != keep for key in _KEPT):
        _KEPT.clear()


def map_texts(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, keep: Hashable = None) -> DataFrame:
    """df.mapInPandas(run, schema), in batches of bounded size either way: what a task holds does not follow the length
    of texts, and what it has held goes back when it ends, as its worker stays for later stages. Of what is `kept` only that of the key `keep` stays."""
    small_batches(df.sparkSession)

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go(keep)
        for out in run(batches):
            for at in range(0, len(out), BATCH_ROWS):
                yield out.iloc[at : at + BATCH_ROWS]
        pa.default_memory_pool().release_unused()

    return df.mapInPandas(bounded, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id, parts: int):
    """crc32 of the id as text, modulo `parts` (null id: fold of the empty string)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def crc_fold(doc_id, parts: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts
