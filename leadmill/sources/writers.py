"""Writers of a campaign's results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import drop, file_system


def export_csv(hits: DataFrame, path: str) -> None:
    """A CSV folder with header, nulls written as None, in the order of `hits`."""
    hits.write.mode("errorifexists").csv(path, header=True, nullValue="None")


def smiles_lines(rows: DataFrame, path: str, name: str = "title") -> None:
    """Lines `SMILES name`."""
    rows.select(F.concat_ws(" ", "smiles", F.col(name).cast("string")).alias("value")).write.mode("errorifexists").text(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def collection(rows: DataFrame, path: str) -> None:
    """A tab-separated collection with header, compressed."""
    rows.write.mode("errorifexists").csv(path, sep="\t", header=True, compression="gzip")


def result_files(rows: DataFrame, folder: str, *, skipped: bool = False) -> None:
    """Rows (title, score) as result files, one a partition; those of skipped compounds are named so. A file is written elsewhere
    and moved, so that a stream over the folder meets it whole; files that are there stay."""
    spark, draft = rows.sparkSession, f"{folder}/_draft-{uuid.uuid4().hex}"
    rows.select("title", F.col("score").alias("r_i_docking_score")).write.csv(draft, header=True)
    fs, where = file_system(spark, draft)
    for status in fs.listStatus(where):
        if status.getPath().getName().startswith("part-"):
            _, to = file_system(spark, f"{folder}/glide_{uuid.uuid4().hex}{'_skip' if skipped else ''}.csv")
            if not fs.rename(status.getPath(), to):
                raise OSError(f"cannot move a result file to {to}")
    drop(spark, draft)
