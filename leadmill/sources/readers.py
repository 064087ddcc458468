"""Readers with fixed schemas; each gives the columns that the operators expect."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import require

HIT_COLUMNS = {"fp": "fingerprint-similarity", "pharm": "pharmacophore-similarity"}


def docked_seeds(spark: SparkSession, path: str) -> DataFrame:
    """smiles, title, score of a CSV with header; a missing score is NaN: docked, sorted last."""
    df = require(spark.read.csv(path, header=True), "SMILES", "title", "r_i_docking_score")
    score = F.coalesce(F.col("r_i_docking_score").try_cast("double"), F.lit(float("nan")))
    return df.select(F.col("SMILES").alias("smiles"), "title", score.alias("score"))


def undocked_seeds(spark: SparkSession, path: str) -> DataFrame:
    """smiles, title, null score of lines `SMILES title`."""
    return spark.read.csv(path, sep=" ", schema="smiles string, title string").withColumn("score", F.lit(None).cast("double"))


def collection(spark: SparkSession, path: str, smiles: str, identifier: str) -> DataFrame:
    """smiles, title of a tab-separated collection, compressed or not; other columns are not kept."""
    df = require(spark.read.csv(path, sep="\t", header=True), smiles, identifier)
    return df.select(F.col(smiles).alias("smiles"), F.col(identifier).alias("title"))


def hits(spark: SparkSession, path: str, method: str) -> DataFrame:
    """method, k (SMILES), title, sim of one method's result files."""
    df = require(spark.read.csv(path, header=True), "#result-smiles", "result-name", HIT_COLUMNS[method])
    return df.select(F.lit(method).alias("method"), F.col("#result-smiles").alias("k"), F.col("result-name").alias("title"), F.col(HIT_COLUMNS[method]).cast("double").alias("sim"))


def docking_results(spark: SparkSession, folder: str) -> DataFrame:
    """title, score of all result files of a folder but those of skipped compounds."""
    files = spark.read.option("pathGlobFilter", "glide_*.csv").csv(folder, header=True)
    kept = require(files, "title", "r_i_docking_score").filter(~F.input_file_name().endswith("_skip.csv"))
    return kept.select(F.col("title").cast("long").alias("title"), F.col("r_i_docking_score").try_cast("double").alias("score"))


def packed_results(spark: SparkSession, folder: str) -> DataFrame:
    """As `docking_results`, from tar.gz files: one task opens an archive and streams its members."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
                    for member in tar:
                        name = member.name.rpartition("/")[2]
                        if member.isfile() and name.startswith("glide_") and name.endswith(".csv") and not name.endswith("_skip.csv"):
                            rows = pd.read_csv(tar.extractfile(member), usecols=["title", "r_i_docking_score"])
                            yield rows.rename(columns={"r_i_docking_score": "score"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(folder)
    return files.select("content").mapInPandas(unpack, "title long, score double")


def blob(spark: SparkSession, path: str) -> DataFrame:
    """name, content of files that a campaign carries along."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
