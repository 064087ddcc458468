"""Docking results as a stream: files that arrive update the best scores, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge
from ..store import Campaign, scratch

SCHEMA = "title long, r_i_docking_score double"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """title, score of result files, those of skipped compounds left out."""
    files = spark.readStream.schema(SCHEMA).option("pathGlobFilter", "glide_*.csv").option("header", True).csv(folder)
    return files.filter(~F.input_file_name().endswith("_skip.csv")).select("title", F.col("r_i_docking_score").alias("score"))


def best_so_far(results: DataFrame) -> DataFrame:
    """The lowest score of each title; the state is one number for each title."""
    return results.groupBy("title").agg(F.min(F.nanvl("score", F.lit(None).cast("double"))).alias("r_i_docking_score"))


def collect_into(results: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what has arrived, aggregated by batch, and stops; a later call goes on from there. Rows
    carry the batch, so that a repeated batch replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        best_so_far(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collect_into_campaign(results: DataFrame, campaign: Campaign, checkpoint: str, iteration: int) -> StreamingQuery:
    """Merges results into a campaign's compounds as they arrive, and stops when all have.

    A batch, its entry in the ledger, the best scores so far and the compounds are published as one step, so a batch that comes again after a
    failure is known by its number and changes nothing. When all files have come, the compounds are as if these had been read at once."""

    def merge_batch(batch: DataFrame, number: int) -> None:
        ledger, name = campaign.read("ledger"), f"{iteration}:{number}"
        if ledger is not None and not ledger.filter(F.col("batch") == name).isEmpty():
            return
        with scratch(campaign.spark), campaign.step():
            fresh = best_so_far(batch).withColumn("iteration", F.lit(iteration))
            known = campaign.read("stream_scores")
            best = fresh if known is None else known.unionByName(fresh)
            best = campaign.write("stream_scores", best.groupBy("iteration", "title").agg(F.min("r_i_docking_score").alias("r_i_docking_score")))
            touched = best.filter(F.col("iteration") == iteration).join(fresh.select("title"), "title", "left_semi").select("title", "r_i_docking_score")
            campaign.write("compounds", merge.store_scores(campaign.read("compounds"), touched, iteration))
            row = campaign.spark.createDataFrame([(name,)], "batch string")
            campaign.write("ledger", row if ledger is None else ledger.unionByName(row))

    return results.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
