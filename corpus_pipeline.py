"""The corpus pipeline: documents in, training sequences out.

Each stage applies one operator to all that the stage before it kept, and is written as Parquet and read
again as the next one's input:

  toxicity         documents that score toxic go
  line_dedup       of repeated lines the earliest stays; a document that loses all its text goes
  near_duplicates  of each group of near-duplicates (shingles of five words, similarity 0.8) the
                   document with the smallest id stays
  secrets          found secrets are masked
  packing          texts become token sequences

All but the last return the columns of their input, with n_chars as of the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm import linedup, minhash, packing, secrets, toxicity
from leadmill.llm.common import fold, table
from leadmill.llm.queries import byte_tokenizer
from leadmill.store import drop, scratch, written


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`docs` with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*(f"`{c}`" for c in columns)) if "n_chars" in columns else docs.select(*(f"`{c}`" for c in columns))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score under one half for toxicity.

    Learns from `labels` outside the held-out fifth, and from all texts of `docs`. A null or empty text has no
    words and scores as such; equal texts, repeated rows and null ids score by their text alone. Texts are read
    whole. Without labels of both classes, or without rows, everything stays.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.reject_toxic(docs, labels, fold(F.col("doc_id"), 5) != 0)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an earlier document or place has, within one edit; a document that loses lines and
    keeps nothing but white space goes.

    Null and empty texts, and rows without an id, stay as they are; a text that was blank before stays. Of equal lines the
    one of the smallest id, then place, is the earliest; rows that repeat id and text lose the same lines. A text of
    any length or number of lines is taken whole. No rows give none; columns named like counts stay.
    """
    counts = tuple(f"{n}_{uuid.uuid4().hex}" for n in ("lines", "removed"))
    done = linedup.deduplicate_lines(docs, counts=counts)
    emptied = (F.col(counts[1]) > 0) & ~F.col("text").rlike(r"(?U)\S")
    return _measured(done.filter(~F.coalesce(emptied, F.lit(False))), docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Null and empty texts, and rows without an id, have no group and stay. Rows that repeat an id and a text are one
    document and share its fate; different texts of one id are different documents. Whole texts count.
    No rows give none.
    """
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets found in their texts masked and n_chars counted again.

    The network learns from the findings in `docs`. A null text stays null, an empty one empty; equal texts are masked equally;
    texts are scanned whole. Too few findings leave the rules alone. No rows give none.
    """
    return _measured(secrets.redact_secrets(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens, as op1_packing returns them.

    A null or empty text is one end token; a null id stays null; repeated rows are packed each; a long text takes as many
    pieces as it needs. No rows give none.
    """
    return packing.pack_documents(docs, **byte_tokenizer())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", deduplicate_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Scores of a fitted model and tokenizers are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written before the next; what a stage kept aside, and its input, go once it is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs, folder = written(stage(spark, docs, sf_dir), name)
        if before:
            drop(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
