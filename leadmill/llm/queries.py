"""The numbered queries: each applies one operator, with production parameters, to its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, langid, linedup, minhash, packing, parsing, pii, prefix_trie, secrets, spelling, token_counts, topk, toxicity
from .common import documents, fold, table
from .oracles import ORACLES  # noqa: F401


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {"tokenizer_path": tokenizer("byte_bpe_50k.json"), "ranks_path": tokenizer("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), **byte_tokenizer())


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(documents(spark, sf_dir, "doc_id", "text", "lang"), fold(F.col("doc_id"), 4) != 2)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "n_langs", "mixture")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.fingerprint_documents(documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), size=4, percent=80)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.deduplicate_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score_toxicity(documents(spark, sf_dir), labels, fold(F.col("doc_id"), 5) != 0)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "doc_ratio", "window_ratio", "top_ratio", *toxicity.PAIR_COLUMNS)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_decode(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir), typos=31)


QUERIES = {f.__name__: f for f in (op1_packing, op2_secrets, op3_language, op4_topk, op5_fingerprints, op6_near_duplicates, op7_line_dedup, op8_toxicity, op9_pii, op10_bpe_codec, op11_prefix_trie, op12_token_counts, op13_spelling)}
