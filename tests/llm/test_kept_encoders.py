"""A worker keeps the encoder of packing from task to task, and lets it go when a task of another operator begins."""

import gc

import pandas as pd

from leadmill.llm import common, packing
from leadmill.llm.queries import byte_tokenizer


def encoders(batches):
    for _ in batches:
        gc.collect()
        from leadmill.llm.bpe_words import ByteBpe

        yield pd.DataFrame({"n": [sum(isinstance(x, ByteBpe) for x in gc.get_objects())]})


def test_other_tasks_let_the_encoder_go(spark):
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(64)], "doc_id long, text string").repartition(8)
    assert packing.pack_documents(docs, **byte_tokenizer()).count() > 0
    kept = docs.mapInPandas(encoders, "n int").agg({"n": "max"}).first()[0]
    after = common.map_texts(docs, encoders, "n int").agg({"n": "max"}).first()[0]
    assert (kept, after) == (1, 0)
