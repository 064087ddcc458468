"""Every operator over nulls, empty and very long texts, ties, repeated rows, empty tables and extra
columns: no crash, one defined result."""

from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from leadmill.llm import bpe_codec, langid, linedup, minhash, packing, parsing, pii, secrets, topk, toxicity

BYTE = {"tokenizer_path": P.path("byte_bpe_50k.json"), "ranks_path": P.path("byte_bpe_50k.tiktoken"), "pattern": P.PATTERN}


def labels_of(docs):
    return docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("toxic"))


OPERATORS = {
    "packing": lambda d: packing.pack_documents(d, **BYTE),
    "secrets": secrets.find_secrets,
    "secrets_masked": secrets.redact_secrets,
    "langid": lambda d: langid.identify(d, F.lit(True)),
    "parsing": parsing.fingerprint_documents,
    "minhash": minhash.near_duplicates,
    "linedup": linedup.deduplicate_lines,
    "toxicity": lambda d: toxicity.score_toxicity(d, labels_of(d), F.lit(True)),
    "toxicity_rejected": lambda d: toxicity.reject_toxic(d, labels_of(d), F.lit(True)),
    "pii": pii.find_pii,
    "bpe": lambda d: bpe_codec.encode_decode(d, P.path("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, odd_rows, name):
    got = Counter(r.doc_id for r in OPERATORS[name](odd).select("doc_id").collect())
    want = Counter(i for i, _ in odd_rows)
    if name == "packing":
        assert set(got) == set(want)
    elif name == "toxicity_rejected":
        assert set(got) <= set(want)
    else:
        assert got == want


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).collect() == []


def test_extra_columns_stay(odd):
    done = linedup.deduplicate_lines(odd)
    assert done.columns == [*odd.columns, "n_lines", "n_removed"]
    assert secrets.redact_secrets(odd).columns == odd.columns
    assert done.filter("score <> 1.5 or n_tokens <> 7").count() == 0


def test_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (3, [1.0, 0.5]), (4, [-1.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (3, [1.0, 0.5]), (100, [3e38, 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in topk.top_k(d, F.col("vec_id") % 50 == 0, 3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    same = 256 * 256 + 128 * 128
    huge = 2**63 - 1
    assert sorted(got[0]) == [(1, 100, huge), (2, 3, same), (3, 50, same)]
    assert sorted(got[100])[0] == (1, 0, huge)
    assert topk.top_k(d.limit(0), F.lit(True), 3).collect() == []
    assert topk.top_k(d.filter("vec_id = 0"), F.lit(True), 3).collect() == []


NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # sha256 of the empty string
BLANK = {
    "packing": {"start": 0, "length": 1, "doc_tokens": 1},
    "secrets": {"n_assign": 0, "n_access": 0, "n_hex": 0, "n_model": 0, "base_sha256": NOTHING, "spans": ""},
    "langid": {"lang_pred": "und", "score": 0.0, "n_langs": 0},
    "parsing": {"n_chars": 0, "edited_sha256": NOTHING, "fingerprint": "", "edited_fingerprint": "", "near_edited": 1.0},
    "minhash": {"n_shingles": 0, "kept": True},
    "linedup": {"n_removed": 0},
    "toxicity": {"doc_ratio": 0.0, "window_ratio": 0.0, "top_ratio": 0.0},
    "pii": {"n_email": 0, "n_ip": 0, "n_card": 0, "n_phone": 0, "base_sha256": NOTHING, "spans": "", "scores": ""},
    "bpe": {"n_tokens": 0, "ids_sha256": NOTHING, "decoded_sha256": NOTHING},
}


@pytest.mark.parametrize("name", BLANK)
def test_values_of_odd_rows(odd, name):
    """Null and empty texts have one result; rows of equal texts have equal results; a null id changes nothing."""
    rows = OPERATORS[name](odd).collect()
    of = lambda i: [r for r in rows if r.doc_id == i]
    for i in (20, 21):
        assert [{c: r[c] for c in BLANK[name]} for r in of(i)] == [BLANK[name]]
    if name == "linedup":
        assert of(20)[0].text is None and of(21)[0].text == "" and (of(20)[0].n_lines, of(21)[0].n_lines) == (0, 1)
        assert len({r.text for r in of(None)}) == 2 and of(24)[0].n_removed == 0 and of(25)[0].n_removed == 1
    own = {"secrets": ("spans",), "langid": ("lang_pred", "score"), "toxicity": ("score",), "pii": ("spans",), "bpe": ("ids_sha256",), "parsing": ("fingerprint",), "minhash": ("n_shingles",)}
    if name in own:
        same = [r for i in (24, 25, 29) for r in of(i)]
        assert len(same) == 4 and len({tuple(r[c] for c in own[name]) for r in same}) == 1
        assert {tuple(r[c] for c in own[name]) for r in of(None)} == {tuple(r[c] for c in own[name]) for r in (same[0], of(20)[0])}
    if name == "minhash":
        assert {r.component_id for i in (24, 25, 26, 29) for r in of(i)} == {24} and {r.component_id for r in of(None)} == {None}
