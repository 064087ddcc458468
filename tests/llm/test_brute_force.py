"""Results against plain Python on small fixtures."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from leadmill.llm import bpe_codec, components, langid, linedup, minhash, packing, parsing, pii, secrets, topk, toxicity
from leadmill.llm.bpe_words import ByteBpe, library, packed
from leadmill.llm.queries import QUERIES, byte_tokenizer
from .conftest import prose

WORD = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts(spark, data):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}


def test_word_ids_equal_the_library(texts, odd_rows):
    codec, tok = bpe_codec.ChunkCodec(WORD, mean_chunk=64), library(WORD)
    extra = [t or "" for _, t in odd_rows] + ["it's I'LL don't", "ΣΑΣ İ ſ K", "é e ́", "a b c\x1cd\x85e", "12345 x9,,", "ªº µ ß .,.", "<|startoftext|>a<|endoftext|>"]
    for text in [*itertools.islice(texts.values(), 60), *extra]:
        want = tok.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert got == packed(want), text[:80]
        assert codec.decode(np.frombuffer(got, "<u4")) == tok.decode(want, skip_special_tokens=False)


def test_byte_ids_equal_the_library(texts, odd_rows):
    bpe = ByteBpe(**{"path": byte_tokenizer()["tokenizer_path"], "ranks_path": byte_tokenizer()["ranks_path"], "pattern": byte_tokenizer()["pattern"]})
    extra = [t or "" for _, t in odd_rows] + ["a  b", "a \n b", "a\n \nb", " a", "a ", "\ta b\t c", "a  b", "<|endoftext|> x <|endoftext|>y", "it's  ok", "a 　b"]
    for text in [*itertools.islice(texts.values(), 60), *extra]:
        assert bpe.encode(text) == packed(bpe.tok.encode(text, add_special_tokens=False).ids), repr(text[:80])


def test_packing_covers_every_id_once(spark, data, texts):
    tok = library(byte_tokenizer()["tokenizer_path"])
    rows = QUERIES["op1_packing"](spark, data).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(packed(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 or at & (at - 1) == 0
        assert len(pieces) <= packing.Limits().segments


def test_examples_keep_all_three_limits(spark):
    r = random.Random(1)
    examples = [(i, n := r.randrange(0, 300), r.randrange(0, min(n, 250) + 1)) for i in range(500)] + [(900, 5000, 10)]
    limits = packing.Limits(tokens=512, segments=6, loss_tokens=256)
    got = packing.pack_examples(spark.createDataFrame(examples, "example_id long, tokens long, loss_tokens long"), limits).collect()
    assert sorted(x.example_id for x in got) == sorted(e[0] for e in examples)
    groups = defaultdict(list)
    for x in got:
        groups[x.sequence_id].append(x)
    for g in groups.values():
        if g[0].example_id != 900:
            assert sum(x.length for x in g) <= 512 and len(g) <= 6 and sum(x.loss_tokens for x in g) <= 256
    lower = max(sum(min(e[1], 512) for e in examples) / 512, sum(e[2] for e in examples) / 256, len(examples) / 6)
    assert len(groups) <= 1.35 * lower


def test_top_k(spark):
    r = np.random.default_rng(2)
    x = np.round(r.normal(0, 0.3, (300, 32)), 2)
    x[100:150] = x[:50]
    ids = r.permutation(1000)[:300].tolist()
    d = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = topk.top_k(d, F.col("vec_id") % 50 == 0, 5, vector_block=64, query_block=2).collect()
    whole = np.floor(256 * x).astype(int)
    want = []
    for q in range(300):
        if ids[q] % 50 == 0:
            scores = sorted((-int(whole[q] @ whole[j]), ids[j]) for j in range(300) if j != q)[:5]
            want += [(ids[q], k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(tuple(g) for g in got) == sorted(want)


def jaccard_components(rows, size, percent):
    sets = {}
    for i, t in rows.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(rows), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in rows}


@pytest.mark.parametrize("block", [4, 1024])
def test_near_duplicates(spark, monkeypatch, block):
    """Groups around the threshold, chains, copies, a passage that many share; also with buckets split."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    r = random.Random(9)
    rows, passage = {}, prose(r, 60)
    for g in range(12):
        words = prose(r, r.randrange(3, 160)).split()
        for _ in range(8):
            rows[len(rows)] = " ".join(words)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    for _ in range(40):
        rows[len(rows)] = prose(r, r.randrange(5, 20)) + " " + passage + " " + prose(r, r.randrange(5, 20))
    rows[len(rows)] = rows[0].upper()
    got = minhash.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), size=4).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == jaccard_components(rows, 4, 80)
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 500)] + [(499, 3), (5, 5), (5, None)]
    got = {x.node: x.component for x in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 3 for k in [3, 7, *range(200, 500)]) and 5 not in got


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def test_lines(spark):
    r = random.Random(4)
    base = [prose(r, 8) for _ in range(6)] + ["é" * 40, "ab" * 20]
    docs = {}
    for i in range(60):
        lines = []
        for _ in range(r.randrange(0, 6)):
            s = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                k = r.randrange(len(s))
                s[k : k + r.choice([0, 1])] = r.choice(["", "x", "é"])
            lines.append("".join(s))
        docs[i] = "\n".join(lines + ["short"] * r.randrange(2))
    seen, want = [], {}
    for i in sorted(docs):
        kept = []
        for line in docs[i].split("\n"):
            late = len(line) >= 30 and any(line == s or one_edit(line, s) for s in seen)
            if len(line) >= 30:
                seen.append(line)
            if not late:
                kept.append(line)
        want[i] = "\n".join(kept)
    got = linedup.deduplicate_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    assert {x.doc_id: x.text for x in got.collect()} == want


def test_deletion_hashes():
    for line in ["", "a", "aab", "the quick é fox" * 5]:
        own, without = linedup.deletions(line)
        assert [int(x) for x in without] == [linedup.deletions(line[:k] + line[k + 1 :])[0] for k in range(len(line))]
    many = {linedup.deletions(f"line {k} of many that differ late {k * 7}")[0] for k in range(5000)}
    assert len(many) == 5000


def test_fingerprints(spark, data, texts):
    rows = {x.doc_id: x for x in QUERIES["op5_fingerprints"](spark, data).collect()}
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        text, following = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        n = len(text) // 3
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256((text[: len(text) - n] + following[:n]).encode()).hexdigest()
    long = [x for x in rows.values() if x.n_chars > 500]
    # A text of few, much repeated phrases keeps few of them beside a new third with many.
    assert np.quantile([x.near_edited for x in long], 0.05) > 0.3 and np.mean([x.near_next for x in long]) < 0.05
    assert all(x.near_edited > x.near_next for x in long)


def test_parsing_is_local():
    r = random.Random(8)
    shared = prose(r, 400)
    a, b = (parsing.fingerprints([prose(r, n) + " " + shared])[0] for n in (20, 31))
    assert parsing.likeness(a, b) > 0.7
    assert parsing.likeness(a, parsing.fingerprints([prose(r, 400)])[0]) < 0.1
    assert [x.tolist() for x in parsing.fingerprints(["abc" * 50, "x", ""])[0]] == [x.tolist() for x in parsing.fingerprints(["abc" * 50])[0]]


def test_secret_rules(texts, odd_rows):
    extra = ["secret=token: abcdefghij", "token: a password=longlonglong", 'API_KEY": "abc-DEF_123"', "AKIAAKIA" + "A1" * 8, "f" * 31 + " " + "0" * 32, "ſecret=abcdefgh", "toKen=abcdefgh"]
    for text in [*texts.values(), *(t for _, t in odd_rows), *extra]:
        text = text or ""
        want = [(*m.span(), "assign") for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
        want += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        want += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        assert secrets.rule_spans(text) == sorted(want, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def test_network_finds_keys_that_no_rule_names(spark):
    r = random.Random(6)
    key = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(i, f"{prose(r, 20)} token = {key(32)} {prose(r, 9)} page-{r.randrange(10**12):016d} {prose(r, 5)}") for i in range(300)]
    rows += [(1000 + i, f"{prose(r, 20)} use {key(32)} now") for i in range(50)] + [(2000 + i, f"{prose(r, 20)} page-{r.randrange(10**12):016d}") for i in range(50)]
    got = {x.doc_id: x for x in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[1000 + i].n_model for i in range(50)) >= 45
    assert sum(got[2000 + i].n_model for i in range(50)) <= 3
    masked = {x.doc_id: x.text for x in secrets.redact_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("token = [secret] " in masked[i] for i in range(300))


def test_gradients_of_the_network():
    net = secrets.CharCnn(dim=3, filters=4)
    net.start()
    r = np.random.default_rng(1)
    x, y = r.integers(0, 98, (5, secrets.WIDTH)), np.array([0, 1, 0, 1, 1])

    def loss():
        z = net.forward(x)
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.5e-4 * (net.params["w"] ** 2).sum()

    z, kept = net.forward(x, keep=True)
    grads = net.gradients(x, z, y, kept)
    for name, g in grads.items():
        flat = net.params[name].reshape(-1)
        for k in np.argsort(-np.abs(g.reshape(-1)))[:3]:
            flat[k] += 1e-5
            up = loss()
            flat[k] -= 2e-5
            down = loss()
            flat[k] += 1e-5
            assert abs((up - down) / 2e-5 - g.reshape(-1)[k]) < 1e-6 + 1e-3 * abs(g.reshape(-1)[k])


def test_languages_held_out(spark, data):
    got = QUERIES["op3_language"](spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([x.lang_pred == x.lang for x in got]) > 0.95


def test_mixture_of_two_languages(spark):
    r = random.Random(2)
    a, b = (lambda n: " ".join(r.choice(["thering", "ofthe", "andon", "whity"]) for _ in range(n))), (lambda n: " ".join(r.choice(["éauxment", "quelle", "dansoi", "leçon"]) for _ in range(n)))
    rows = [(i, a(80) if i % 2 else b(80), "a" if i % 2 else "b") for i in range(40)] + [(99, a(140) + " " + b(60), None), (98, "123 !?", None), (97, None, "a")]
    got = {x.doc_id: x for x in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True)).collect()}
    assert got[99].n_langs == 2 and got[99].lang_pred == "a" and 0.5 < got[99].score < 0.9
    assert got[98].lang_pred == got[97].lang_pred == "und" and got[98].score == 0
    assert all(got[i].lang_pred == ("a" if i % 2 else "b") and got[i].n_langs == 1 for i in range(40))


def test_toxicity_held_out(spark):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        words = prose(r, 80).split()
        if i % 4 == 0:
            for _ in range(3):
                words[r.randrange(80)] = r.choice(["grumblon", "snarkle", "vilewit"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, marks, F.col("doc_id") < 450).filter("doc_id >= 450").collect()
    assert all(x.predicted == (x.doc_id % 4 == 0) for x in got)
    kept = toxicity.reject_toxic(docs, marks, F.col("doc_id") < 450).count()
    assert kept == 450


def test_toxicity_has_no_cap_on_words(spark):
    """A telling word counts though 310,000 words of both classes weigh more."""
    filler = spark.range(24).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(0, 309999), k -> concat('w', k)), ' ')").alias("text"))
    rows = [(100 + i, "grumblon") for i in range(10)] + [(200, "grumblon"), (201, "unheard")]
    docs = filler.union(spark.createDataFrame(rows, "doc_id long, text string"))
    marks = spark.createDataFrame([(i, i % 2) for i in range(24)] + [(100 + i, 1) for i in range(10)], "doc_id long, toxic int")
    got = {r.doc_id: r.doc_ratio for r in toxicity.score_toxicity(docs, marks, F.lit(True)).filter("doc_id >= 200").collect()}
    assert got[200] > got[201] + 0.5


def test_toxicity_joins_words_beyond_the_table(spark, odd, monkeypatch):
    marks = odd.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("toxic"))
    score = lambda: sorted(str((r.doc_id, *(round(x, 6) for x in (r.doc_ratio, r.window_ratio, r.top_ratio, r.score)))) for r in toxicity.score_toxicity(odd, marks, F.lit(True)).collect())
    kept = lambda: sorted(str((r.doc_id, r.text)) for r in toxicity.reject_toxic(odd, marks, F.lit(True)).collect())
    table = score(), kept()
    monkeypatch.setattr(toxicity, "TABLE_WORDS", 0)
    monkeypatch.setattr(toxicity, "COUNT_SLICE", 500)
    assert (score(), kept()) == table


def test_network_learns_from_rare_secrets(spark):
    """12 documents of 6,000 hold findings: every one of them is learnt from."""
    r = random.Random(8)
    key = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(i, f"{prose(r, 20)} page-{r.randrange(10**12):016d} {prose(r, 5)}" + (f" token = {key(32)} now" if i % 500 == 0 else "")) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows.append((9000, f"use {key(32)} now"))
    assert secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id = 9000").first().n_model == 1
    rows.pop()
    got = secrets.sample(docs.select(F.col("text").alias("t")), 10_000)
    want = {(w, y) for _, text in rows for w, y in secrets.labelled(text)}
    assert {x for x in want if x[1] == 1} == {(w, 1) for w in got[got["y"] == 1]["w"]}
    assert (got["y"] == 0).sum() == min(10_000, sum(y == 0 for _, y in want))


def test_toxicity_counts_of_preceding_words_do_not_saturate(spark):
    rows = [(" ".join(f"w{k} {common}" for k in range(n)), 0) for common, n in (("few", 3), ("some", 200), ("many", 5000), ("most", 60000))]
    got = {r.w: r.follows for r in toxicity.word_counts(spark.createDataFrame(rows, "t string, y int")).collect()}
    for common, n in (("few", 3), ("some", 200), ("many", 5000), ("most", 60000)):
        assert abs(got[toxicity.word_hash(common)] / n - 1) < 0.4, common


def test_toxicity_counts_held_rows_that_the_unit_does_not_take(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 7} same") for i in range(400)], "doc_id long, text string")
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    given, count = [], toxicity.word_counts
    monkeypatch.setattr(toxicity, "word_counts", lambda d: (given.append(d.filter("y is not null").count()), count(d))[1])
    toxicity.score_toxicity(docs, marks, F.lit(True), most=5)
    assert given == [400 - 2 * 5]


def test_many_repeated_lines_of_one_document(spark):
    """Removal is in proportion to the lines: 200,000 equal ones, and others among them."""
    line = "a line of more than thirty characters, again and again"
    text = "\n".join(line if k % 100 else f"\nshort {k}" for k in range(200_000))
    start = time.time()
    got = linedup.deduplicate_lines(spark.createDataFrame([(1, text), (2, "x"), (3, f"{line}\n\n{line}s\n")], "doc_id long, text string")).collect()
    assert time.time() - start < 60
    seen = set()
    want = "\n".join(x for x in text.split("\n") if len(x) < 30 or not (x in seen or seen.add(x)))
    assert {r.doc_id: r.text for r in got} == {1: want, 2: "x", 3: "\n"}


def test_lines_of_a_repeated_id(spark):
    a, b = prose(random.Random(1), 8), prose(random.Random(2), 8)
    rows = [(1, a), (5, a), (5, b), (5, b)]
    got = sorted((r.doc_id, r.text) for r in linedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(1, a), (5, ""), (5, b), (5, b)])


def test_personal_data_of_a_text_with_many_spans(spark):
    """8,000 addresses among others, over several pages of the text: places, scores and time."""
    text = " é ".join(f"mail me{k}@host{k % 7}.org or +49 30 {1000000 + k} at 10.0.{k % 300}.1" for k in range(8000))
    start = time.time()
    got = pii.find_pii(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).collect()[0]
    assert time.time() - start < 60
    want = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans = got.spans.split(",")
    assert spans[: len(want)] == want and spans[len(want) : len(want) + len(ips)] == [f"ip:{m.start()}:{m.end()}" for m in ips]
    assert got.n_email == 8000 and got.n_ip == len(ips) and set(got.scores.split(",")[:8000]) == {"1.0"}


def test_rows_without_id_hide_no_link(spark):
    base = prose(random.Random(3), 100)
    rows = [(None, base), (7, base), (8, base + " extra"), (None, base + " extra"), (3, base + " more"), (4, prose(random.Random(4), 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None, True), (None, None, True), (7, 3, False), (8, 3, False), (3, 3, True), (4, 4, True)], key=str)
