"""The prefix trie against a dictionary of prefixes, and token counts against the library."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from leadmill.llm import prefix_trie, token_counts

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    kids, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    sha = lambda k: hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
    return sorted((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k], sha(k)) for k, m in members.items())


def found(df, **options):
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(df, **options).select(*prefix_trie.OUT).collect())


@pytest.fixture(scope="module")
def conversations():
    """Many equal prefixes, ties and repeated rows, null turns, ids, roles and texts, negative ids, a long conversation and one copied often."""
    r = random.Random(1)
    rows = []
    for c in range(600):
        if c % 100 == 0 and c % 200:
            continue  # no base to take turns from
        for t in range(r.randrange(0, 6)):
            rows.append((None if r.random() < 0.02 else c, None if t == 0 and r.random() < 0.3 else t, r.choice(["u", "a", None]), r.choice(["", "x", "yé", None])))
    rows += [(-5, 0, "u", "x"), (-105, 0, "u", "x"), (-100, 0, "a", "hello"), (-100, 0, "a", "hello"), (-100, 0, "b", "tie")]
    rows += [(700, t, "u", f"turn {t}") for t in range(900)]
    rows += [(c, t, "u", "same") for c in range(1000, 1300) for t in range(7)]
    return rows


@pytest.mark.parametrize("options", [{}, {"block": 60, "least_rows": 4, "top_rows": 20}, {"block": 1, "least_rows": 3, "top_rows": 3}])
def test_trie(spark, conversations, options):
    assert found(spark.createDataFrame(conversations, CONVERSATIONS), **options) == plain_trie(conversations)


def test_trie_of_nothing_and_clashing_columns(spark, conversations):
    df = spark.createDataFrame(conversations[:200], CONVERSATIONS)
    assert found(df.limit(0)) == [] and found(df.withColumn("conv_id", F.lit(None).cast("long"))) == []
    odd = df.select("text", F.lit(1).alias("depth"), F.lit("k").alias("key"), F.lit(0).alias("conv"), "role", "turn", "conv_id", F.lit(2).alias("chars"))
    assert found(odd) == plain_trie(conversations[:200])


def test_searches_left_and_right():
    """Extents by the sparse table against a plain walk."""
    import numpy as np

    r = random.Random(2)
    for _ in range(200):
        n = r.randrange(1, 40)
        lcp = np.array([-1] + [r.randrange(0, 5) for _ in range(n - 1)])
        rows, depths = np.array([r.randrange(n) for _ in range(20)]), np.array([r.randrange(0, 6) for _ in range(20)])
        table = prefix_trie.SparseTable(lcp)
        left, right = table.left(rows, depths), table.right(rows, depths)
        for i, d, a, b in zip(rows, depths, left, right):
            x = y = i
            while x > 0 and lcp[x] >= d:
                x -= 1
            while y + 1 < n and lcp[y + 1] >= d:
                y += 1
            assert (a, b) == (x, y)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_the_librarys(name):
    r = random.Random(5)
    parts = list("aAbé́ \n\t.,'1٣  日Σςß​　İı\U0001f600-_<|") + ["<|endoftext|>", "<|startoftext|>", " the", "'ll", "ing", "  ", "<s>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 30))) for _ in range(3000)] + ["x" * 50_000, "word " * 50_000, ""]
    c = token_counts.counter(P.path(name))
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=P.path(name))
        want = [len(model.encode(t)) for t in texts]
    else:
        from tokenizers import Tokenizer

        want = [len(e.ids) for e in Tokenizer.from_file(P.path(name)).encode_batch(texts, add_special_tokens=False)]
    assert [c.count(t) for t in texts] == want


def test_the_shortcut_is_proven_and_used():
    c = token_counts.JsonCounter(P.path("word_bpe_49k.json"))
    assert c.drops_blanks and len(c.whole) > 30_000
    some = random.Random(1).sample(sorted(c.whole), 500)
    assert all(len(c.tok.model.tokenize(piece)) == 1 for piece in some)
    assert c.count("The house, the house") == 5 and not c.merged, "whole tokens are not merged"
    assert c.count("Zuverstöung") > 1 and len(c.merged) == 1


def test_count_rows(spark, odd, odd_rows, empty):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd, path).collect())
    counts = [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in odd_rows]
    assert got == Counter((i, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(odd_rows, counts))
    assert token_counts.count_tokens(empty, path).collect() == []
