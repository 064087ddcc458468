"""Spelling variants against every pair of words, and the filters against sets."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.llm import spelling

OUT = ("word", "form", "root", "n", "n_near", "form_n")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, typos=None, least=7, least_n=2):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if typos and h % typos == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= least
    n = {w: c for w, c in counts.items() if c >= least_n}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(((-n[v], v) for v in near[w]), default=(0, None)) for w in n}
    form = {w: v if -c >= 10 * n[w] else None for w, (c, v) in form.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n) if n else []


def found(docs, **options):
    return sorted(tuple(r) for r in spelling.spelling_variants(docs, **options).select(*OUT).collect())


@pytest.fixture(scope="module")
def texts():
    """Few stems in many spellings, among them chains of forms, ties, runs of one letter, letters past Latin-1 beside words, × and ÷."""
    r = random.Random(4)
    stems = ["station", "stations", "érables", "aaaaaaaa", "ÿÿÿÿÿÿÿÿ", "größeren", "abc×defg", "underneath"]
    words = []
    for stem in stems:
        words += [stem] * 400
        for _ in range(30):
            i, c = r.randrange(len(stem)), r.choice("abzéÿ")
            words += [r.choice([stem[:i] + stem[i + 1 :], stem[:i] + c + stem[i:], stem[:i] + c + stem[i + 1 :]])] * r.choice([1, 2, 3, 30])
    words += ["chainaa"] * 2 + ["chainab"] * 20 + ["chaincb"] * 200 + ["chancbb"] * 3 + ["word日本word", "short", "ŒuvresŒ", "STATION", "Érables"]
    r.shuffle(words)
    rows = [(k, " ".join(words[at : at + 20])) for k, at in enumerate(range(0, len(words), 20))]
    return rows + [(None, "station stations"), (None, None), (7, ""), (7, "x" * 5000 + " station"), (3, rows[3][1])]


@pytest.mark.parametrize("options", [{}, {"typos": 3}, {"typos": 31, "round_bytes": 1}])
def test_all_pairs(spark, texts, options):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain(texts, options.get("typos"))
    assert any(f and f != r for _, f, r, *_ in want), "chains of forms"
    assert found(docs, **options) == want


def test_odd_rows(spark, odd, odd_rows, empty):
    assert found(odd, typos=31) == plain(odd_rows, 31)
    assert found(empty) == [] and found(odd.withColumn("text", F.lit(None).cast("string"))) == []
    assert found(odd.select("doc_id", F.lit(1).alias("n"), F.lit("w").alias("word"), "text"), typos=31) == plain(odd_rows, 31)


def test_edits_are_hashed_as_words():
    """With a filter of all edits, the probes are exactly the deletions and later replacements, each once."""
    words = [b"aabba", b"xyzzy", b"\xe9aaaa", b"a\xffbcd"]
    alphabet = np.frombuffer(b"abxyz\xe9\xff", np.uint8)
    full = spelling.Shard(1, 0, np.array([2**64 - 1], np.uint64))
    got = Counter(spelling.known_edits(spelling.letters_of(words), alphabet, full, full))
    want = Counter({(k, w[:i] + w[i + 1 :]) for k, w in enumerate(words) for i in range(5)})
    want += Counter((k, w[:i] + bytes([c]) + w[i + 1 :]) for k, w in enumerate(words) for i in range(5) for c in alphabet.tolist() if c > w[i])
    assert got == want
    for k, edited in want:
        shard = filter_of([edited])
        deletions, others = (None, shard) if len(edited) == 5 else (shard, None)
        assert (k, edited) in set(spelling.known_edits(spelling.letters_of(words), alphabet, others, deletions))


def filter_of(words, blocks=64, low=0, high=None):
    mixed = spelling._mixed(spelling.hashes(spelling.letters_of(words)))
    bits = np.zeros(blocks, np.uint64)
    np.bitwise_or.at(bits, spelling.placed(mixed, blocks).astype(int), spelling._BITS[(mixed & np.uint64(0xFFFF)).astype(int)])
    return spelling.Shard(blocks, low, bits[low:high])


def test_parts_of_a_filter_know_what_the_whole_knows():
    r = random.Random(6)
    words = ["".join(r.choice("abcdefgh") for _ in range(9)).encode() for _ in range(3000)]
    asked = spelling.hashes(spelling.letters_of(words[1500:] + words[:100]))
    whole = filter_of(words[:1500], 600).knows(asked)
    parts = np.concatenate([filter_of(words[:1500], 600, low, low + 200).knows(asked) for low in (0, 200, 400)])
    assert sorted(parts) == sorted(whole) and set(range(1500, 1600)) <= set(whole)
    assert len(whole) < 100 + 15 + len(set(words[:1500]) & set(words[1500:])), "few false positives"


def test_rounds_hold_every_segment_once_within_their_bytes():
    sizes = {7: 10, 8: spelling.SEGMENT * 5, 9: spelling.SEGMENT}
    segment = 8 * spelling.SEGMENT
    for most in (1, 2 * segment, 100 * segment):
        got = [(length, s) for held in spelling.rounds(sizes, most) for length, (a, b) in held.items() for s in range(a, b + 1)]
        assert sorted(got) == [(7, 0), *((8, s) for s in range(5)), (9, 0)] and len(got) == len(set(got))
        for held in spelling.rounds(sizes, most):
            assert sum(8 * min(spelling.SEGMENT, sizes[n]) * (b - a + 1) for n, (a, b) in held.items()) <= max(most, segment)
