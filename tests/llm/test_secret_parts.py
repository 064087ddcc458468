"""Keys and long words are looked for in the long parts of a text only, and found as by patterns over all of it."""

import random
import re

import pytest

from leadmill.llm import secrets

PIECES = ["a", "0123456789abcdef" * 2, "deadbeef" * 5, "AKIA" + "Q7" * 9, "token=", "secret: ", "Wörterbuch", "donaudampfschiffahrt", "x²lettersⅧ", "under_score", "http://host.example/path/to", "zz9" * 8, "…", "ab" * 40, "12345678901234567"]
SPACES = [" ", "", "\n", "\t ", " ", "\x1c", "\x85", ", "]


def texts():
    r = random.Random(5)
    return ["", " "] + ["".join(r.choice(PIECES) + r.choice(SPACES) for _ in range(r.randrange(1, 60))) for _ in range(300)]


@pytest.mark.parametrize("whole", [1_000_000, 100])
def test_as_by_patterns_over_all(monkeypatch, whole):
    monkeypatch.setattr(secrets, "WHOLE", whole)
    for text in texts():
        assert secrets.parts(text) == [(m.start(), m[0]) for m in re.finditer(r"\S{8,}", text)]
        assert [s[:2] for s in secrets.rule_spans(text) if s[2] == "hex"] == [m.span() for m in secrets.HEX.finditer(text)]
        assert secrets.candidates(text, []) == [m.span() for m in secrets.RUN.finditer(text)]
        words = [m[0] for m in re.finditer(r"(?<!\S)[^\W\d_]{8,64}(?!\S)", text)]
        bodies = [w[secrets.CONTEXT : -secrets.CONTEXT].rstrip("\0") for w, y in secrets.labelled(text) if y == 0]
        assert [w for w in words[::8] if w not in bodies] == []


def test_prose_is_not_searched_for_keys(monkeypatch):
    looked = []

    class Spy:
        def __init__(self, plain):
            self.plain = plain

        def finditer(self, text, *span):
            looked.append(span[1] - span[0] if span else len(text))
            return self.plain.finditer(text, *span)

    for name in ("HEX", "RUN"):
        monkeypatch.setattr(secrets, name, Spy(getattr(secrets, name)))
    assert list(secrets.labelled("some words of ordinary length and 0123456789abcdef0123456789abcdef\n" * 50))
    assert sum(looked) == 2 * 32 * 50


@pytest.mark.filterwarnings("ignore:fewer than")
def test_masks_what_the_rules_find(spark):
    rows = [(1, "token = abcdefgh12 and secret: 'ijklmnop34', then none"), (2, "of AKIA" + "Q7" * 9), (3, "0123456789abcdef" * 2), (4, "nothing here"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    masked = {r.doc_id: r.text for r in secrets.redact_secrets(docs, mask="#").collect()}
    assert masked == {1: "token = # and secret: '#', then none", 2: "of #", 3: "#", 4: "nothing here", 5: "", 6: None}
