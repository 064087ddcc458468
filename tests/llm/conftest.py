import random

import pytest

WORDS = "the of on tion with re ha ea ing ou ti was thre ster lyon eder ander athe orea hent".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): null and empty texts, a very long one, copies, near copies, repeated rows, odd
    characters, null ids."""
    r = random.Random(3)
    base = prose(r, 120)
    rows = [(i, prose(r, r.randrange(1, 80)) + "\n" + prose(r, 12)) for i in range(20)]
    rows += [(20, None), (21, ""), (22, " \n\t "), (23, prose(r, 20000)), (24, base), (25, base), (26, base + " extra"), (27, "x" * 30000)]
    rows += [(28, "été Ünïcode 日本語 <|endoftext|> a  b \n c"), (29, base), (29, base), (None, base), (None, None), (30, "mail a.b@c.de token = abcdefgh12 +49 30 1234567 10.0.0.1")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with further columns, some named like results."""
    rows = [(t, i, "en", "s", 1.5, 7) for i, t in odd_rows]
    return spark.createDataFrame(rows, "text string, doc_id long, lang string, source string, score double, n_tokens int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
