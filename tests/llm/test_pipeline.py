"""Each stage of the pipeline, held against plain Python on its own input."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from leadmill.llm import secrets
from leadmill.llm.common import spool, table

from .conftest import prose
from .test_brute_force import jaccard_components, one_edit


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    given = {}
    for name, stage in corpus_pipeline.STAGES:
        done = spool(stage(spark, docs, data), name)
        given[name] = ({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}, done)
        if name != "packing":
            assert done.columns == docs.columns
            assert done.filter("n_chars <> length(text)").count() == 0
        docs = done

    before, done = given["toxicity"]
    kept = {r.doc_id: r.text for r in done.collect()}
    assert 0.8 * len(before) < len(kept) <= len(before) and all(before[i] == t for i, t in kept.items())

    before, done = given["line_dedup"]
    seen, want = [], {}
    for i in sorted(before):
        lines = []
        for line in before[i].split("\n"):
            long = len(line) >= 30
            if not (long and (line in seen or any(abs(len(s) - len(line)) <= 1 and one_edit(line, s) for s in seen))):
                lines.append(line)
            if long and line not in seen:
                seen.append(line)
        if "\n".join(lines).strip() or lines == before[i].split("\n"):
            want[i] = "\n".join(lines)
    assert {r.doc_id: r.text for r in done.collect()} == want

    before, done = given["near_duplicates"]
    components = jaccard_components(before, 5, 80)
    assert {r.doc_id: r.text for r in done.collect()} == {i: t for i, t in before.items() if components[i][1] == i}

    before, done = given["secrets"]
    after = {r.doc_id: r.text for r in done.collect()}
    assert set(after) == set(before)
    for i, text in before.items():
        if not secrets.rule_spans(text) and "[secret]" not in after[i]:
            assert after[i] == text
        assert not [s for s in secrets.rule_spans(after[i]) if s[2] != "assign"]
        assert not re.search("AKIA[A-Z0-9]{12}", after[i])

    before, done = given["packing"]
    rows = done.collect()
    assert {r.doc_id for r in rows} == set(before)
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


STAGES = dict(corpus_pipeline.STAGES)
KEEPING = [n for n in STAGES if n != "packing"]


@pytest.fixture(scope="module")
def clashing(spark, odd_rows):
    """Odd rows with columns named like results and helpers of the operators, n_chars null."""
    rows = [(i, t, "en", None, 9, 8, 7.5, "k", f"own{n}") for n, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, n_lines long, n_removed int, score double, component string, `a.b` string")


@pytest.mark.parametrize("name", KEEPING)
def test_odd_rows_keep_their_columns(spark, data, clashing, odd_rows, name):
    done = STAGES[name](spark, clashing, data)
    assert done.columns == clashing.columns
    rows = done.collect()
    assert all((r.n_lines, r.n_removed, r.score, r.component, r.lang) == (9, 8, 7.5, "k", "en") for r in rows)
    assert all(r["a.b"] in {f"own{n}" for n in range(len(odd_rows))} for r in rows)
    got = Counter((r.doc_id, r.text) for r in rows)
    given = Counter(odd_rows)
    if name == "toxicity":
        assert not got - given
    if name == "near_duplicates":
        # 24, 25, the three rows of 29, and 26 (one word more) are near-duplicates; a null id has no group.
        assert given - got == Counter({x: n for x, n in given.items() if x[0] in (25, 26, 29)})
    if name == "line_dedup":
        assert {i for i, _ in given} - {i for i, _ in got} == {25, 29}
        assert all(got[x] == n for x, n in given.items() if x[0] in (None, 20, 21, 22, 23, 24, 27))
    if name == "secrets":
        assert got[30, "mail a.b@c.de token = [secret] +49 30 1234567 10.0.0.1"] == 1
        assert all(got[x] == n for x, n in given.items() if x[0] in (None, 20, 21, 22, 23, 24, 28, 29))
    if name in ("line_dedup", "secrets"):
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_table_through(spark, data, clashing, name):
    assert STAGES[name](spark, clashing.limit(0), data).collect() == []


def test_packing_of_odd_rows(spark, data, clashing, odd_rows):
    rows = STAGES["packing"](spark, clashing, data).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in odd_rows}
    assert sum(r.start == 0 for r in rows) == len(odd_rows)
    assert all(r.doc_tokens == 1 for r in rows if r.doc_id in (20, 21))


def test_document_of_line_feeds_goes(spark, data):
    line = prose(random.Random(5), 9)
    docs = spark.createDataFrame([(1, line), (2, f"{line}\n\n\n{line}"), (3, " \n\t"), (4, f"{line}\n\u00a0")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in STAGES["line_dedup"](spark, docs, data).collect()} == {1: line, 3: " \n\t"}


def test_different_texts_of_one_id_are_different_documents(spark, data):
    r = random.Random(6)
    a, b = prose(r, 60), prose(r, 60)
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (5, b)], "doc_id long, text string")
    assert sorted((x.doc_id, x.text) for x in STAGES["near_duplicates"](spark, docs, data).collect()) == sorted([(1, a), (5, b), (5, b)])


def test_run_is_the_stages_in_turn(spark, data):
    docs = table(spark, data, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spool(stage(spark, docs, data), name)
    want = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in STAGES["packing"](spark, docs, data).collect()}
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, data).collect()} == want
