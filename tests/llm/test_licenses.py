import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from limnospark.llm import licenses
from limnospark.llm.licenses import PHRASES, TEMPLATES, Automaton, Scanner, words_of
from limnospark.llm.queries import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCANNER = Scanner()


def plain_words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aZ09 éÉ_-.\x7f", max_size=40))
def test_words(text):
    assert [w.decode() for w in words_of(text)] == plain_words(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=30))
def test_matching_statistics(sequences, words):
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i, len(s) + 1)}
    automaton = Automaton(sequences)
    for i, (state, run) in enumerate(automaton.statistics(words)):
        assert run == max(n for n in range(i + 2) if not n or tuple(words[i + 1 - n : i + 1]) in runs)
        if run:
            expected = {(t, e) for t, s in enumerate(sequences) for e in range(len(s)) if s[max(0, e + 1 - run) : e + 1] == words[i + 1 - run : i + 1]}
            assert set(automaton.ends[state]) == expected


def brute_base(text):
    words, found = plain_words(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


PIECES = [*PHRASES, "GNU", "general", "Public-License", "cc", "by", "mit", "the license", "apache", "é", "_", "\n", "gnu general", "word"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=20).map(" ".join))
def test_phrases_against_brute_force(text):
    assert SCANNER.scan(text)[:5] == brute_base(text)


@pytest.mark.parametrize("label", TEMPLATES)
def test_templates_are_found_with_small_changes(label):
    random.seed(label)
    words = TEMPLATES[label].split()
    words[len(words) // 2] = "changed"
    text = " ".join(["before"] * 9 + words + ["after"] * 9)
    spans = [s for s in SCANNER.scan(text)[7] if s["label"] == label]
    assert spans and max(s["covered"] for s in spans) > 0.85
    widest = max(spans, key=lambda s: s["covered"])
    assert widest["first"] == 9 and widest["last"] == len(plain_words(text)) - 10
    assert label in SCANNER.scan(text)[5].split(",")


def test_short_overlaps_are_no_licence():
    assert SCANNER.scan("the terms of the software and this list of conditions are free")[5:7] == ("", 0.0)


def test_rows_that_are_odd(spark):
    rows = [(1, None), (None, "mit license"), (2, ""), (3, "x " * 200_000 + "CC-BY"), (1, "MIT License"), (1, "MIT License")]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, labels string, score string")
    got = licenses.scan_licenses(df).collect()
    assert len(got) == 6
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[1, 0].labels == "" and by[2, 0].first_word is None and by[2, 0].score == 0.0
    assert by[3, 200_002].first_word == 200_000 and by[3, 200_002].base_labels == "cc-by"
    assert by[None, 2].base_labels == "mit"
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_licenses"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert any(r.n_base for r in rows)
