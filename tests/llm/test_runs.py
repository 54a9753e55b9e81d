import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from limnospark.llm import runs
from limnospark.llm.queries import QUERIES


def brute(words, least=6, times=4):
    """All maximal stretches by trying every period at every place; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)  # ascending q: the smallest period comes first
            i = j + 1 if j > i else i + 1
    kept = []
    for (start, length), q in found.items():
        part = words[start:start + length]
        if not any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)):
            kept.append((start, length, q))
    return sorted(kept, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def of_arrays(texts):
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    got, begin = [[] for _ in texts], np.cumsum(sizes) - sizes
    for start, length, q in zip(*(x.tolist() for x in runs.runs_of(ids, sizes))):
        owner = int(np.searchsorted(begin + sizes, start, side="right"))
        got[owner].append((start - int(begin[owner]), length, q))
    return got


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4))
def test_two_letters_against_brute_force(texts):
    assert of_arrays(texts) == [brute(words) for words in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(2, 9), st.lists(st.sampled_from("abc"), max_size=20), st.integers(0, 8))
def test_planted_periods_against_brute_force(unit, times, before, cut):
    words = [*before, *(unit * times)[:len(unit) * times - cut], *before[:3], *(unit * 5)]
    assert of_arrays([words, words[::-1]]) == [brute(words), brute(words[::-1])]


def test_long_period():
    rng = np.random.default_rng(3)
    unit = [str(x) for x in rng.integers(0, 50, 3001)]
    words = ["x", *unit * 5, *unit[:17], "y"]
    assert of_arrays([words]) == [[(1, 5 * 3001 + 17, 3001)]]


def test_rows(spark):
    long = " ".join(["spam", "egg"] * 50_000)
    texts = ["a a a a a a", None, "", "a b a b a b a b c", " x  x  x  x  x  x", long, long, " \t\n", "A a A a a a a a"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    got = runs.find_runs(docs, "doc_id", "words").collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got}
    for i, text in enumerate(texts):
        row = by[i if i != 3 else None]
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = brute(words) if len(words) < 100 else [(0, 100_000, 2)]
        assert [tuple(r) for r in row.runs] == found and row.n_words == len(words)
        assert row.collapsed == collapse(words, found)
    assert runs.find_runs(docs.limit(0), "doc_id").count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs.withColumnRenamed("words", "runs"), "runs")


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute(words)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    start, length, q = best or (None, None, None)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    return (doc_id, len(found), start, length, q, None if best is None else 1000 * length // q,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapse(words, found).encode()).hexdigest())


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_runs"](spark, folder).collect()}
    assert len(got) == len(rows) > 100
    small = [r for r in rows if len((r.text or "").split()) < 700]
    assert len(small) > 100 and any(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in small)
    for r in small:
        assert got[r.doc_id] == expected(r.doc_id, r.text)
