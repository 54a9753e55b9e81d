import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from limnospark.llm import simhash
from limnospark.llm.components import components
from limnospark.llm.queries import QUERIES


def plain_fingerprint(text, width=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB cÉ\t\n\x0b\x1f\xa0é", max_size=40) | st.text(max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('one two three')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_every_word_has_one_home_within_the_radius():
    fps = np.random.default_rng(1).integers(0, 2**64, 2000, np.uint64)
    index, home = simhash.anchors(fps, 0)
    assert index.tolist() == list(range(2000))
    assert max(int(x).bit_count() for x in fps ^ home) <= 14
    again, same = simhash.anchors(home, 0)
    assert (same == home).all()


@pytest.mark.parametrize("reach", [0, 1, 2, 3])
def test_near_words_meet(reach):
    fps = np.random.default_rng(2).integers(0, 2**64, 60, np.uint64)
    random.seed(3)
    for fp in fps.tolist():
        other = fp
        for bit in random.sample(range(64), reach):
            other ^= 1 << bit
        _, home = simhash.anchors(np.array([fp], np.uint64), 0)
        index, copies = simhash.anchors(np.array([other, fp], np.uint64), reach)
        assert int(home[0]) in copies[index == 0].tolist()
        assert len(set(copies[index == 0].tolist())) == (index == 0).sum()


def test_copies_on_average():
    index, _ = simhash.anchors(np.random.default_rng(4).integers(0, 2**64, 20_000, np.uint64), 2)
    assert 69 < len(index) / 20_000 < 73


def signed(fp):
    return fp - 2**64 if fp >> 63 else fp


def test_links_against_all_pairs(spark):
    random.seed(5)
    fps = {random.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for fp in list(fps)[:150]:
        for _ in range(random.randint(1, 6)):
            for bit in random.sample(range(64), random.randint(1, 3)):
                fp ^= 1 << bit
            fps.add(fp)
    rows = sorted(map(signed, fps))
    expected = {(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= 2}
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in rows], "fp long")).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 100


def roots_of(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("pairs", [
    [], [(5, 5)], [(i, i + 1) for i in range(40)], [(40 - i, 41 - i) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(i, 99) for i in range(50)] + [(100, 101), (101, 102), (101, 100)],
    [(random.Random(6).randint(0, 90), random.Random(i).randint(0, 90)) for i in range(60)],
])
def test_components(spark, pairs):
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    expected = roots_of((a, b) for a, b in pairs if a != b)
    assert len(got) == len(expected) and {r.node: r.root for r in got} == expected


def brute(rows):
    prints = [plain_fingerprint(text or "") for _, text in rows]
    distinct = sorted(set(prints))
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 2]
    roots = roots_of(pairs)
    smallest = {}
    for (doc_id, _), fp in zip(rows, prints):
        if doc_id is not None:
            root = roots.get(fp, fp)
            smallest[root] = min(doc_id, smallest.get(root, doc_id))
    return sorted(((d, f"{fp:016x}", smallest.get(roots.get(fp, fp))) for (d, _), fp in zip(rows, prints)), key=str)


def test_odd_rows(spark):
    rows = [(4, None), (2, ""), (9, " \n"), (None, "one two three four"), (7, "One  two\tthree four"), (7, "one two three four"),
            (1, "only two"), (3, "word " * 100_000), (None, "alone and without a number")]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, fingerprint string, fp long")
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str) == brute(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op1_simhash"](spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_copies_are_not_broadcast(spark):
    """Spark sizes the copies, 71 for each fingerprint, like the fingerprints."""
    nodes = spark.range(5).selectExpr("id as fp", "id as smallest")
    plan = simhash.links(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 1
