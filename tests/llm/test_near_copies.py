import random
import re

import corpus_pipeline
import pytest
import test_simhash
from limnospark.llm import near_copies


def shingles(text, width=5):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute(rows):
    """Rows that stay, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    pairs = [(i, j) for j in range(len(rows)) for i in range(j)
             if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    roots, least = test_simhash.roots_of(pairs), {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[roots.get(i, i)] = min(doc_id, least.get(roots.get(i, i), doc_id))
    return pairs, sorted([row for i, row in enumerate(rows) if row[0] == least.get(roots.get(i, i))], key=str)


def edited(pick, words, share):
    return [pick.choice(VOCABULARY) if pick.random() < share else w for w in words]


VOCABULARY = [f"é{i}" for i in range(3000)]


def made(seed, n, copies, share):
    pick, texts = random.Random(seed), []
    for _ in range(n):
        base = [pick.choice(VOCABULARY) for _ in range(pick.randint(1, 160))]
        texts += [" ".join(edited(pick, base, share * pick.random())) for _ in range(pick.randint(1, copies))]
    pick.shuffle(texts)
    return [(i * 7 % 1009, text) for i, text in enumerate(texts)]


ODD = [(4, None), (2, ""), (9, " \n"), (None, "one two three four"), (7, "One  two\tthree four"), (7, "nothing like it at all"), (1, "only two"),
       (None, "alone and without a number"), (None, "others are without a number too"), (3, "word " * 50_000), (5, "word " * 40_000)]
COMMON = [(i, f"{' '.join(VOCABULARY[:60])} {' '.join(VOCABULARY[100 + 20 * i : 110 + 20 * i])}") for i in range(40)]


@pytest.mark.parametrize("rows", [made(1, 60, 6, 0.06), made(2, 4, 60, 0.03), made(3, 30, 8, 0.02), COMMON, ODD, []])
def test_stage_against_all_pairs(spark, rows):
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, node string, k1 int")
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert kept.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == brute(rows)[1]


def test_pairs_that_differ_in_many_bits():
    pairs, kept = brute(made(1, 60, 6, 0.06))
    rows = made(1, 60, 6, 0.06)
    far = [p for p in pairs if (test_simhash.plain_fingerprint(rows[p[0]][1], 5) ^ test_simhash.plain_fingerprint(rows[p[1]][1], 5)).bit_count() > 2]
    assert len(far) > 20 and len(kept) < len(rows)


def test_sets_of_parts():
    assert near_copies._shingles(near_copies.pa.array(["", "a b", "a b c d e a b c d e a"]), 5)[0].tolist() == [1, 2, 2, 2, 2, 2]


def test_entries_of_shingles_are_not_broadcast(spark, monkeypatch):
    """Sorted entries are small in a file and large in memory."""
    plans, stored = {}, near_copies.stored

    def seen(df, label):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(near_copies, "stored", seen)
    docs = spark.createDataFrame(made(3, 6, 3, 0.2), "doc_id long, text string")
    near_copies.without_near_copies(docs).count()
    joins = [line for line in plans["others"].split("\n") if "Join" in line and "b_word" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]
