import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from limnospark.llm import lines
from limnospark.llm.queries import QUERIES

BLANK = " \t\n\x0b\x0c\r"


def word_set(line):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return frozenset(w for w in re.split(f"[{BLANK}]+", lower) if w)


def brute(rows, threshold):
    """Removed places by comparing every line with all earlier ones."""
    places = sorted(((-(2**63) if i is None else i), n, word_set(line)) for i, text in rows for n, line in enumerate((text or "").split("\n")))
    places = [p for p in places if p[2]]
    removed = {}
    for at, (doc, line, words) in enumerate(places):
        removed[None if doc == -(2**63) else doc, line] = any(
            len(words & w) >= threshold * len(words | w) - 1e-9 and (d, n) != (doc, line) for d, n, w in places[:at])
    return removed


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, line string, size int, word string")


def made(seed, n, vocabulary, width):
    pick = random.Random(seed)
    base = [[pick.choice(vocabulary) for _ in range(pick.randint(1, width))] for _ in range(n // 3)]
    result = []
    for i in range(n):
        text = []
        for _ in range(pick.randint(0, 4)):
            words = list(pick.choice(base))
            for _ in range(pick.randint(0, 2)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary).upper()
            text.append(" ".join(words))
        result.append((i * 3 % (n + 1), "\n".join(text)))
    return list(dict(result).items())


SMALL, LARGE = [f"w{i}" for i in range(9)], [f"é{i}" for i in range(400)]


@pytest.mark.parametrize("rows,threshold,heavy", [
    (made(1, 60, SMALL, 8), 0.8, 5), (made(2, 80, LARGE, 25), 0.8, 5), (made(3, 80, LARGE, 40), 0.8, 10**6), (made(4, 70, LARGE, 12), 0.5, 0),
    (made(5, 60, LARGE, 30), 1.0, 3), ([(i, f"the same words but number {i} and a few more words of the page") for i in range(60)], 0.8, 4),
    ([], 0.8, 5), ([(3, None), (4, ""), (5, " \n\t\r\n")], 0.8, 5),
    ([(None, "first line\nother"), (1, "other\nFIRST line\nline first first\n\nnew"), (2, "word " * 100_000 + "\n" + " ".join(LARGE)), (7, " ".join(LARGE[:390]))], 0.8, 5),
])
def test_against_all_pairs(spark, rows, threshold, heavy):
    got = lines.removed_lines(frame(spark, rows), threshold, heavy).collect()
    expected = brute(rows, threshold)
    assert len(got) == len(rows)
    assert {(r.doc_id, n) for r in got for n in r.removed_lines} == {place for place, gone in expected.items() if gone}
    assert sum(r.n_lines for r in got) == len(expected) and all(r.removed_lines == sorted(r.removed_lines) for r in got)


@pytest.mark.parametrize("heavy", [0, 5, 10**6])
def test_pairs_name_matching_earlier_lines(spark, heavy):
    rows = made(6, 60, LARGE, 20)
    df = frame(spark, rows)
    sets = lines.line_rows(df, lines.word_counts(df), 0.8, heavy).withColumn("open", F.lit(1))
    found = lines.verified(df, lines.all_pairs(sets, 0.8).unionByName(lines.leader_pairs(sets, 0.8)).distinct(), 0.8).collect()
    texts = {(i, n): word_set(line) for i, text in rows for n, line in enumerate(text.split("\n"))}
    assert len(found) > 10
    for r in found:
        one, other = texts[r.doc, r.line], texts[r.a_doc, r.a_line]
        assert (r.a_doc, r.a_line) < (r.doc, r.line) and len(one & other) >= 0.8 * len(one | other) - 1e-9


def test_repeated_rows_share_their_places(spark):
    rows = [(1, "one two three\nfour five six"), (1, "one two three\nfour five six"), (2, "four five six\nseven")]
    kept = lines.without_repeated_lines(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, rows[0][1]), (1, rows[0][1]), (2, "seven")]


def test_texts_without_repeated_lines(spark):
    rows = [(1, "alpha beta\n\ngamma delta\n"), (2, "Gamma  DELTA"), (3, "new words\nalpha beta\n\nlast"), (4, ""), (5, None), (None, "alpha beta")]
    df = frame(spark, rows)
    kept = lines.without_repeated_lines(df)
    assert kept.columns == df.columns
    got = {r.doc_id: r.text for r in kept.collect()}
    assert got == {1: "\ngamma delta\n", 3: "new words\n\nlast", 4: "", 5: None, None: "alpha beta"}


def test_counts_of_words(spark):
    rows = [(i, "one two two\nThree " + "x" * (i % 7)) for i in range(300)]
    total = lines.word_counts(frame(spark, rows).repartition(130))
    names = ["one", "two", "three"]
    at = dict(zip(names, lines._counted_at(lines._hashed(pa.array(names))[0]).tolist()))
    assert [int(total[at[w]]) for w in ("one", "two", "three")] == [300, 600, 300]
    assert int(total.sum()) == sum(len(t.split()) for _, t in rows)


def test_prefix_length():
    for x in range(1, 200):
        p = lines.prefix_length(x, 0.8)
        assert x - p + 1 == -(-8 * x // 10) and p >= 1


def test_filter_holds_every_place(spark):
    places = spark.range(1000).select(F.col("id").alias("doc"), (F.col("id") % 7).cast("int").alias("line"))
    bits = lines._filter_of(places)
    own = lines._marks(np.arange(1000), np.arange(1000) % 7)
    assert bits[own].all() and bits.sum() <= 1000


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = brute(rows, 0.8)
    got = QUERIES["op3_lines"](spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert {(r.doc_id, n) for r in got for n in r.removed_lines} == {p for p, gone in expected.items() if gone}
    assert sum(r.n_lines for r in got) == len(expected) and sum(r.n_kept for r in got) == sum(not x for x in expected.values())


def test_hashes_of_words():
    names = [f"{a}{b}" for a in ("x", "é", "日本", "") for b in range(3000)] + ["w" * n for n in (255, 256, 257, 5000)] + ["w" * 255 + "v" * 9]
    found = lines._hashed(pa.array(names))
    assert found.shape == (2, len(names)) and all(len(set(row.tolist())) == len(names) for row in found)
    assert (lines._hashed(pa.array(["out", *names, "out"]).slice(1, len(names))) == found).all()


SHARED = ([(None, "intro one\nd e f g h"), (None, "d e f g\nunique clean line"), (None, "same text\nagain"), (None, "same text\nagain"), (None, "same text\nagain"), (None, " "), (None, " ")]
          + [(5, "one line of five words\nmore"), (5, "other words in here\none line of five words"), (5, "one line of five words\nthird"), (6, "third\nlast")]
          + [(None if i % 3 else i % 2, text) for i, text in made(7, 40, SMALL, 8)])


def brute_rows(rows, threshold):
    """doc_id, text and removed lines of each row: places are id, hash of the text, and copy of a text without an id."""
    seen, places, keys = Counter(), [], []
    for doc, text in rows:
        tie = xxhash.xxh64_intdigest((text or "").encode(), 42)
        tie -= (tie >> 63) << 64
        keys.append((-(2**63) if doc is None else doc, tie, seen[text] if doc is None else 0))
        seen[text] += doc is None
        places += [(keys[-1], n, word_set(line)) for n, line in enumerate((text or "").split("\n")) if word_set(line)]
    result = []
    for key, (doc, text) in zip(keys, rows):
        gone = [n for k, n, w in places if k == key and any((k2, n2) < (k, n) and len(w & w2) >= threshold * len(w | w2) - 1e-9 for k2, n2, w2 in places)]
        result.append((doc, text, sorted(set(gone))))
    return result


def test_rows_without_ids_or_with_one_id(spark):
    expected = brute_rows(SHARED, 0.8)
    got = lines.removed_lines(frame(spark, SHARED), 0.8, 5).collect()
    assert Counter((r.doc_id, r.n_lines, tuple(r.removed_lines)) for r in got) == Counter(
        (doc, sum(bool(word_set(x)) for x in text.split("\n")), tuple(gone)) for doc, text, gone in expected)
    left = Counter()
    for doc, text, gone in expected:
        own = text.split("\n")
        stay = [x for n, x in enumerate(own) if n not in gone]
        if not gone or any(word_set(x) for x in stay):
            left[doc, "\n".join(stay)] += 1
    assert Counter((r.doc_id, r.text) for r in lines.without_repeated_lines(frame(spark, SHARED), 0.8, 5).collect()) == left
    assert left[None, "intro one\nd e f g h"] + left[None, "d e f g\nunique clean line"] >= 1


def test_near_copies_make_a_pair_once_for_a_run_of_common_words(spark):
    """A pair was once made for each word that both prefixes hold."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), " ".join([*words[:-1], "y"]), " ".join([*words[:30], "z", *words[31:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lines.line_rows(docs, lines.word_counts(docs), 0.8, 512).withColumn("id", F.monotonically_increasing_id()).withColumn("open", F.lit(1))
    made = lines._joined(lines._with_previous(lines._entries(rows, None, "open", "prefix")), 0.8).select("a.id", "b.id").count()
    shared = rows.alias("a").join(rows.alias("b"), F.col("a.doc") < F.col("b.doc")).agg(F.sum(F.size(F.array_intersect("a.prefix", "b.prefix")))).first()[0]
    assert lines.all_pairs(rows, 0.8).count() == 6 and 6 <= made <= 12 < shared


def test_words_of_a_pair_are_compared_once(spark):
    """A filter once split both texts three times and intersected them twice."""
    pairs = spark.createDataFrame([(2, 0, 0, 1, 0, 0), (3, 0, 0, 1, 0, 0)], "doc long, tie long, line int, a_doc long, a_tie long, a_line int")
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "E d c b\ta a"), (3, "a b c d x y")], "doc_id long, text string")
    places = lines._places(docs).select("doc", "tie", F.lit(0).alias("line"))
    texts = lines._lines_at(docs, places).withColumn("tie", F.lit(0).cast("long"))
    found = lines._matching(pairs, texts, 0.8)
    assert [r.doc for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 1 and plan.count("split(") == 2


def test_light_words_are_compared_in_reach_without_a_join(spark):
    """Every two entries of a word were once joined; the numbers found are those of the join."""
    df = frame(spark, made(8, 150, LARGE, 30) + [(1000 + i, f"{i} same line of very few words") for i in range(40)])
    sets = lines.line_rows(df, lines.word_counts(df), 0.8, 10**6).withColumn("id", F.monotonically_increasing_id()).withColumn("open", (F.col("doc") % 3 > 0).cast("int"))
    entries = lines._with_previous(lines._entries(sets, None, "open", "prefix")).localCheckpoint()
    met = lines._met(entries, 0.8)
    joined = lines._joined(entries, 0.8).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))
    assert sorted(met.collect()) == sorted(joined.collect()) and met.count() > 100
    assert "Join" not in met._jdf.queryExecution().optimizedPlan().toString()
    key = np.sort(np.repeat(np.arange(3) << 32, 400) + np.arange(1200) % 37 + 1)
    size, none = key & 0xFFFFFFFF, np.zeros(1200, np.int64)
    reach, ids = (size * 5 // 4) * 2 + 1, np.arange(1200)
    found = {(a, b) for part in lines._in_reach(key, reach, ids, ids, none, none, ids, 0.8) for a, b in zip(*part.to_pydict().values())}
    assert found == {(a, b) for a in range(1200) for b in range(a + 1, 1200) if key[a] >> 32 == key[b] >> 32 and max(size[a], size[b]) * 0.8 <= min(size[a], size[b]) + 1e-9}


def test_entries_of_heavy_words_are_not_broadcast(spark):
    """Entries are many for each row that Spark sizes them by."""
    entries = spark.range(5).selectExpr("id", "id as doc", "5 as size", "id as bits1", "id as bits2", "cast(id % 2 as int) as word", "0 as at", "1 as open", "cast(id as int) as previous")
    plan = lines._joined(entries, 0.8)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 1
