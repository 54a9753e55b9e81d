import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from limnospark.llm import fingerprints
from limnospark.llm.queries import QUERIES


def units(text):
    return {p for p in re.split("[.!?\n\r]+", text) if p.strip(" ")}


def likeness(a, b):
    a, b = units(a), units(b)
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def brute(rows):
    """doc_id, n_chars, hash and likenesses by plain sets."""
    keyed = [(-(2**63) if i is None else i, t or "") for i, t in rows]
    ids = sorted({k for k, _ in keyed})
    result = []
    for key, text in keyed:
        after = ids[(ids.index(key) + 1) % len(ids)]
        wanted = max(len(t) // 4 for k, t in keyed if k == key)
        following = min((t for k, t in keyed if k == after), key=lambda t: t[:wanted])
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        result.append((None if key == -(2**63) else key, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                       pytest.approx(likeness(text, edited)), pytest.approx(likeness(text, following))))
    return sorted(result, key=str)


def shown(df):
    columns = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: str(r[:3]))


def same(df, rows):
    got, expected = shown(df), sorted(brute(rows), key=lambda r: str(r[:3]))
    assert got == expected


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, version string, key int")


def text_of(seed, n):
    pick = random.Random(seed)
    return "".join(f"{pick.choice(['alpha', 'béta', 'gamma', ''])} {pick.randint(0, 10**6)}{pick.choice(['. ', '! ', chr(10), '...'])}" for _ in range(n))


def test_against_sets(spark):
    rows = [(3 * i + 1, text_of(i, n)) for i, n in enumerate([0, 1, 2, 3, 5, 8, 40, 41, 3000, 2, 1, 17, 90, 1, 6])]
    rows += [(5, None), (None, "no id. at all. " + text_of(99, 9)), (40, ""), (41, " \n. "), (500, "𝔘nicode 日本. " * 40), (501, "𝔘nicode 日本. " * 40)]
    same(fingerprints.fingerprint_versions(frame(spark, rows)), rows)


def test_repeated_rows_and_equal_texts(spark):
    rows = [(1, text_of(1, 20)), (1, text_of(1, 20)), (2, text_of(2, 10)), (2, text_of(3, 30)), (9, text_of(1, 20)), (4, "one")]
    df = fingerprints.fingerprint_versions(frame(spark, rows))
    same(df, rows)
    prints = {}
    for row in df.select("n_chars", "fingerprint").collect():
        prints.setdefault(row.n_chars, set()).add(row.fingerprint)
    assert all(len(found) == 1 for found in prints.values()) and len(set.union(*prints.values())) == len(prints)


def test_one_document_and_none(spark):
    same(fingerprints.fingerprint_versions(frame(spark, [(7, "a. b. c. d.")])), [(7, "a. b. c. d.")])
    assert fingerprints.fingerprint_versions(frame(spark, [])).count() == 0


def test_small_sketches_are_tried_again(spark, monkeypatch):
    tries = []
    enough = fingerprints._enough

    def small(left, right, number):
        tries.append(number)
        return F.lit(2 << number).cast("long")

    monkeypatch.setattr(fingerprints, "_enough", small)
    monkeypatch.setattr(fingerprints, "ROUNDS", 2)
    rows = [(i, text_of(i, 12)) for i in range(12)]
    same(fingerprints.fingerprint_versions(frame(spark, rows)), rows)
    assert tries == [0, 1] and enough is not small


@pytest.mark.parametrize("n,cells", [(5, 8), (60, 60), (400, 300)])
def test_peeling_finds_the_digests(spark, n, cells):
    left, right = list(range(n)), list(range(n // 2, n + 7))
    pairs = spark.createDataFrame([(1, 2, left, right, cells)], "key long, pair long, left array<long>, right array<long>, size long")
    rows = fingerprints.peel(fingerprints.cell_rows(pairs, 5), 5).collect()
    assert all(r.spot == fingerprints.FOUND for r in rows)
    assert {r.found for r in rows if r.n == 1} == set(left) - set(right)
    assert {r.found for r in rows if r.n == -1} == set(right) - set(left)


def test_no_python_and_no_move_after_the_join(spark):
    df = fingerprints.edited_pairs(frame(spark, [(i, text_of(i, 5)) for i in range(9)]))
    rows = df.select("key", F.lit(0).cast("long").alias("pair"), fingerprints.digests(F.col("text")).alias("left"),
                     F.col("next_units").alias("right"), F.lit(9).cast("long").alias("size"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = fingerprints.differences(rows, 0)
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    top = plan[: plan.index("SortMergeJoin")]
    assert "Exchange" not in top and top.count("HashAggregate") > 30


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    same(QUERIES["op4_fingerprints"](spark, folder), rows)
