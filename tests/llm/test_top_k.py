import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.append(os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import compare  # noqa: E402
from limnospark.llm import top_k  # noqa: E402
from limnospark.llm.queries import ORACLES, QUERIES  # noqa: E402


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute(rows, k, chooses):
    rows = dict(sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None}, reverse=True))
    result = []
    for q in filter(chooses, rows):
        best = sorted((-score(rows[q], rows[c]), c) for c in rows if c != q)[:k]
        result += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(best)]
    return sorted(result)


def found(spark, rows, k, chooses):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "id long, vector array<long>, rank int, query_id string")
    return sorted(map(tuple, top_k.nearest(df, k, chooses).collect()))


def vectors(n, width, spread, seed, copies=1):
    pick = random.Random(seed)
    base = [[pick.randint(-spread, spread) for _ in range(width)] for _ in range(n // copies)]
    return [(i, base[i % len(base)]) for i in range(n)]


@pytest.mark.parametrize("rows,k", [
    (vectors(200, 7, 9, 1), 5), (vectors(120, 4, 1, 2), 7), (vectors(150, 6, 20, 3, copies=50), 4), (vectors(6, 3, 5, 4), 20),
    (vectors(90, 1, 3, 5), 3), (vectors(60, 5, 2**27, 6), 5), ([(1, [])] + vectors(40, 3, 4, 7)[10:], 4),
    (vectors(60, 5, 9, 8) * 2 + [(None, [1]), (70, None), (20, [9] * 5)], 6),
])
def test_against_all_pairs(spark, rows, k):
    assert found(spark, rows, k, F.col("id") % 10 == 0) == brute(rows, k, lambda i: i % 10 == 0)


@pytest.mark.parametrize("lists,chunk,block", [(1, 7, 3), (2, 16, 2), (3, 1000, 1000), (5, 10, 10)])
def test_phases_in_many_units(spark, lists, chunk, block):
    rows = vectors(100, 9, 6, 9)
    df = spark.createDataFrame(rows, "id long, vector array<long>")
    got = top_k.top_k(df.where("id % 9 = 0"), df, 4, lists, chunk, block).collect()
    expected = []
    for q, v in rows[::9]:
        expected += [(q, c, -s) for s, c in sorted((-score(v, w), c) for c, w in rows)[:4]]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_few_or_no_rows(spark):
    assert found(spark, [], 3, F.col("id") >= 0) == []
    assert found(spark, [(3, [1])], 3, F.col("id") >= 0) == []
    assert found(spark, [(3, [1]), (4, [2])], 3, F.col("id") > 9) == []
    assert found(spark, [(3, [1]), (4, [2])], 3, F.col("id") == 4) == [(4, 1, 3, 2)]


def test_scaling(spark):
    rows = [([0.5, -0.01],), ([1.0, None],), ([float("nan")],), ([float("-inf")],), (None,), ([],), ([3e38],)]
    got = [r[0] for r in spark.createDataFrame(rows, "e array<float>").select(top_k.scaled(F.col("e"))).collect()]
    assert got == [[32, -1], None, None, None, None, [], None]


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare.difference(QUERIES["op2_top_k"](spark, folder), compare.connect(folder), ORACLES["op2_top_k"]) == ""
