import hashlib
import os
import random
import re
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.append(os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import compare  # noqa: E402
from limnospark.llm import mixing  # noqa: E402
from limnospark.llm.queries import ORACLES, QUERIES  # noqa: E402

NAMES = ["domain", "lang", "source"]


def fill(budget, children):
    """Water level by going over the children again and again. children: name to (capacity, weight)."""
    filled, left = {n: 0 for n, (_, w) in children.items() if not w}, budget
    while True:
        others = {n: c for n, c in children.items() if n not in filled}
        if not others:
            return filled
        level = left / sum(w for _, w in others.values())
        short = {n: c for n, (c, w) in others.items() if c <= level * w}
        if not short:
            return {**filled, **{n: int(level * w) for n, (_, w) in others.items()}}
        filled |= short
        left -= sum(short.values())


def brute_budgets(leaves, budget, weights, epochs):
    def weight(path):
        return next((w for key, w in weights.items() if len(key) == len(path) and all(k in ("*", p) for k, p in zip(key, path))), 1)

    capacity = defaultdict(int)
    for leaf, tokens in leaves.items():
        if all(weight(leaf[:d]) for d in (1, 2, 3)):
            for d in range(4):
                capacity[leaf[:d]] += tokens * epochs
    result = {(): min(budget, capacity[()])}
    for depth in range(3):
        for parent in [p for p in result if len(p) == depth]:
            children = {leaf[: depth + 1] for leaf in leaves if leaf[:depth] == parent}
            result |= fill(result[parent], {c: (capacity[c] if weight(c) else 0, weight(c)) for c in children})
    return {leaf: result[leaf] for leaf in leaves}


def brute(rows, budget, weights, epochs, seed):
    docs = [(i, tuple(x or "" for x in path), len(re.findall(r"[^ \t\n\x0b\f\r]+", text or ""))) for i, path, text in rows]
    leaves = defaultdict(int)
    for _, leaf, n in docs:
        leaves[leaf] += n
    parts = brute_budgets(leaves, budget, weights, epochs)
    result = []
    for leaf, part in parts.items():
        whole = part // leaves[leaf] if leaves[leaf] else 0
        rest = part - whole * leaves[leaf]
        keyed = sorted((hashlib.md5(":".join(map(str, [seed, whole] + ([i] if i is not None else []))).encode()).hexdigest(), i, n)
                       for i, own, n in docs if own == leaf)
        for key, i, n in keyed:
            upto = sum(m for other, _, m in keyed if other <= key)
            result += [(i, *leaf, n, e) for e in range(whole + (rest > 0 and upto <= rest))]
    return sorted(result, key=str)


def made(n, seed):
    pick = random.Random(seed)
    return [(i, (pick.choice("ab"), pick.choice(["en", "de", None]), pick.choice(["s1", "s2", "s3"])), "w " * pick.choice([0, 1, 3, 40])) for i in range(n)]


WEIGHTS = {("a",): 3, ("*", "en"): 2, ("b", "de", "s1"): 7, ("*", "*", "s3"): 0}


@pytest.mark.parametrize("rows,budget,epochs", [
    (made(300, 1), 900, 1), (made(300, 2), 5000, 2), (made(60, 3), 10**9, 3), (made(80, 4), 0, 1), (made(40, 5), 37, 1), ([], 10, 1),
    (made(50, 6) + made(50, 6)[:20] + [(None, ("a", "en", "s1"), "x y"), (7, ("a", None, "s2"), None)], 400, 2),
    ([(1, ("a", "en", "s1"), "long " * 100_000), (2, ("b", "en", "s1"), "short")], 50_000, 1),
])
def test_against_plain_loops(spark, rows, budget, epochs):
    df = spark.createDataFrame([(i, *path, text, 1, 2) for i, path, text in rows],
                               "doc_id long, domain string, lang string, source string, text string, tokens long, epoch int")
    got = mixing.mix(df, {n: F.col(n) for n in NAMES}, F.lit(budget), WEIGHTS, epochs, seed=5)
    assert got.columns == ["doc_id", *NAMES, "tokens", "epoch"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, budget, WEIGHTS, epochs, 5)


def test_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "1", 1000), ("b", "x", "1", 1000)],
                                   "domain string, lang string, source string, tokens long")
    got = {tuple(r[:3]): r.budget for r in mixing.budgets(leaves, NAMES, F.lit(800), {}).collect()}
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 190, ("a", "y", "1"): 200, ("b", "x", "1"): 400}


def test_query_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    df = QUERIES["op10_mixing"](spark, folder)
    assert compare.difference(df, compare.connect(folder), ORACLES["op10_mixing"]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
