import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from limnospark.llm import filter_audit
from limnospark.llm.queries import QUERIES


def brute(docs, labels):
    """Apply the filters in every order, document by document."""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    facts = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copies = [o for o, t, _ in docs if (t or "") == text and o is not None]
        fails = "".join(letter for letter, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search("[#$%&*|]", text)), bool(copies) if doc_id is None else any(o < doc_id for o in copies))) if bad)
        facts.append((source or "", fails, doc_id in good, doc_id in toxic))
    rows, shapley = {}, Counter()
    for part in {f[0] for f in facts}:
        mine = [f for f in facts if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                failing = [f for f in mine if letter in f[1]]
                shapley[part, letter] += len(removed)
                rows[part, order, step] = [len(left), len(removed), len(failing) - len(removed), sum(f[1] == letter for f in failing),
                                           sum(f[2] for f in removed), sum(f[3] for f in removed)]
    return {key: (*values, shapley[key[0], key[1][key[2] - 1]]) for key, values in rows.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_paths_are_factorials():
    reach, leave = filter_audit.paths(5)
    size = [bin(s).count("1") for s in range(32)]
    fact = [1, 1, 2, 6, 24, 120]
    assert reach == [fact[s] for s in size] and leave == [fact[5 - s] for s in size]


def test_odd_rows_against_all_orders(spark):
    many = " ".join(f"word{i}" for i in range(60))
    docs = [
        (1, many, "x"), (2, many, "x"), (2, many, "x"), (None, many, None), (None, "only here", None), (None, "only here", "x"), (3, None, "y"), (4, "", "y"),
        (5, "SHOUT " * 70, "x"), (6, "a # b", ""), (6, "a # b", "y"), (6, "a | c", "x"), (7, many + " $", "x"), (8, many.upper() + " *", "y"),
        (9, " ".join(["no", "break"]) * 40, "y"), (10, "long " * 200_000, "z"), (0, many, "z"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, None, 1), (None, 1, 1), (6, 1, 1), (99, 1, 1), (8, 1, None)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, source string, part string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit_documents(frame, marks)
    want = brute(docs, labels)
    assert found(got) == want and got.count() == len(want) == 600 * 4
    assert filter_audit.audit_documents(frame.limit(0), marks).count() == 0
    assert {k[0] for k in found(filter_audit.audit_documents(frame, marks.limit(0)))} == {"", "x", "y", "z"}


def test_one_text_under_many_ids(spark):
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    marks = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    got = found(filter_audit.audit_documents(frame, marks))
    assert got["s0", "EABCD", 1] == (1, 6666, 0, 0, 0, 0, 60 * 6666) and got["s1", "EABCD", 1][:2] == (0, 6667)


def test_other_filters(spark):
    rows = spark.createDataFrame([("p", 1, 2), ("p", 5, None), (None, 7, 9)], "k string, a int, b int")
    got = filter_audit.audit(rows, {"x": F.col("a") > 4, "y": F.col("b") > 1}, {}, part="k").collect()
    by = {(r.part, r.filter_order, r.step): (r.filter, r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got}
    assert by == {
        ("p", "xy", 1): ("x", 1, 1, 0, 1, 2), ("p", "xy", 2): ("y", 0, 1, 0, 1, 2), ("p", "yx", 1): ("y", 1, 1, 0, 1, 2), ("p", "yx", 2): ("x", 0, 1, 0, 1, 2),
        ("", "xy", 1): ("x", 0, 1, 0, 0, 1), ("", "xy", 2): ("y", 0, 0, 1, 0, 1), ("", "yx", 1): ("y", 0, 1, 0, 0, 1), ("", "yx", 2): ("x", 0, 0, 1, 0, 1),
    }
    with pytest.raises(ValueError):
        filter_audit.audit(rows, {str(i): F.lit(True) for i in range(8)}, {}, part="k")


def test_query_against_all_orders(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert found(QUERIES["op13_filter_audit"](spark, folder)) == brute(docs, labels)
