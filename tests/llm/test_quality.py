import math
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from limnospark.llm import quality
from limnospark.llm.queries import QUERIES


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "The", "x!!", "é"]), max_size=30))
def test_features_have_length_one(words):
    places, values = quality.features(" ".join(words), 18)
    assert len(set(places.tolist())) == len(places)
    assert math.isclose(float(np.dot(values, values)), 1.0 if words else 0.0, abs_tol=1e-5)


def test_pairs_of_equal_words_share_a_place():
    one, two = (set(quality.features(t, 18)[0].tolist()) for t in ("one one one", "two two"))
    assert len(one & two) == 1


def test_learner_against_plain_loops():
    rows = [([0, 2], [0.6, 0.8], 1), ([1], [1.0], 0), ([0, 1], [0.8, 0.6], 0), ([2], [1.0], 1)] * 5
    leader = quality.Leader(2, constant=0.3, alpha=0.5, l1=0.01, l2=0.1)
    z, n = [0.0] * 4, [0.0] * 4

    def weight(i):
        if abs(z[i]) <= 0.01:
            return 0.0
        return -(z[i] - math.copysign(0.01, z[i])) / ((1 + math.sqrt(n[i])) / 0.5 + 0.1)

    for places, values, label in rows:
        leader.learn(np.array(places), np.array(values), label)
        w = [weight(i) for i in places]
        p = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(w, values)) + 0.3)))
        for i, x, wi in zip(places, values, w):
            g = (p - label) * x
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * wi
            n[i] += g * g
    assert np.allclose(leader.weights(), [weight(i) for i in range(4)])


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, 5.0), (None, "the end", None), (2, "", 1.0), (2, "", 1.0), (3, "long " * 100_000, 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    weights = quality.fit(docs, labels)
    got = quality.score_documents(docs, weights, "doc_id").collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    assert quality.score_documents(docs.limit(0), weights, "doc_id").count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    by = {r.doc_id: r.score for r in quality.score_documents(docs, quality.fit(docs, labels), "doc_id").collect()}
    assert by[3] < by[2] == by[1]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op6_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("doc_id", "predicted", "score", "quality").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.98
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert got.select(F.count("held_out")).first()[0] == got.count()


def test_many_rows_of_one_labelled_id_train_as_one(spark):
    docs = spark.range(5_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id") % 50).alias("text")).unionByName(
        spark.createDataFrame([(8, "other text")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    assert weights[-1] == 0.0  # the constant: one good and one bad document
