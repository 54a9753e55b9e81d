import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnospark.llm import toxicity
from limnospark.llm.queries import QUERIES

CALM = ["the river runs", "a stream runs slow", "Rain in the river", "rivers run", "some rain in a stream", "slow slow rain"]
RUDE = ["the idiot runs", "idiotic rain", "you idiots", "Idiot idiot in a stream"]


def brute(texts, order, shared):
    """Probabilities by plain recursion: (label, text) pairs in, a function of label, context and letter out."""
    top = {c: Counter() for c in ("all", 0, 1)}
    for label, text in texts:
        for word in set((text or "").lower().split()):
            s = f" {word} "
            for end in range(2, len(s) + 1):
                for c in {"all", label} - {None}:
                    top[c][s[max(0, end - order):end]] += 1
    levels = {}
    for c, grams in top.items():
        level = {order: Counter({g: n for g, n in grams.items() if len(g) == order})}
        for k in range(order - 1, 0, -1):
            level[k] = Counter({g: n for g, n in grams.items() if len(g) == k})
            for g in level[k + 1]:
                level[k][g[1:]] += 1
        levels[c] = level

    def p(c, gram):
        k = len(gram)
        if k == 0:
            return 1 / len(levels["all"][1])
        counts = levels["all" if k <= shared else c][k]
        n1, n2 = (sum(v == i for v in counts.values()) for i in (1, 2))
        d = min(n1 / (n1 + 2 * n2), 0.95) if n1 else 0.5
        inside = {g: v for g, v in counts.items() if g[:-1] == gram[:-1]}
        if not inside:
            return p(c, gram[1:])
        total = sum(inside.values())
        return max(inside.get(gram, 0) - d, 0) / total + d * len(inside) / total * p(c, gram[1:])

    return p


@pytest.mark.parametrize("order, shared", [(5, 2), (4, 1), (3, 2)])
def test_word_ratios_against_plain_recursion(spark, order, shared):
    texts = [(0, t) for t in CALM] + [(1, t) for t in RUDE] + [(None, "unlabelled idiot words about rivers"), (None, None)]
    docs = spark.createDataFrame([(t, label) for label, t in texts], "text string, label int").withColumn("text", F.coalesce("text", F.lit("")))
    models = toxicity.Models(order, shared)
    for r in toxicity.ratios(toxicity.count_grams(docs, order), order, shared).collect():
        (models.grams if r.is_gram else models.contexts)[r.key] = r.value
    p = brute(texts, order, shared)
    for word in ("river", "idiot", "idiots", "rain", "running", "about", "slowly", "io", "a", "sour"):
        s = f" {word} "
        want = sum(math.log(p(1, s[max(0, e - order):e]) / p(0, s[max(0, e - order):e])) for e in range(2, len(s) + 1))
        assert math.isclose(models.word(word), want, rel_tol=1e-9, abs_tol=1e-9), word
    assert models.word("idiot") > 1 > models.word("river")


def test_probabilities_of_a_context_sum_to_one():
    p = brute([(0, t) for t in CALM] + [(1, t) for t in RUDE], 4, 2)
    letters = set("".join(CALM + RUDE).lower()) | {" "}
    for context in (" id", "riv", "run", "in "[:2], "s"):
        assert sum(p(1, context + x) for x in letters) == pytest.approx(1, abs=0.02 if len(context) > 1 else 1e-9)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score double, label int, likeness string")


def test_odd_rows_and_no_labels(spark):
    docs = frame(spark, [(1, None, 5.0, 1, "x"), (None, "idiot", None, None, None), (2, "", 1.0, 1, ""), (2, "", 1.0, 1, ""), (3, "long " * 200_000 + "x" * 5000, 0.0, 1, "")])
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    models = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, models, "doc_id", "label").collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    assert toxicity.score_documents(docs.limit(0), models, "doc_id").count() == 0
    assert toxicity.fit(docs.limit(0), labels.limit(0)).grams == {}
    with pytest.raises(ValueError):
        toxicity.score_documents(docs, models, "score")


def test_small_corpus(spark):
    rng = np.random.default_rng(1)
    calm, rude = "river rain stream slow bank water gauge flow mud reed".split(), ["idi" + end for end in "ot ots otic o os ocy otly".split()]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = rng.choice(calm, 30).tolist()
        if toxic:
            words[3] = rng.choice(rude)
        rows.append((i, " ".join(words), None, None, None))
        if i < 400:
            labels.append((i, int(toxic)))
            labels.append((i, 0))
    docs = frame(spark, rows + [(None, rows[0][1], None, None, None), (601, "idiotward " + rows[1][1], None, None, None)])
    models = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    by = {r.doc_id: r for r in toxicity.score_documents(docs, models, "doc_id").collect()}
    assert all(by[i].predicted == (i % 6 == 0) for i in range(600))
    assert by[None].score == by[0].score and by[601].predicted == 1  # an ending that no labelled document has
    fewer = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), most=50)
    assert 0 < len(fewer.grams) + len(fewer.contexts) <= 50 < len(models.grams)


@pytest.mark.parametrize("order, shared, most", [(4, 2, 40), (5, 2, 10), (3, 2, 0)])
def test_grams_that_no_task_holds_are_looked_up(spark, order, shared, most):
    """With room for few grams the scores are those of all grams."""
    texts = [f"{a} {b}" for a, b in zip(CALM * 10, (RUDE * 15)[:60])] + ["", None, "unheard zzz \u00e9t\u00e9 idiotward", "x"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(None, texts[0], 7), (1, texts[1], 8)], "doc_id long, text string, score long").drop("score")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    whole = toxicity.fit(docs, labels, order=order, shared=shared)
    few = toxicity.fit(docs, labels, order=order, shared=shared, most=most)
    assert whole.table is None and few.table is not None and len(few.grams) + len(few.contexts) <= most
    assert math.isclose(few.slope, whole.slope, rel_tol=1e-6) and math.isclose(few.middle, whole.middle, rel_tol=1e-6, abs_tol=1e-9)
    want, got = (sorted(((str(r.doc_id), r.likeness, r.score, r.predicted) for r in toxicity.score_documents(docs, m, "doc_id").collect())) for m in (whole, few))
    assert len(got) == len(want) == len(texts) + 2
    for a, b in zip(want, got):
        assert a[0] == b[0] and a[1:3] == pytest.approx(b[1:3], rel=1e-6, abs=1e-9)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op12_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    # in this table only the toxic documents in English hold words that tell them
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(labels, "doc_id").join(lang, "doc_id").where("held_out").select("doc_id", "predicted", "score", "toxic", "lang").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    right = defaultdict(list)
    for r in rows:
        if r.lang == "en":
            right[r.toxic].append(r.predicted == r.toxic)
    assert np.mean(right[1]) > 0.85 and np.mean(right[0]) > 0.98 and len(right[1]) > 50
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_words_met_again_and_again_are_worked_out_once(monkeypatch):
    """Frequent words were once forgotten with the rare ones that had filled the memory."""
    monkeypatch.setattr(toxicity, "_REMEMBER", 8)
    worked = []

    class Counting(toxicity.Models):
        def word(self, word):
            worked.append(word)
            return float(len(word))

    values = toxicity._Words(Counting())
    for i in range(100):
        assert values["often"] == 5.0 and values[f"rare{i:03}"] == 7.0
    assert worked.count("often") == 1 and len(worked) == 101
    assert len(values) + len(values.older) <= 16
