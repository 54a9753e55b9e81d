import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.append(os.path.join(os.path.dirname(__file__), "..", ".."))

import corpus_pipeline  # noqa: E402
import test_lines  # noqa: E402
import test_mixing  # noqa: E402
import test_near_copies as near  # noqa: E402
import test_packing  # noqa: E402
from __spark_entry__ import queries  # noqa: E402
from limnospark.llm import simhash  # noqa: E402
from limnospark.llm.queries import MIX_SEED, MIX_WEIGHTS, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as Parquet."""
    docs, result = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        result.append((docs, after))
        docs = after
    return result


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes and 0 < after.count() <= before.count()


def test_quality(spark, stages):
    before, after = stages[0]
    kept = {r.doc_id for r in QUERIES["op6_quality"](spark, FOLDER).where("predicted = 1").collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if i in kept}


def test_lines_of_what_is_left(stages):
    before, after = stages[1]
    rows = list(texts(before).items())
    gone = test_lines.brute(rows, 0.8)
    expected = {}
    for i, text in rows:
        lines = [line for n, line in enumerate(text.split("\n")) if not gone.get((i, n), False)]
        if any((i, n) in gone for n in range(text.count("\n") + 1)) and not any(test_lines.word_set(x) for x in lines):
            continue
        expected[i] = "\n".join(lines)
    assert texts(after) == expected
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_copies(stages):
    before, after = stages[2]
    rows = list(texts(before).items())
    assert sorted(texts(after).items()) == sorted(near.brute(rows)[1])


def test_near_copies_of_documents_of_many_lines(spark):
    """The stage on its own input: copies in which one line differs."""
    rows = []
    for i in range(40):
        lines = [[f"{'abc'[k % 3]}{i}x{j}y{k}" for k in range(12)] for j in range(20)]
        rows.append((i, "\n".join(map(" ".join, lines))))
        lines[i % 20][:6] = [f"new{i}n{k}" for k in range(6)]
        rows.append((100 + i, "\n".join(map(" ".join, lines))))
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))


def test_near_copies_by_fingerprint(spark):
    """What the SimHash operator links is one group, whatever its sets' similarity: repeats count there, and not in a set."""
    def text(i, j):
        return " ".join([f"a{i} b{i} c{i}"] * 100 + [f"own{i}x{j}y{k}" for k in range(30)])

    rows = [(10 * j + i, text(i, j)) for i in range(5) for j in range(3)] + [(100, " ".join(f"w{k}" for k in range(60)))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    linked = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(linked) == [0, 1, 2, 3, 4, 100]


CLASHING = {"score": 1.5, "predicted": "p", "whole": 2, "rest": None, "last": "z", "epoch": 3, "label": "l", "tokens": 7, "kept": "k", "line": 1, "size": 2, "id": 5}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_clashing_columns_nulls_and_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (3, "", "en", "src0", 0), (3, "", "en", "src0", 0), (None, "long words " * 30_000, "de", "src1", 1)], docs.schema)
    docs = docs.unionByName(odd).withColumns({n: F.lit(v).cast("string") if v is None else F.lit(v) for n, v in CLASHING.items()})
    plain = stage(spark, docs.drop(*CLASHING), FOLDER)
    got = stage(spark, docs, FOLDER)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.dtypes == docs.dtypes
        rows = got.collect()
        assert rows and all(r[n] == v for r in rows for n, v in CLASHING.items())
        assert sorted((str(r.doc_id), r.text) if r.text else (str(r.doc_id), "") for r in rows) == sorted(
            (str(r.doc_id), r.text) if r.text else (str(r.doc_id), "") for r in plain.collect())
    else:
        assert got.columns == plain.columns and got.count() == plain.count()
    assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_mix(stages):
    before, after = stages[3]

    def domain(source):
        return "web" if source == "src0" else "books" if int(source[3:]) % 2 == 0 else "news"

    rows = [(r.doc_id, (domain(r.source), r.lang, r.source), r.text) for r in before.collect()]
    total = sum(len(t.split()) for _, _, t in rows)
    chosen = test_mixing.brute(rows, int(total * corpus_pipeline.MIX_SHARE), MIX_WEIGHTS, 1, MIX_SEED)
    assert sorted(texts(after)) == sorted(row[0] for row in chosen)


def test_packing_of_the_rest(stages):
    before, after = stages[4]
    test_packing.check(after.collect(), list(texts(before).values()), 1024)


def test_whole_run(spark, stages):
    final = stages[4][1]
    got = queries()["pipeline"](spark, FOLDER)
    columns = ["doc_id", "start", "length", "doc_tokens"]
    assert got.select(columns).exceptAll(final.select(columns)).count() == 0 and got.agg(F.sum("length")).first() == final.agg(F.sum("length")).first()
