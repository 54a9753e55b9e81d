import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from limnospark.llm import token_files
from limnospark.llm.queries import QUERIES, VOCABULARY

SCHEMA = "doc_id long, text string, part string, ids string, start string"


def whole_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(text or "", add_special_tokens=False).ids, 2] for text in texts]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA)


ROWS = [(7, "one two. three"), (3, None), (None, "no id"), (5, ""), (3, "same id"), (9, "long words here " * 4000), (11, "end")]


@pytest.mark.parametrize("length", [1, 8, 1024])
def test_round_trip(spark, length):
    files = token_files.write_tokens(frame(spark, ROWS), VOCABULARY, length=length)
    got = sorted(token_files.read_tokens(files).collect(), key=lambda r: r.start)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    by_start = 0
    for row in got:
        assert row.start == by_start and row.n_tokens == len(row.ids) // 4
        by_start += row.n_tokens
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == sorted(whole_ids(t for _, t in ROWS))


def test_batches_are_views_with_masks(spark):
    files = token_files.write_tokens(frame(spark, ROWS), VOCABULARY, length=16).collect()
    for row in files:
        file = token_files.TokenFile(row.folder, row.part)
        seen = 0
        for batch in range(file._file.num_record_batches):
            ids, mask = file.sequences(batch)
            assert ids.shape == (len(mask), 16) and not ids.flags.owndata and ids.dtype == np.uint16
            seen += sum(mask.flatten().to_pylist())
        assert seen == row.tokens


def test_empty_table(spark):
    assert token_files.read_tokens(token_files.write_tokens(frame(spark, []), VOCABULARY)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op7_token_files"](spark, folder).collect()}
    start = 0
    for doc, ids in zip(docs, whole_ids(d.text for d in docs)):
        row = got[doc.doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(docs)


def test_texts_with_an_added_token(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "after")]
    fresh = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = [[*fresh.encode(text, add_special_tokens=False).ids, 2] for _, text in rows]
    got = sorted(token_files.read_tokens(token_files.write_tokens(frame(spark, rows), VOCABULARY)).collect(), key=lambda r: r.doc_id)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == expected
    assert [r.start for r in got] == [0, 5, 8]
