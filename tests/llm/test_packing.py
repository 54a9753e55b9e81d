import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from limnospark.llm import packing
from limnospark.llm.queries import QUERIES, VOCABULARY
from test_token_files import ROWS, frame, whole_ids


def cost(places, penalty, cuts, length):
    total = 0.0
    for a, b in zip(cuts, cuts[1:]):
        size = places[b] - places[a]
        assert 0 < size <= length
        total += penalty[b] + packing.SEQUENCE_COST + (0 if size & (size - 1) == 0 else length - size)
    return total


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=40), st.integers(0, 2**32), st.integers(3, 40))
def test_cuts_cost_least(gaps, seed, length):
    ends = np.cumsum(gaps)
    random = np.random.default_rng(seed)
    sentence = ends[random.random(len(ends)) < 0.6]
    places, penalty = packing.cut_places(int(ends[-1]), sentence, ends[random.random(len(ends)) < 0.3], length)

    @lru_cache(None)
    def least(k):
        if not k:
            return 0.0
        options = []
        for j in range(k):
            size = int(places[k] - places[j])
            if size <= length:
                options.append(least(j) + (0 if size & (size - 1) == 0 else length - size))
        return min(options) + penalty[k] + packing.SEQUENCE_COST

    cuts = packing.best_cuts(places, penalty, length)
    assert cost(places, penalty, cuts, length) == pytest.approx(least(len(places) - 1))


def check(rows, texts, length):
    """Every id in one piece, sequences without gaps and not too long; returns the share of padding."""
    ids = [[*x[:-1], 0] for x in whole_ids(texts)]
    sequences, of_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        of_doc[r.doc_id].append(r)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
        total += at
    assert total == sum(map(len, ids))
    return of_doc, ids, padding / total


@pytest.mark.parametrize("length", [8, 64, 1024])
def test_every_id_lies_in_one_piece(spark, length):
    rows = [r for r in ROWS if r[0] != 3] + [(3, "only once")]
    of_doc, ids, _ = check(packing.pack(frame(spark, rows), VOCABULARY, length, horizon=1).collect(), [t for _, t in rows], length)
    for (doc_id, _), whole in zip(rows, ids):
        pieces = sorted(of_doc[doc_id], key=lambda r: r.start)
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == whole
        assert {r.doc_tokens for r in pieces} == {len(whole)}


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), VOCABULARY).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = QUERIES["op5_packing"](spark, folder).collect()
    of_doc, ids, padding = check(rows, [d.text for d in docs], 1024)
    assert padding < 0.03
    for doc, whole in zip(docs, ids):
        for r in of_doc[doc.doc_id]:
            assert r.ids_crc32 == zlib.crc32(np.array(whole[r.start : r.start + r.length], "<u4").tobytes())
