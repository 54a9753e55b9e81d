"""Packing documents into token sequences of bounded length, in document order.

Documents are taken in doc_id order as one stream of ids. Dynamic programming chooses where to cut it:
a cut at the end of a document costs nothing, at the end of a sentence little, elsewhere more, and a
sequence costs the ids that fill it up. Sequences are filled to `length`, unless their own length is a
power of two. With positions c and least costs f,

    f(k) = penalty(k) + min( min over c(k) - c(j) <= length of f(j) + length - (c(k) - c(j)),
                             min over c(k) - c(j) a power of two of f(j) ) + fixed cost

The first minimum is over f(j) + c(j) in a sliding window, which a queue with rising values gives in
constant time; the second looks at few places. A task solves `horizon` ids at a time, keeps the
sequences before the last few cuts, and goes on from there, so its memory is bounded.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from limnospark.llm.encoding import encoder
from limnospark.llm.shared import documents, in_id_order, release_memory

# Ids that a cut is worth: one sequence more, a cut inside a document, a cut inside a sentence.
SEQUENCE_COST, SENTENCE_COST, WORD_COST = 2.0, 8.0, 48.0
RESULT = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def cut_places(total: int, sentence_ends: np.ndarray, document_ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut may be, from 0 to `total`, and the penalty of each.

    Where no sentence ends for long, places inside it are added, so that every sequence can be filled.
    """
    known = np.union1d(np.concatenate([sentence_ends, document_ends]), [0, total])
    gaps = np.diff(known)
    step = max(1, length // 8)
    wide = np.flatnonzero(gaps > step)
    inside = [np.arange(known[i] + step, known[i + 1], step) for i in wide]
    places = np.union1d(known, np.concatenate([np.zeros(0, np.int64), *inside]))
    penalty = np.full(len(places), WORD_COST)
    penalty[np.isin(places, sentence_ends, assume_unique=False)] = SENTENCE_COST
    penalty[np.isin(places, document_ends)] = 0.0
    penalty[[0, -1]] = 0.0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """Indices of the chosen places, first and last included."""
    count, total = len(places), int(places[-1])
    index = np.full(total + 1, -1, np.int64)
    index[places] = np.arange(count)
    exact = [[] for _ in range(count)]  # the places a power of two before each
    size = 1
    while size <= length:
        later = np.flatnonzero(places >= size)
        earlier = index[places[later] - size]
        found = earlier >= 0
        for k, j in zip(later[found].tolist(), earlier[found].tolist()):
            exact[k].append(j)
        size *= 2
    at, costs = places.tolist(), (penalty + SEQUENCE_COST).tolist()
    best, back = [0.0] * count, [0] * count
    queue: deque[int] = deque()
    keys = [0.0] * count  # f(j) + c(j), rising along the queue
    for k in range(count):
        here = at[k]
        if k:
            while at[queue[0]] < here - length:
                queue.popleft()
            j = queue[0]
            least, chosen = keys[j] + length - here, j
            for j in exact[k]:
                if best[j] < least:
                    least, chosen = best[j], j
            best[k], back[k] = least + costs[k], chosen
        key = keys[k] = best[k] + here
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(k)
    cuts = [count - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return np.array(cuts[::-1])


class _Stream:
    """Ids of documents waiting to be packed. Positions are counted from the first id held."""

    def __init__(self, length: int, ends: np.ndarray, horizon: int, part: int):
        self._length, self._ends, self._horizon = length, ends, horizon
        self._docs: list[list] = []  # doc_id, its ids, ids of it that are packed
        self._held = 0
        self._sequence = part << 32

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._docs.append([doc_id, ids, 0])
        self._held += len(ids)
        if self._held >= self._horizon:
            yield self._pack(last=False)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._held:
            yield self._pack(last=True)

    def _pack(self, last: bool) -> pa.RecordBatch:
        held = np.concatenate([ids[done:] for _, ids, done in self._docs])
        sizes = np.array([len(ids) - done for _, ids, done in self._docs], np.int64)
        ends = np.cumsum(sizes)
        places, penalty = cut_places(len(held), np.flatnonzero(self._ends[held]) + 1, ends, self._length)
        chosen = places[best_cuts(places, penalty, self._length)]
        if not last:  # the end of what is held is no end of a document's stream: leave some sequences open
            chosen = chosen[: np.searchsorted(chosen, len(held) - 8 * self._length, side="right")]
        rows = self._pieces(held, ends - sizes, ends, chosen)
        self._drop(int(chosen[-1]), ends)
        return rows

    def _pieces(self, held, begins, ends, cuts) -> pa.RecordBatch:
        marks = np.union1d(cuts, begins[begins < cuts[-1]])
        left, right = marks[:-1], marks[1:]
        doc = np.searchsorted(ends, left, side="right")
        sequence = np.searchsorted(cuts, left, side="right") - 1
        already = np.array([done for _, _, done in self._docs], np.int64)
        tokens = np.array([len(ids) for _, ids, _ in self._docs], np.int64)
        names = [d[0] for d in self._docs]
        rows = pa.record_batch([
            pa.array([names[i] for i in doc], pa.int64()), left - begins[doc] + already[doc], right - left, tokens[doc],
            self._sequence + sequence, left - cuts[sequence],
            pa.array([held[a:b].tobytes() for a, b in zip(left.tolist(), right.tolist())], pa.binary()),
        ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        self._sequence += len(cuts) - 1
        return rows

    def _drop(self, upto: int, ends: np.ndarray) -> None:
        whole = int(np.searchsorted(ends, upto, side="right"))
        before = int(ends[whole - 1]) if whole else 0
        self._docs = self._docs[whole:]
        if self._docs:
            self._docs[0][2] += upto - before
        self._held -= upto


def pack(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0, horizon: int = 1 << 18) -> DataFrame:
    """One row for each piece of a document in a sequence; every id lies in one piece.

    doc_id, start (ids of the document before the piece), length, doc_tokens (the end id included),
    sequence_id, offset (in the sequence, without gaps), ids (little-endian unsigned 32-bit).
    Each range of doc_ids is packed by one task, which leaves at most one short sequence. Null and
    empty texts are the end id alone; null doc_ids come first; rows that share an id are separate
    documents; an empty table has no piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        ends = encode.ends_sentence()
        stream = _Stream(length, ends, max(horizon, 16 * length), TaskContext.get().partitionId())
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                for doc_id, text in zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()):
                    ids = np.append(encode.encode(text), np.uint32(end_id))
                    yield from stream.add(doc_id, ids)
        yield from stream.rest()
        release_memory()

    return in_id_order(documents(docs)).mapInArrow(run, RESULT)
