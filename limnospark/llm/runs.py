"""Periodic runs of words, found with the dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, 8, ... words. Each gets a name, equal for equal stretches: a
word's number first, then the pair of the names of its two halves. A run with the smallest period q is found at the level of the
factors of L words with L / 2 < q <= L: a factor inside the run occurs again q words later and not before, since an earlier
successor would give the run a smaller period. Places whose successor lies within one window of twice the length, at the same
distance q, stand next to each other, and as an arithmetic progression they propose q; from the first place to the last, extended by the successor's
factor, reaches exactly the stretch that keeps period q. Smaller distances were proposed a level below and are left out.

Factors without a second occurrence in their text cannot become part of one that has, so they drop out, and a level works on
what is left. Documents are named together, a few million characters at a time, with names that hold within one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from limnospark.llm.shared import release_memory

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_CHUNK = 4 << 20


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in the whole array), length and period of all runs of the texts of `sizes` words that stand one after another.

    A run has the length `least` and `times` its period at least; `times` is 2 or more. Order: start, then period.
    """
    n, found = len(words), [np.empty((3, 0), np.int64)]
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    places, keys, length = np.arange(n), text * (int(words.max(initial=0)) + 1) + words, 1
    names = np.full(n, -1, np.int64)
    while len(places):
        order = np.argsort(keys, kind="stable")
        at, equal = places[order], np.diff(keys[order]) == 0
        distance = np.where(equal, np.diff(at), 0)
        near = (distance > length // 2) & (distance <= length)
        first, period = at[:-1][near], distance[near]
        by = np.argsort(first, kind="stable")
        first, period = first[by], period[by]
        new = np.ones(len(first), bool)
        new[1:] = (np.diff(first) != 1) | (np.diff(period) != 0)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(first))[:len(begin)] - 1
        start, q = first[begin], period[begin]
        reach = first[last] - start + q + length
        kept = reach >= np.maximum(least, times * q)
        found.append(np.stack([start[kept], reach[kept], q[kept]]))
        # the next level: places whose factor and whose neighbouring factor both occur again in texts with room for longer periods
        again = np.zeros(len(at), bool)
        again[:-1] |= equal
        again[1:] |= equal
        names.fill(-1)
        names[at[again]] = np.concatenate([[0], np.cumsum(~equal)])[again]
        places = np.sort(at[again])
        room = (places + 2 * length <= end[places]) & (times * (length + 1) <= sizes[text[places]])
        places = places[room]
        places = places[names[places + length] >= 0]
        keys = names[places] * (n + 1) + names[places + length]
        length *= 2
    start, reach, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, start))
    return start[order], reach[order], q[order]


def _chunks(texts: pa.Array) -> Iterator[list[bytes]]:
    """Texts in lists of a few million bytes, or a longer one alone."""
    held, size = [], 0
    for text in texts:
        value = text.as_buffer().to_pybytes() if text.is_valid else b""
        if held and size + len(value) > _CHUNK:
            yield held
            held, size = [], 0
        held.append(value)
        size += len(value)
    if held:
        yield held


def _scan(texts: list[bytes], least: int, times: int) -> pa.RecordBatch:
    parts = [text.split() for text in texts]  # bytes are split at space, tab, line feed, vertical tab, form feed, carriage return
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(word, len(number)) for words in parts for word in words), np.int64, int(sizes.sum()))
    start, length, period = runs_of(ids, sizes, least, times)
    dropped = np.zeros(len(ids) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    gone = np.cumsum(dropped)[:-1] > 0
    owner = np.searchsorted(ends, start, side="right")
    collapsed = []
    for i, words in enumerate(parts):
        mine = gone[ends[i] - sizes[i]:ends[i]]
        collapsed.append(b" ".join(words if not mine.any() else [words[k] for k in np.flatnonzero(~mine)]))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(parts)))]).astype(np.int32)
    begin = start - (ends - sizes)[owner]
    runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
        [pa.array(values, pa.int64()) for values in (begin, length, period)], names=["start", "length", "period"]))
    return pa.record_batch(
        [pa.array(sizes, pa.int64()), runs, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, *keep: str, least: int = 6, times: int = 4) -> DataFrame:
    """The columns `keep` of each row with `n_words`, `runs` and `collapsed`.

    `runs` has start (number of its first word, from 0), length and period of every run of whole words with `times` its smallest
    period and `least` words at least, by start, then period. `collapsed` is the text without the words that a run has after its first
    period, words joined by one space. Words end at ASCII white space and are compared as they are. Null and empty texts have no words, no runs
    and an empty `collapsed`; rows are judged one by one, so repeated rows and ids do not matter, and an empty table gives an empty
    one. A long text is one task's work in memory proportional to it. Columns named as the new ones cannot be kept.
    """
    taken = {"n_words", "runs", "collapsed"} & set(keep)
    if taken:
        raise ValueError(f"{sorted(taken)} are names of the result")
    given = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = StructType([*docs.select(*keep).schema.fields, *_parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string").fields])
    types = [StructField(f.name, f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, row = batch.select(list(keep)) if keep else None, 0
            for texts in _chunks(batch["__text"]):
                found = _scan(texts, least, times)
                columns = [*(kept.slice(row, len(texts)).columns if keep else ()), *found.columns]
                row += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in types])
        release_memory()

    return given.mapInArrow(run, schema)
