"""Token ids in Arrow files: fixed-size-list batches of equal-length sequences with masks.

A folder holds two Arrow IPC files for each range of documents. `sequences-N.arrow` has the ids of
the range one after another, cut into rows of `length` ids (`ids`: fixed-size list of uint16, or uint32 if the
vocabulary has more ids) with a mask (`mask`: fixed-size list of bool, false where the last row is filled up). `documents-N.arrow` says where
each document lies. Every batch but the last has the same number of rows, so row r is found by
dividing, and the lists are views of the file's own buffers: `TokenFile` maps any span of
ids without reading the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from limnospark.llm.encoding import encoder
from limnospark.llm.shared import documents, in_id_order, named, new_folder, open_folder, partitions, stored

BATCH_ROWS = 256
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(length: int, highest_id: int) -> pa.Schema:
    kind = pa.uint16() if highest_id < 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class _Writer:
    """Writes one range of documents; what it holds is one batch of sequences."""

    def __init__(self, system, folder: str, number: int, length: int, highest_id: int):
        self._system, self._folder, self._length = system, folder, length
        self._names = [f"sequences-{number:06d}.arrow", f"documents-{number:06d}.arrow"]
        self._drafts = [f"{folder}/.{name}-{uuid.uuid4().hex}" for name in self._names]
        self._sinks = [system.open_output_stream(draft) for draft in self._drafts]
        self._schema = sequence_schema(length, highest_id)
        self._kind = self._schema.field("ids").type.value_type.to_pandas_dtype()
        self._files = [pa.ipc.new_file(self._sinks[0], self._schema), pa.ipc.new_file(self._sinks[1], DOCUMENTS)]
        self._waiting: list[np.ndarray] = []
        self._held = self.tokens = self.documents = 0

    def add(self, doc_ids: list[int | None], all_ids: list[np.ndarray]) -> None:
        counts = np.array([len(ids) for ids in all_ids], np.int64)
        starts = self.tokens + np.cumsum(counts) - counts
        self._files[1].write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), starts, counts], schema=DOCUMENTS))
        self.documents += len(doc_ids)
        self.tokens += int(counts.sum())
        self._waiting += all_ids
        self._held += int(counts.sum())
        if self._held >= BATCH_ROWS * self._length:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        held = np.concatenate(self._waiting) if self._waiting else np.zeros(0, np.uint32)
        step = BATCH_ROWS * self._length
        for at in range(0, len(held) if last else len(held) - step + 1, step):
            self._write_rows(held[at : at + step])
        left = held[len(held) // step * step :]
        self._waiting, self._held = ([] if last else [left.copy()]), (0 if last else len(left))

    def _write_rows(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self._length)
        filled = np.zeros(rows * self._length, self._kind)
        filled[: len(ids)] = ids
        mask = np.arange(rows * self._length) < len(ids)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), self._length) for values in (filled, mask)]
        self._files[0].write_batch(pa.record_batch(lists, schema=self._schema))

    def close(self) -> list[str]:
        """Only whole files get their names, so a task that runs again replaces them by equal ones."""
        self._flush(last=True)
        for file, sink in zip(self._files, self._sinks):
            file.close()
            sink.close()
        for draft, name in zip(self._drafts, self._names):
            named(self._system, draft, f"{self._folder}/{name}")
        return self._names


def write_tokens(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 2) -> DataFrame:
    """Encode whole texts, end each with `end_id`, write them in doc_id order; one row for each pair of files.

    Columns: folder, part, documents, tokens, start (ids in all files before). The files lie in the
    shared folder. Null texts count as empty and so hold the end id alone; null doc_ids come first;
    rows that share an id are all kept, ordered by text. An empty table has no files.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer = encoder(vocabulary), None
        part = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                if writer is None:
                    writer = _Writer(*open_folder(folder), part, length, max(encode.size - 1, end_id))
                ids = [np.append(encode.encode(text.as_py()), np.uint32(end_id)) for text in rows["text"]]
                writer.add(rows["doc_id"].to_pylist(), ids)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "documents": [writer.documents], "tokens": [writer.tokens]})

    files = stored(in_id_order(documents(docs)).mapInArrow(write, "part long, documents long, tokens long"), "token-files")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one small row for each file
    return files.select(F.lit(folder).alias("folder"), "*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))


class TokenFile:
    """Random access to one file of sequences; local files are mapped and not read."""

    def __init__(self, folder: str, part: int):
        system, path = open_folder(folder)
        name = f"{path}/sequences-{part:06d}.arrow"
        source = pa.memory_map(name) if system.type_name == "local" else system.open_input_file(name)
        self._file = pa.ipc.open_file(source)
        self.length = self._file.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def sequences(self, batch: int) -> tuple[np.ndarray, pa.FixedSizeListArray]:
        """Ids of one batch, one row for each sequence, and their masks; both are views of the file."""
        if batch != self._at:
            self._at, self._batch = batch, self._file.get_batch(batch)
        return self._batch["ids"].flatten().to_numpy().reshape(-1, self.length), self._batch["mask"]

    def span(self, start: int, count: int) -> np.ndarray:
        """`count` ids from the `start`-th of the file on."""
        step, parts, end = BATCH_ROWS * self.length, [], start + count
        while start < end:
            batch, at = divmod(start, step)
            ids, _ = self.sequences(batch)
            parts.append(ids.reshape(-1)[at : at + end - start])
            start += len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint16), *parts])


def read_tokens(files: DataFrame) -> DataFrame:
    """Each document of the files: doc_id, start (ids of all documents before it), n_tokens, and
    `ids`, its ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = open_folder(row["folder"])
                tokens = TokenFile(row["folder"], row["part"])
                with system.open_input_file(f"{path}/documents-{row['part']:06d}.arrow") as source:
                    places = pa.ipc.open_file(source)
                    for i in range(places.num_record_batches):
                        at = places.get_batch(i)
                        spans = zip(at["start"].to_pylist(), at["n_tokens"].to_pylist())
                        ids = [tokens.span(start, count).astype("<u4").tobytes() for start, count in spans]
                        starts = at["start"].to_numpy() + row["start"]
                        yield pa.record_batch([at["doc_id"], pa.array(starts), at["n_tokens"], pa.array(ids, pa.binary())],
                                              names=["doc_id", "start", "n_tokens", "ids"])

    dealt = files.repartitionByRange(partitions(files.sparkSession), "part")
    return dealt.select("folder", "part", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
