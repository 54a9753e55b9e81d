"""Quality scores by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader.

A document's features are its words and pairs of neighbouring words, hashed to `2**bits` places; pairs of one word
with itself share a place, so that texts repeating any word are alike. A feature that occurs c times counts
1 + log(c), and a document's features have length 1. Training
goes over a bounded sample of labelled documents in one task, row by row: for each feature i the learner keeps
the sum z(i) of its gradients, shifted, and n(i) of their squares, and

    w(i) = 0 where |z(i)| <= l1, else -(z(i) - sign(z(i)) l1) / ((beta + sqrt(n(i))) / alpha + l2).

The constant stays at the log-odds of the sample's labels, so that a text with hardly any known word scores like
the average document. Scores are sparse dot products with the weights, which have a fixed size and go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from limnospark.llm.shared import documents, release_memory, stored

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SAME = np.uint64(1)  # stands for every pair of equal words


class _Hashes(dict):
    """Hashes of words met so far, `remember` at most."""

    def __init__(self, remember: int = 100_000):
        super().__init__()
        self.remember = remember

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.remember:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (sorted, each once) and values of a text's n-grams."""
    words = text.encode().split()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    pairs = np.where(hashes[:-1] == hashes[1:], _SAME, (hashes[:-1] * _MIX) ^ (hashes[1:] + _MIX))
    shift = np.uint64(64 - bits)
    places, counts = np.unique((np.concatenate([hashes, pairs]) * _MIX >> shift).astype(np.int32), return_counts=True)
    values = 1 + np.log(counts)
    return places, (values / max(np.sqrt(np.dot(values, values)), 1e-9)).astype(np.float32)


@dataclass
class Leader:
    """Follow-the-regularised-leader for logistic loss with a fixed constant."""

    bits: int
    constant: float = 0.0
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.0

    def __post_init__(self) -> None:
        self.z = np.zeros(1 << self.bits)
        self.n = np.zeros(1 << self.bits)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w, n = self.weights(places), self.n[places]
        g = (logistic(np.dot(w, values) + self.constant) - label) * values
        squares = n + g * g
        self.z[places] += g - (np.sqrt(squares) - np.sqrt(n)) / self.alpha * w
        self.n[places] = squares


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def score(places: np.ndarray, values: np.ndarray, weights: np.ndarray) -> float:
    """The last weight is the constant."""
    return logistic(np.dot(weights[places], values) + weights[-1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", use: Column | None = None,
        sample: int = 8_192, bits: int = 18, passes: int = 2) -> np.ndarray:
    """Weights learnt from at most `sample` labelled documents, those whose ids hash lowest.

    `use` chooses label rows by their columns. Rows without an id or label are left out; of several labels of one id
    the largest holds, and of several rows of one id one is learnt from. Without any labelled document all weights are 0, so that every score is 0.5.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = (known if use is None else known.where(use)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col(label).cast("int")).alias("__label")
    )
    order = F.xxhash64(F.lit("sample"), "doc_id")
    chosen = known.withColumn("__order", order).orderBy("__order", "doc_id").limit(sample)
    # of rows that share a labelled id the one whose text hashes lowest is learnt from, so that the sample's bound holds
    hashed = documents(docs).withColumn("__hash", F.xxhash64("text")).join(F.broadcast(chosen), "doc_id")  # `sample` small rows at most
    texts = hashed.groupBy("doc_id", "__order", "__label").agg(F.min_by("text", "__hash").alias("text"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text.as_py(), bits) for text in batch["text"]]
            yield pa.record_batch([
                batch["__order"], batch["__label"], pa.array([p.tobytes() for p, _ in found], pa.binary()),
                pa.array([v.tobytes() for _, v in found], pa.binary()),
            ], names=["row", "label", "places", "values"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (label, np.frombuffer(places, np.int32), np.frombuffer(values, np.float32))
            for batch in batches for label, places, values in zip(*(batch[c].to_pylist() for c in ("label", "places", "values")))
        ]
        good = sum(label for label, _, _ in rows)
        leader = Leader(bits, constant=float(np.log((good + 1) / (len(rows) - good + 1))))
        for _ in range(passes):
            for label, places, values in rows:
                leader.learn(places, values, label)
        weights = np.append(leader.weights(), leader.constant).astype("<f4")
        yield pa.record_batch([pa.array([weights.tobytes()])], names=["weights"])

    ready = texts.mapInArrow(reduce, "row long, label int, places binary, values binary")
    ready = ready.repartition(1).sortWithinPartitions("row", "label", F.xxhash64("places"))
    model = stored(ready.mapInArrow(train, "weights binary"), "quality")
    found = model.first()  # 4 * (2 ** bits + 1) bytes
    return np.frombuffer(found.weights, "<f4") if found else np.zeros((1 << bits) + 1, np.float32)


def score_documents(docs: DataFrame, weights: np.ndarray, *keep: str, threshold: float = 0.7) -> DataFrame:
    """The columns `keep` of each document, `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Null and empty texts have no words and get the score of the constant. Repeated rows score alike. All
    rows are kept, and an empty table gives an empty one.
    """
    bits = int(len(weights) - 1).bit_length() - 1
    held = docs.sparkSession.sparkContext.broadcast(weights)  # as above, a fixed size
    given = docs.select(*keep, *(["text"] if "text" not in keep else []))
    kept = docs.select(*keep).schema.fields
    schema = StructType([*kept, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(*features(text.as_py() or "", bits), held.value) for text in batch["text"]]
            yield batch.select([field.name for field in kept]).append_column("score", pa.array(scores, pa.float64()))
        release_memory()

    return given.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """The documents whose score is `threshold` or more, with all their columns, whatever those are called.

    Null and empty texts are judged by the constant alone. Repeated rows stay or go together, and an empty table gives an empty one.
    """
    bits = int(len(weights) - 1).bit_length() - 1
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # few texts are held twice
                rows = batch.slice(at, 512)
                good = [score(*features(text.as_py() or "", bits), held.value) >= threshold for text in rows["text"]]
                yield rows.filter(pa.array(good, pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
