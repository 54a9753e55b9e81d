"""Near-duplicate documents by SimHash fingerprints, linked through anchor points of a covering code.

Fingerprints that differ in at most t bits are found without comparing all pairs. The anchors are the words of a
code that covers the space: every 64-bit word has an anchor within the code's radius R. A fingerprint's home is
its nearest anchor; a fingerprint within t bits of another lies within R + t of the other's home. So each
fingerprint goes to its home and, as a copy, to every anchor within R + t, and homes are compared with copies at each
anchor: every link is met once, at the home of its smaller fingerprint.

The code joins four perfect codes: two binary Golay codes (23 bits, radius 3) and two repetition codes (9 bits, radius
4), 2^26 anchors and R = 14 in all. Perfect codes have one nearest word for every point, and distances
add up over the blocks, so a copy is only needed where the blocks' distances beyond their radii sum up to t or less:
71 copies on average for t = 2, whatever the corpus. Each anchor's part of the space, and with it the
number of homes at an anchor, is the same.

Equal fingerprints are merged before anything is compared, so a large group of copies counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from limnospark.llm.components import components
from limnospark.llm.shared import documents, release_memory, stored

SEED = 42
# Fixed value: the Golay code's generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011


def fingerprint(text: str, words: int = 3) -> int:
    """64 bits, each 1 if it is set in over half of the hashes of the text's shingles."""
    found = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII blanks part words
    if not found:
        return 0
    joined = b" ".join(found)
    after = list(accumulate(len(w) + 1 for w in found))
    width = min(words, len(found))
    starts = [0, *after]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, after[width - 1 :])), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and `fp` of each document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(text.as_py(), words) for text in batch["text"]], np.uint64)
            yield pa.record_batch([batch["doc_id"], values.view(np.int64)], names=["doc_id", "fp"])
        release_memory()

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


@dataclass
class Block:
    """A perfect linear code on some bits of the fingerprint.

    `columns` are the syndromes of the single bits. For each syndrome the table lists the differences to code words
    within `radius + reach` bits, nearest first; `within[s, d]` says how many of them are at most d beyond the radius.
    """

    at: int
    columns: list[int]
    radius: int
    reach: int

    def __post_init__(self) -> None:
        width = len(self.columns)
        rows = []
        for weight in range(self.radius + self.reach + 1):
            for bits in combinations(range(width), weight):
                syndrome = 0
                for b in bits:
                    syndrome ^= self.columns[b]
                rows.append((syndrome, max(0, weight - self.radius), sum(1 << b for b in bits)))
        rows.sort()
        syndromes, beyond, differences = (np.array(c, np.int64) for c in zip(*rows))
        self.mask = np.uint64((1 << width) - 1)
        self.beyond, self.differences = beyond, differences.astype(np.uint64)
        count = int(max(syndromes)) + 1
        self.start = np.searchsorted(syndromes, np.arange(count))
        self.within = np.array([[np.count_nonzero(part <= d) for d in range(self.reach + 1)]
                                for part in np.split(beyond, self.start[1:])])
        self.bytes = np.zeros((-(-width // 8), 256), np.int64)
        for i, column in enumerate(self.columns):
            byte, bit = divmod(i, 8)
            self.bytes[byte, np.flatnonzero(np.arange(256) >> bit & 1)] ^= column

    def syndromes(self, fps: np.ndarray) -> np.ndarray:
        own = fps >> np.uint64(self.at) & self.mask
        result = np.zeros(len(fps), np.int64)
        for i, table in enumerate(self.bytes):
            result ^= table[own >> np.uint64(8 * i) & np.uint64(255)]
        return result


@lru_cache
def blocks(reach: int) -> tuple[Block, ...]:
    golay, remainder = [], 1
    for _ in range(23):
        golay.append(remainder)
        remainder <<= 1
        remainder ^= GOLAY if remainder >> 11 else 0
    repeated = [1 << i for i in range(8)] + [255]
    return Block(0, golay, 3, reach), Block(23, golay, 3, reach), Block(46, repeated, 4, reach), Block(55, repeated, 4, reach)


def anchors(fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint (its index) the anchors at most `reach` beyond the blocks' radii; with 0, its home."""
    index, anchor, left = np.arange(len(fps)), fps.copy(), np.full(len(fps), reach)
    for block in blocks(reach):
        syndromes = block.syndromes(fps)[index]
        counts = block.within[syndromes, left]
        rows = np.repeat(np.arange(len(index)), counts)
        entry = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + block.start[syndromes][rows]
        index, left = index[rows], left[rows] - block.beyond[entry]
        anchor = anchor[rows] ^ block.differences[entry] << np.uint64(block.at)
    return index, anchor


def at_anchors(nodes: DataFrame, reach: int, name: str) -> DataFrame:
    """Rows (anchor, `name`) of each distinct fingerprint in the column fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                fps = batch["fp"].slice(at, 1024).to_numpy().view(np.uint64)
                index, anchor = anchors(fps, reach)
                yield pa.record_batch([anchor.view(np.int64), fps[index].view(np.int64)], names=["anchor", name])

    return nodes.select("fp").mapInArrow(run, f"anchor long, {name} long")


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(nodes: DataFrame, threshold: int = 2) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints, a < b, that differ in at most `threshold` bits, each once.

    A large anchor's rows can be dealt to several tasks, since the join needs no rows of an anchor together.
    Spark sizes what a function gives by what it is given, so that the copies, 71 for each fingerprint, count as one: without the hint
    they are broadcast as long as the fingerprints alone are few enough.
    """
    homes, copies = at_anchors(nodes, 0, "a"), at_anchors(nodes, threshold, "b")
    met = (F.col("home.anchor") == F.col("copy.anchor")) & (F.col("a") < F.col("b")) & (differing("a", "b") <= threshold)
    return homes.hint("merge").alias("home").join(copies.hint("merge").alias("copy"), met).select("a", "b")


def near_duplicates(docs: DataFrame, threshold: int = 2, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each document.

    component_id is the smallest doc_id that links reach, directly or by way of others. Texts without words (null
    and empty ones too) have fingerprint 0 and are linked like any other. Rows without a doc_id are kept and
    do not name a component unless all its rows lack one; repeated rows are kept. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "nodes")
    roots = components(stored(links(nodes, threshold), "links"))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stored(rooted, "rooted")
    smallest = stored(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "smallest")
    named = stored(rooted.join(smallest, "root").select("fp", "component_id"), "components")
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return prints.join(named, "fp").select("doc_id", text.alias("fingerprint"), "component_id")
