"""Near-copies by the Jaccard similarity of their sets of five-word shingles: an exact set-similarity join and its components.

Fingerprints of 64 bits cannot find these pairs: at similarity 0.8 two of them differ in about ten bits, more than any covering
reaches. The prefix filter of the line operator (see `lines`) finds all: shingles are put in one order, the rarest first by
counts in a table of fixed size, and two sets that match share a shingle among the first n - ceil(t n) + 1 of each.

Equal sets are merged first. Then the sets with a shingle in their prefix are compared with one of them, its leader, and
linked. Only sets that this leaves in another component than their leader are compared with all others of the shingle, so a
large group of near-copies is not compared in the square of its size; pairs within one component need no comparison. Every
other pair that may match is verified, on the 64-bit hashes of all its shingles.

Links of SimHash fingerprints (see `simhash`) can be taken in from the start: their sets are in one component without any comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from limnospark.llm import lines, simhash
from limnospark.llm.components import components
from limnospark.llm.shared import documents, stored

_MIX = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xBF58476D1CE4E5B9)


def _shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles, rising: which text, and two hashes. A text of fewer words is one shingle."""
    owner, codes, distinct = lines._words(texts)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    both = lines._hashed(distinct)[:, codes]
    sums = np.zeros_like(both)
    weight = np.ones(1, np.uint64)
    for j in range(min(words, len(owner))):
        same = owner[j:] == owner[: len(owner) - j]
        sums[:, : len(owner) - j] += np.where(same, both[:, j:] * weight, np.uint64(0))
        weight = weight * _MIX
    starts = np.concatenate([[True], owner[1:] != owner[:-1]])
    if len(owner) >= words:
        starts[: len(owner) - words + 1] |= owner[words - 1 :] == owner[: len(owner) - words + 1]
    owner, sums = owner[starts], (sums[:, starts] ^ sums[:, starts] >> np.uint64(32)) * _OTHER
    first, second = sums ^ sums >> np.uint64(29)
    order = np.lexsort((first, owner))
    owner, first, second = owner[order], first[order], second[order]
    kept = np.concatenate([[True], (owner[1:] != owner[:-1]) | (first[1:] != first[:-1])])
    return owner[kept], first[kept], second[kept]


def _keys(owner: np.ndarray, first: np.ndarray, second: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 bits that stand for each text's set, and its size; a text without words has zeros."""
    sizes = np.bincount(owner, minlength=rows)
    k1, k2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    if len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        k1[owner[starts]] = np.add.reduceat(first * _MIX, starts)
        k2[owner[starts]] = np.add.reduceat((second ^ second >> np.uint64(31)) * _OTHER, starts)
    return k1.view(np.int64), k2.view(np.int64), sizes


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """Texts that hold a shingle, by the low bits of its hash."""
    size = 1 << lines.COUNT_BITS
    return lines.counts_of(docs, lambda batch: np.bincount(lines._counted_at(_shingles(batch["text"], words)[1]), minlength=size))


def _sets(docs: DataFrame, counts: np.ndarray, words: int, similarity: float, printed: bool) -> DataFrame:
    """doc_id of each document, its set's key and size, the set's prefix, and the text's SimHash fingerprint (null if not `printed`)."""
    held = docs.sparkSession.sparkContext.broadcast(counts)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lines._slices(batches):
            owner, first, second = _shingles(batch["text"], words)
            k1, k2, sizes = _keys(owner, first, second, batch.num_rows)
            order = np.lexsort((first, held.value[lines._counted_at(first)], owner))
            lengths = np.where(sizes > 0, lines.prefix_length(sizes, similarity), 0)
            position = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            prefix = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()),
                pa.array(first[order][position < np.repeat(lengths, sizes)].view(np.int64)))
            fps = pa.nulls(batch.num_rows, pa.int64())
            if printed:
                fps = pa.array(np.array([simhash.fingerprint(text.as_py()) for text in batch["text"]], np.uint64).view(np.int64))
            yield pa.record_batch([batch["doc_id"], pa.array(k1), pa.array(k2), pa.array(sizes, pa.int32()), prefix, fps],
                                  names=["doc_id", "k1", "k2", "size", "prefix", "fp"])

    return docs.mapInArrow(run, "doc_id long, k1 long, k2 long, size int, prefix array<long>, fp long")


def _may_match(a: str, b: str, similarity: float) -> Column:
    """By the sizes of two sets and the places of a shared shingle; `a` and `b` start the columns' names."""
    both, share = F.col(f"{a}size") + F.col(f"{b}size"), similarity / (1 + similarity)
    return (F.least(f"{a}size", f"{b}size") >= F.greatest(f"{a}size", f"{b}size") * F.lit(similarity) - 1e-9) & (
        F.least(F.col(f"{a}size") - F.col(f"{a}at"), F.col(f"{b}size") - F.col(f"{b}at")) >= both * F.lit(share) - 1e-9)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is high enough, read from the documents again."""
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    asked = stored(nodes.select("node", "k1", "k2").join(asked, "node"), "asked")
    held = docs.sparkSession.sparkContext.broadcast(lines._filter_of(asked.select(F.col("k1").alias("doc"), F.lit(0).alias("line"))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lines._slices(batches):
            owner, first, second = _shingles(batch["text"], words)
            k1, k2, sizes = _keys(owner, first, second, batch.num_rows)
            ends = np.cumsum(sizes)
            kept = np.flatnonzero(held.value[lines._marks(k1, np.zeros(len(k1), np.int64))] & (sizes > 0))
            if len(kept):
                sets = [first[ends[i] - sizes[i] : ends[i]].tobytes() for i in kept.tolist()]
                yield pa.record_batch([pa.array(k1[kept]), pa.array(k2[kept]), pa.array(sets, pa.binary())], names=["k1", "k2", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, other in zip(batch["one"], batch["other"]):
                one, other = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, other))
                shared = len(np.intersect1d(one, other, assume_unique=True))
                good.append(shared >= similarity * (len(one) + len(other) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    found = docs.mapInArrow(read, "k1 long, k2 long, shingles binary").join(asked, ["k1", "k2"])
    found = stored(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")
    one, other = (found.select(F.col("node").alias(n), F.col("shingles").alias(s)) for n, s in (("a", "one"), ("b", "other")))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(compare, "a long, b long")


def _rooted(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    named = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(named, node, "left").withColumn(root, F.coalesce(root, node))


def _print_links(nodes: DataFrame, bits: int) -> DataFrame:
    """Pairs (a, b) of nodes: those of one fingerprint with the first of them, and the first ones of fingerprints that differ in `bits` or fewer."""
    prints = stored(nodes.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    same = nodes.join(prints, "fp").where("node > first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    a, b = (prints.select(F.col("fp").alias(n), F.col("first").alias(f"{n}_node")) for n in "ab")
    near = stored(simhash.links(prints, bits), "print-links").join(a, "a").join(b, "b")
    return same.unionByName(near.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def _links(docs: DataFrame, nodes: DataFrame, words: int, similarity: float, bits: int | None) -> DataFrame:
    """(node, root) of the sets that match another one, directly or by way of others."""
    entries = nodes.select("node", "size", F.posexplode("prefix").alias("at", "word"))
    first = entries.groupBy("word").agg(F.min(F.struct("node", "size", "at")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    first = first.select("word", *(F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("node", "size", "at")))
    shared = stored(entries.join(first, "word"), "shared")
    led = shared.where("node > lead_node").where(_may_match("lead_", "", similarity))
    led = stored(led.select(F.col("lead_node").alias("a"), F.col("node").alias("b")).distinct(), "led")
    links = _verified(docs, nodes, led, words, similarity)
    links = stored(links if bits is None else links.unionByName(_print_links(nodes, bits)), "links")
    roots = stored(components(links), "roots")
    rooted = stored(_rooted(_rooted(shared, roots, "node", "root"), roots, "lead_node", "lead_root"), "rooted")
    rooted = rooted.withColumn("open", F.col("root") != F.col("lead_root")).drop("lead_node", "lead_size", "lead_at", "lead_root")
    a, b = (rooted.select("word", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "size", "at", "root", "open"))) for side in "ab")
    met = (F.col("a_root") != F.col("b_root")) & (~F.col("a_open") | (F.col("a_node") < F.col("b_node"))) & _may_match("a_", "b_", similarity)
    # sorted words take little room in a file, so their size there does not tell whether they can be broadcast
    others = a.hint("merge").join(b.where("b_open").withColumnRenamed("word", "b_word").hint("merge"), (F.col("word") == F.col("b_word")) & met)
    others = others.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()
    others = stored(others.join(led, ["a", "b"], "left_anti"), "others")
    more = stored(_verified(docs, nodes, others, words, similarity), "links")
    return roots if more.isEmpty() else stored(components(links.unionByName(more)), "roots")


def without_near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, bits: int | None = None) -> DataFrame:
    """The documents with the smallest doc_id of their group; other columns as they are.

    A group is what links between documents reach whose sets of shingles (of `words` words in lower case A-Z between
    ASCII blanks; a shorter text is one shingle) have a Jaccard similarity of `similarity` or more, or, with `bits`, whose SimHash fingerprints
    (three words, see `simhash`) differ in that many bits or fewer. Texts without words are one
    group. Documents without an id stay if their whole group has none; a row is judged by its own text, so that of rows with the
    same or no id each can stay or go. An empty table gives no rows.
    """
    texts = documents(docs)
    sets = _sets(texts, shingle_counts(texts, words), words, similarity, bits is not None)
    nodes = sets.groupBy("k1", "k2", "fp").agg(F.min("doc_id").alias("smallest"), F.first("size").alias("size"), F.first("prefix").alias("prefix"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = _links(texts, nodes, words, similarity, bits)
    rooted = stored(_rooted(nodes.select("node", "k1", "k2", "smallest"), roots, "node", "root"), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("least"))
    kept = rooted.join(smallest, "root").where(F.col("smallest").eqNullSafe(F.col("least")))
    kept = stored(kept.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("least").alias("__least")), "kept")
    keyed = _keyed(docs, words)
    # dealt out by id at every size: a broadcast of the ids would end at some size and change the plan
    same = keyed["__key1"].eqNullSafe(kept["__k1"]) & keyed["__key2"].eqNullSafe(kept["__k2"]) & F.col("doc_id").cast("long").eqNullSafe(kept["__least"])
    return keyed.join(kept.hint("merge"), same, "left_semi").select(*docs.columns)


def _keyed(docs: DataFrame, words: int) -> DataFrame:
    """The documents with their sets' keys as __key1 and __key2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            only = pa.record_batch([batch["__text"]], names=["text"])
            for part in lines._slices(iter([only])):
                parts.append(_keys(*_shingles(part["text"], words), part.num_rows)[:2])
            keys = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1)]
            rows = batch.drop_columns(["__text"])
            yield rows.append_column("__key1", pa.array(keys[0])).append_column("__key2", pa.array(keys[1]))

    kind = docs.select("*", F.lit(0).cast("long").alias("__key1"), F.lit(0).cast("long").alias("__key2")).schema
    return docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, kind)
