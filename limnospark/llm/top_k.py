"""Exact top-k by inner product over integer vectors, with a three-phase uniform threshold.

A vector's places are split into a few lists; a candidate's score for a query is the sum of its scores in
the lists. Work is dealt by list, block of queries and chunk of candidates.

1. Every list sends each chunk's k best entries for each query, and the list's lowest score. The entries
   found are scored exactly; the k-th best of them is a score that k candidates reach.
2. What that score is above the sum of the lists' lowest scores, divided by the number of lists, is the cutoff, the
   same above each list's lowest score. A candidate that reaches the score is at or above
   the cutoff in some list, so each list sends all its entries from there on.
3. Entries that cannot reach the score with what the lists that did not send them may add are dropped, the
   others get their remaining scores, and the k best are the result.

Entries travel packed, one row for each query, list and chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from limnospark.llm.shared import stored

QUERIES_AT_ONCE = 1_024
ENTRIES_AT_ONCE = 1 << 16
PACKED = "block int, chunk int, list int, query long, ids binary, scores binary, floor long"
PACKED_NAMES = [field.split()[0] for field in PACKED.split(", ")]


def top_k(queries: DataFrame, candidates: DataFrame, k: int, lists: int = 2, chunk_rows: int = 2_048, block_rows: int = 8_192) -> DataFrame:
    """query_id, id, score of the k best candidates for each query, ties by smaller id; all if there are fewer.

    Both inputs have `id` (long, each once) and `vector` (array of long, without nulls). Shorter vectors count
    as filled up with zeros. Scores are exact as long as they fit in 64 bits. Without queries or
    candidates the result is empty. No task holds more than a chunk, a block and the entries between them.
    """
    queries, candidates = stored(queries.select("id", "vector"), "queries"), stored(candidates.select("id", "vector"), "candidates")
    sizes = [df.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first() for df in (queries, candidates)]
    if not (sizes[0][0] and sizes[1][0]):
        return queries.select(F.col("id").alias("query_id"), "id", F.lit(0).cast("long").alias("score")).limit(0)
    blocks, chunks = -(-sizes[0][0] // block_rows), -(-sizes[1][0] // chunk_rows)
    width = max(1, sizes[0][1], sizes[1][1])
    dealt = stored(_deal(queries, candidates, blocks, chunks, lists, width), "dealt")

    sent = _in_units(dealt, _send_best(k))
    sent = stored(sent, "best")
    floors = sent.groupBy("query", "list").agg(F.min("floor").alias("floor"))
    unbounded = F.lit(None).cast("long").alias("least"), F.lit(None).cast("array<long>").alias("cutoffs")
    reached = _totals(dealt, sent.drop("floor").select("*", *unbounded), lists, k)
    best = W.partitionBy("query").orderBy(F.col("score").desc(), "id")
    kth = reached.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).groupBy("query").agg(
        F.count("*").alias("found"), F.min("score").alias("least"))
    base = floors.groupBy("query").agg(F.sum("floor").alias("base"))
    need = F.when(F.col("found") >= k, F.col("least") - F.col("base")).otherwise(F.lit(0).cast("long"))
    above = F.expr(f"(need + {lists - 1}) div {lists}")
    cutoffs = (
        floors.join(kth.join(base, "query").withColumn("need", need).drop("base", "found"), "query")
        .select("query", "list", F.when(F.col("need") > 0, F.col("least")).alias("least"), (F.col("floor") + above).alias("cutoff"))
    )
    cutoffs = stored(cutoffs.withColumn("block", _part("query", blocks)), "cutoffs")
    everywhere = cutoffs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    entries = dealt.groupBy("list", "block", "chunk").cogroup(everywhere.groupBy("list", "block", "chunk")).applyInArrow(_send_from_cutoff, PACKED)
    bounds = cutoffs.groupBy("query").agg(F.first("least").alias("least"), F.sort_array(F.collect_list(F.struct("list", "cutoff")))["cutoff"].alias("cutoffs"))
    entries = entries.drop("floor").join(bounds, "query")
    scored = _totals(dealt, entries, lists, k)
    return (
        scored.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k)
        .select(F.col("query").alias("query_id"), "id", "score")
    )


def _part(name: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(parts)).cast("int")


def _deal(queries: DataFrame, candidates: DataFrame, blocks: int, chunks: int, lists: int, width: int) -> DataFrame:
    """Slices of both for every unit of list, block and chunk that compares them."""
    queries = queries.withColumn("block", _part("id", blocks)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    candidates = candidates.withColumn("chunk", _part("id", chunks)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = queries.withColumn("is_query", F.lit(True)).unionByName(candidates.withColumn("is_query", F.lit(False)))
    full = F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector")))
    edges = [width * i // lists for i in range(lists + 1)]
    slices = F.array(*(F.slice("full", a + 1, b - a) for a, b in zip(edges, edges[1:])))
    return both.withColumn("full", full).select("block", "chunk", "is_query", "id", F.posexplode(slices).alias("list", "values"))


def _in_units(dealt: DataFrame, work) -> DataFrame:
    return dealt.groupBy("list", "block", "chunk").applyInArrow(work, PACKED)


def _slices(table: pa.Table, of_queries: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids in rising order and their slices, one row each."""
    part = table.filter(pc.equal(table["is_query"], of_queries)).combine_chunks()
    ids = part["id"].to_numpy()
    values = pc.list_flatten(part["values"]).to_numpy().astype(np.int64)
    order = np.argsort(ids)
    return ids[order], values.reshape(len(ids), -1)[order] if len(ids) else np.zeros((0, 0), np.int64)


def _numbers(left: np.ndarray, right: np.ndarray) -> type:
    """The fastest kind of number that holds every sum of products exactly."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    return np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else np.int64


def _unit(table: pa.Table) -> tuple[int, int, int]:
    return tuple(table[name][0].as_py() for name in ("block", "chunk", "list"))


def _packed(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32()] * 3 + [pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=PACKED_NAMES)


def _scores(table: pa.Table):
    """Queries, candidates and all their scores in one list, a strip of queries at a time."""
    (asked, q), (ids, c) = _slices(table, True), _slices(table, False)
    if len(ids) and len(asked):
        kind = _numbers(q, c)
        q, c = q.astype(kind), c.astype(kind).T
        for at in range(0, len(asked), QUERIES_AT_ONCE):
            yield asked[at : at + QUERIES_AT_ONCE], ids, q[at : at + QUERIES_AT_ONCE] @ c


def _send_best(k: int):
    def work(table: pa.Table) -> pa.Table:
        rows = []
        for asked, ids, scores in _scores(table):
            few = min(k, len(ids))
            take = np.argpartition(scores, len(ids) - few, axis=1)[:, len(ids) - few :]
            best, floors = np.take_along_axis(scores, take, 1).astype(np.int64), scores.min(axis=1)
            for i, query in enumerate(asked.tolist()):
                rows.append((*_unit(table), query, ids[take[i]].tobytes(), best[i].tobytes(), int(floors[i])))
        return _packed(rows)

    return work


def _send_from_cutoff(table: pa.Table, cutoffs: pa.Table) -> pa.Table:
    rows = []
    cutoff = dict(zip(cutoffs["query"].to_pylist(), cutoffs["cutoff"].to_pylist()))
    for asked, ids, scores in _scores(table) if table.num_rows and cutoffs.num_rows else ():
        least = np.array([cutoff[query] for query in asked.tolist()])
        row, place = np.nonzero(scores >= least[:, None])
        found, sent = ids[place], scores[row, place].astype(np.int64)
        ends = np.searchsorted(row, np.arange(len(asked) + 1)).tolist()
        for query, a, b in zip(asked.tolist(), ends, ends[1:]):
            if a < b:
                rows.append((*_unit(table), query, found[a:b].tobytes(), sent[a:b].tobytes(), None))
    return _packed(rows)


def _found(columns: list[np.ndarray]) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "id", "score"])


def _totals(dealt: DataFrame, entries: DataFrame, lists: int, k: int) -> DataFrame:
    """(query, id, score) of the k best entries of each query and chunk that reach `least`, if it is set."""

    def work(table: pa.Table, entries: pa.Table) -> pa.Table:
        if not (table.num_rows and entries.num_rows):
            return _found([np.zeros(0, np.int64)] * 3)
        parts = [table.filter(pc.equal(table["list"], j)) for j in range(lists)]
        of_queries, of_candidates = ([_slices(part, flag) for part in parts] for flag in (True, False))
        ids, asked = of_candidates[0][0], of_queries[0][0]
        rows = entries.combine_chunks()
        q = np.searchsorted(asked, rows["query"].to_numpy())
        counts = pc.binary_length(rows["ids"]).to_numpy() // 8
        place = np.searchsorted(ids, np.frombuffer(b"".join(rows["ids"].to_pylist()), np.int64))
        pair, at = np.unique(np.repeat(q, counts) * len(ids) + place, return_inverse=True)
        in_list = np.repeat(rows["list"].to_numpy(), counts)
        scores, sent = np.zeros((lists, len(pair)), np.int64), np.zeros((lists, len(pair)), bool)
        scores[in_list, at] = np.frombuffer(b"".join(rows["scores"].to_pylist()), np.int64)
        sent[in_list, at] = True
        q_of, c_of = np.divmod(pair, len(ids))
        least = np.full(len(asked), np.iinfo(np.int64).min)
        bounded = np.flatnonzero(rows["least"].is_valid().to_numpy(zero_copy_only=False))
        if len(bounded):  # a list that did not send an entry adds less than its cutoff
            kept = rows.take(pa.array(bounded))
            least[q[bounded]] = kept["least"].to_numpy()
            most = np.zeros((len(asked), lists), np.int64)
            most[q[bounded]] = pc.list_flatten(kept["cutoffs"]).to_numpy().reshape(-1, lists) - 1
            limits = np.where(sent, scores, most[q_of].T).sum(axis=0)
            can = (limits >= least[q_of]) | (least[q_of] == np.iinfo(np.int64).min)
            q_of, c_of, scores, sent = q_of[can], c_of[can], scores[:, can], sent[:, can]
        for j in range(lists):
            left, right = of_queries[j][1], of_candidates[j][1]
            kind = _numbers(left, right)
            left, right, open_ = left.astype(kind), right.astype(kind), np.flatnonzero(~sent[j])
            for start in range(0, len(open_), ENTRIES_AT_ONCE):
                own = open_[start : start + ENTRIES_AT_ONCE]
                scores[j, own] = np.einsum("ij,ij->i", left[q_of[own]], right[c_of[own]])
        total = scores.sum(axis=0)
        reach = total >= least[q_of]
        q_of, c_of, total = q_of[reach], c_of[reach], total[reach]
        order = np.lexsort((c_of, -total, q_of))  # candidates are in the order of their ids
        sorted_q = q_of[order]
        first = order[np.arange(len(order)) - np.searchsorted(sorted_q, sorted_q) < k]
        return _found([asked[q_of[first]], ids[c_of[first]], total[first]])

    return dealt.groupBy("block", "chunk").cogroup(entries.groupBy("block", "chunk")).applyInArrow(work, "query long, id long, score long")


def scaled(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component x as a double; null for a vector that is null, holds a null, a component that
    is not finite, or one whose value does not fit in 64 bits."""
    def whole_of(x: Column) -> Column:
        product = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(product) < 2.0**63, F.floor(product))  # false for a component that is no number

    whole = F.transform(vector, whole_of)
    return F.when(~F.exists(whole, lambda x: x.isNull()), whole)


def nearest(vectors: DataFrame, k: int, is_query: Column) -> DataFrame:
    """query_id, rank, id, score: the k best other rows for each row that `is_query` (on `id`) chooses.

    `vectors` has `id` and `vector` as `scaled` gives it; rows without either take no part. Rows that repeat an
    id count once, and if their vectors differ the smallest holds. Equal vectors are searched once: of
    each, the k + 1 smallest ids are enough for any query, since ties go by id.
    """
    rows = vectors.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    rows = stored(rows, "vectors")
    in_class = W.partitionBy("vector").orderBy("id")
    few = rows.withColumn("at", F.row_number().over(in_class)).where(F.col("at") <= k + 1)
    classes = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = stored(classes.select(F.col("ids")[0].alias("id"), "vector", "ids"), "classes")
    asked = rows.where(is_query).join(classes.select(F.col("id").alias("class"), "vector"), "vector")
    asked = stored(asked.select(F.col("id").alias("query_id"), "class"), "asked")
    wanted = asked.select(F.col("class").alias("id")).distinct().join(classes.select("id", "vector"), "id")
    found = top_k(wanted, classes.select("id", "vector"), k + 1).withColumnRenamed("query_id", "class")
    found = found.join(classes.select("id", "ids"), "id").select("class", "score", F.explode("ids").alias("id"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (
        asked.join(stored(found, "found"), "class").where("id <> query_id")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
    )
