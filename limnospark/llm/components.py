"""Connected components of a link table, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from limnospark.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node of its component.

    Every link is held as (high, low). A round points the larger neighbours of each node at its smallest
    neighbour, then does the same with its smaller neighbours; links shorten until every one leads to its root, after
    about as many rounds as the logarithm of the longest path. Rounds are joins and grouped minima, each written to the shared folder;
    a node with very many links is no single task's work, since minima are combined before they are
    dealt out and the join back can be split.
    """
    edges = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low").distinct()
    edges, before = stored(edges, "edges"), None
    while (state := _state(edges)) != before:
        before = state
        edges = stored(_small_star(stored(_large_star(edges), "edges")), "edges")
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Tells two edge tables apart; a few numbers, whatever their size."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(high, low))"), F.expr("bit_xor(xxhash64(low, high))")).first())


def _least(pairs: DataFrame) -> DataFrame:
    return stored(pairs.groupBy("node").agg(F.min("other").alias("least")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other")))
    larger = pairs.where("other > node").join(_least(pairs), "node")
    return larger.select(F.col("other").alias("high"), F.least("node", "least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    joined = pairs.join(_least(pairs), "node")
    moved = joined.select(F.explode(F.array(
        F.struct(F.col("node").alias("high"), F.col("least").alias("low")), F.struct(F.col("other").alias("high"), F.col("least").alias("low")))).alias("edge"))
    return moved.select("edge.*").where("high > low").distinct()
