"""A training corpus from raw documents: five operators, one after another.

Each stage is given the documents that the one before has kept, and what it decides takes effect: rejected documents
go, repeated lines go, one document of each group of near-duplicates stays, the mix takes its part, and
what is left is packed. Columns beside those of documents are kept, under any names, up to the last stage; null texts count as
empty, rows without an id or with a shared one are judged one by one, and an empty table passes through as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.llm import lines, mixing, near_copies, packing, quality
from limnospark.llm.queries import MIX_SEED, MIX_WEIGHTS, VOCABULARY, held_out, mix_levels, table
from limnospark.llm.shared import stored

#: The mix takes nine tenths of the words that are left, each document once at most.
MIX_SHARE, MIX_EPOCHS = 0.9, 1
ORACLE_SQL = None  # no stage but the mix can be said in SQL


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, whatever their id."""
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), use=~held_out())
    return quality.accepted(docs, weights)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier one; those that lose all their words go."""
    return lines.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id: SimHash fingerprints within two bits, as `op1_simhash` links them,
    and an exact join for the near-copies that so few bits cannot reach (five-word Jaccard similarity of 0.8 or more). Documents without an
    id stay if their whole group has none."""
    return near_copies.without_near_copies(docs, words=5, similarity=0.8, bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The part of each source that the target weights ask for."""
    levels = {f"__{name}": column for name, column in mix_levels().items()}
    _, plan = mixing.plan_mix(docs, levels, F.floor(F.col("total") * MIX_SHARE), MIX_WEIGHTS, MIX_EPOCHS, seed=MIX_SEED)
    rows = docs.withColumns({name: F.coalesce(column.cast("string"), F.lit("")) for name, column in levels.items()})
    return mixing.take(rows, plan, list(levels), MIX_SEED, epoch="__epoch").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, and the sequences they stand in."""
    return packing.pack(docs, VOCABULARY)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good), ("line dedup", drop_lines), ("near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix), ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
