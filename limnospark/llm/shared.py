"""What the operators share: the cluster's folder, written tables, and clean input columns."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from limnospark.session import shared_folder, written as stored

__all__ = ["NO_ID", "documents", "in_id_order", "named", "new_folder", "open_folder", "partitions", "release_memory", "stored", "text_of"]

# Stands for a missing doc_id where rows are dealt out by it: the smallest long.
NO_ID = -(1 << 63)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/limnospark-{label}-{uuid.uuid4().hex}"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder and the path in it, as seen from any task."""
    return fs.FileSystem.from_uri(folder)


def named(system: fs.FileSystem, draft: str, name: str) -> None:
    """Give a finished file its name; one that an earlier try of the task has left is replaced."""
    try:
        system.move(draft, name)
    except OSError:  # not every file system moves onto a file
        system.delete_file(name)
        system.move(draft, name)


def documents(df: DataFrame, *more: str) -> DataFrame:
    """`doc_id` as long, `text` with null as empty, and the columns named; other columns do not matter."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"), *more)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task: Python workers live on and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions, which the cluster sets for the size of its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_id_order(docs: DataFrame) -> DataFrame:
    """Partitions that hold consecutive ranges of doc_id, each sorted; equal ids are ordered by text.

    Rows of one id may be many, so a hash of the text takes part in the ranges.
    """
    keyed = docs.withColumn("__tie", F.xxhash64("text"))
    return (
        keyed.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first(), "__tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "__tie", "text")
        .drop("__tie")
    )
