"""The two consolidation rules on a stream of new raw rows.

Every micro-batch is reduced and written to its own folder, so a batch that runs again after a
failure replaces its own output and nothing else. The rule across batches is applied on read,
which keeps the cost of a batch in proportion to the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from limnospark.operators.choose import latest_per_key


def read_arrivals(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files below a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _per_batch(stream: DataFrame, root: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame]) -> DataStreamWriter:
    def write(batch: DataFrame, number: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{root}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def keep_distinct(stream: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Collect rows without full-row duplicates; read them with `distinct_table`."""
    return _per_batch(stream, root, checkpoint, lambda batch: batch.dropDuplicates())


def distinct_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(root).drop("batch").dropDuplicates()


def keep_latest(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], run: str, ties: Sequence[str] = ()
) -> DataStreamWriter:
    """Collect the latest run's row per key; read them with `latest_table`."""
    return _per_batch(stream, root, checkpoint, lambda batch: latest_per_key(batch, keys, run, ties))


def latest_table(spark: SparkSession, root: str, keys: Sequence[str], run: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key over all batches; an older run that arrives late does not win."""
    return latest_per_key(spark.read.option("mergeSchema", True).parquet(root).drop("batch"), keys, run, ties)
