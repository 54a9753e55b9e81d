"""Records by key in a set number of files, with an index of where each key's records stand.

A folder for each key makes as many files as there are keys. Here the keys are dealt out to a fixed number of buckets by their
hash, a bucket's rows to a few parts, and each part is written sorted by key as one file. The index says for each key and part
at which row its records begin and how many there are, so a reader opens the buckets of the keys it wants and no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKET, PART = "__bucket", "__part"
#: Stands for a null, so that empty texts stay what they are.
MISSING = "\\N"


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")), F.lit(buckets)).cast("int")


def write_keyed(records: DataFrame, path: str, key: str, buckets: int = 32, parts: int = 1, sep: str = ",", policy: str = "overwrite", missing: str = MISSING) -> DataFrame:
    """Write records as CSV below `path` in `buckets` * `parts` files at most; the result is the index, written next to them.

    Null cells are written as `missing`; as empty cells they are read back as nulls, and so are empty texts.

    `parts` above 1 spreads the records of a key, whose number may be anything, over so many tasks and files. Null keys have a bucket, too.
    Policy `fail_if_exists` refuses to write where something is.
    """
    if policy not in ("overwrite", "fail_if_exists"):
        raise ValueError(f"unknown write policy: {policy}")
    mode = "overwrite" if policy == "overwrite" else "errorifexists"
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in records.columns]
    placed = records.withColumn(BUCKET, bucket_of(key, buckets)).withColumn(PART, F.pmod(F.xxhash64(*texts), F.lit(parts)).cast("int"))
    order = [BUCKET, PART, F.col(f"`{key}`").cast("string").asc_nulls_first(), *[f"`{c}`" for c in records.columns if c != key]]
    dealt = placed.repartition(buckets * parts, BUCKET, PART).sortWithinPartitions(*order)
    dealt.write.mode(mode).option("header", True).option("sep", sep).option("nullValue", missing).partitionBy(BUCKET, PART).csv(f"{path}/records")
    counts = placed.groupBy(BUCKET, PART, F.col(f"`{key}`").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    # keys of one part only, which are counted already
    before = W.partitionBy(BUCKET, PART).orderBy(F.col("key").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    index = counts.withColumn("first_row", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    index.select("key", F.col(BUCKET).alias("bucket"), F.col(PART).alias("part"), "first_row", "rows").write.mode(mode).parquet(f"{path}/index")
    return records.sparkSession.read.parquet(f"{path}/index")


def read_keyed(spark: SparkSession, path: str, schema: StructType, key: str, keys: Sequence[str] | None = None, buckets: int = 32, sep: str = ",",
               missing: str = MISSING) -> DataFrame:
    """The records of the keys, or all; only the buckets of the keys are opened. `schema`, `buckets`, `sep` and `missing` are those of the write."""
    stored = StructType([*schema.fields, StructField(BUCKET, IntegerType()), StructField(PART, IntegerType())])
    df = spark.read.schema(stored).option("header", True).option("sep", sep).option("nullValue", missing).csv(f"{path}/records")
    if keys is not None:
        wanted = sorted({r.b for r in spark.createDataFrame([(k,) for k in keys], "k string").select(bucket_of("k", buckets).alias("b")).collect()})  # the keys asked for
        df = df.where(F.col(BUCKET).isin(*wanted) & F.col(key).cast("string").isin(*keys))
    return df.drop(BUCKET, PART)


def write_outputs(outputs: Mapping[str, DataFrame], root: str, keys: Mapping[str, str] | None = None, buckets: int = 32, sep: str = ",", policy: str = "overwrite") -> None:
    """Write the tables of an analysis, each under its name: those with a key in `keys` by key, the others as plain CSV folders."""
    for name, df in outputs.items():
        key = (keys or {}).get(name)
        if key:
            write_keyed(df, f"{root}/{name}", key, buckets, sep=sep, policy=policy)
        else:
            df.write.mode("overwrite" if policy == "overwrite" else "errorifexists").option("header", True).option("sep", sep).csv(f"{root}/{name}")


def read_output(spark: SparkSession, root: str, name: str, schema: StructType, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(f"{root}/{name}")
