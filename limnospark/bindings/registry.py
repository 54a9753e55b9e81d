"""Names of the queries, and helpers the bindings share."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries called {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a table out to the session's shuffle partitions, for costly work on each row."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round doubles for comparison; adding zero turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c), n) + F.lit(0.0) for c, n in digits.items()})


def rnd(expression: str, digits: int = 4) -> str:
    """SQL twin of `rounded`."""
    return f"(round({expression}, {digits}) + 0.0)"


def iso(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
