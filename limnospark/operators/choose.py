"""Pick one row or one value per group.

`row_number() == 1` plans as a window group limit: every map task keeps one row per key
before the exchange, so a hot key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from limnospark.operators.groups import null_safe_join

UNLISTED_SOURCE = 10_000
UNLISTED_INSTRUMENT = 999


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group in a full order."""
    spec = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(spec)).where("__rn = 1").drop("__rn")


def rank_of(column: Column, ranking: Sequence[str], unlisted: int) -> Column:
    """Place of a value in a ranking list."""
    if not ranking:
        return F.lit(unlisted)
    pairs = [F.lit(part) for i, name in enumerate(ranking) for part in (name, str(i))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column).cast("int"), F.lit(unlisted))


def latest_per_key(df: DataFrame, keys: Sequence[str], run: str, ties: Sequence[str] = ()) -> DataFrame:
    """Rows of the latest run for each key; later ties win."""
    order = [F.col(run).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]]
    return first_row(df, keys, order)


def latest_runs(runs: DataFrame, pipeline: str = "pipeline", run: str = "run_id") -> DataFrame:
    """Latest run id of every pipeline; run ids that carry no time stamp sort first."""
    stamped = F.when(F.col(run).rlike(r"^\d{8}_\d{6}$"), F.col(run)).otherwise(F.lit(""))
    return runs.groupBy(pipeline).agg(F.max_by(run, F.struct(stamped, F.col(run))).alias(run))


def best_source_daily(
    rows: DataFrame, keys: Sequence[str], source: str, value: str, ranking: Sequence[str]
) -> DataFrame:
    """Mean per key and source, then the best-ranked source of each key (ties by name)."""
    means = rows.groupBy(*keys, source).agg(F.avg(value).alias(value))
    ranked = means.withColumn("__rank", rank_of(F.upper(source), [r.upper() for r in ranking], UNLISTED_SOURCE))
    return first_row(ranked, keys, ["__rank", source]).drop("__rank")


def best_series(
    df: DataFrame, keys: Sequence[str], instrument: str, columns: Sequence[str], ranking: Sequence[str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """One row per key: each column takes its first non-null value in rank order.

    Columns are chosen one by one, so a row may mix instruments. Null keys form no group.
    """
    ranked = df.dropna(subset=list(keys)).withColumn(
        "rank", rank_of(F.col(instrument), ranking, UNLISTED_INSTRUMENT)
    )
    order = F.struct(F.col("rank"), F.col(instrument), *[F.col(t) for t in ties])
    chosen = [
        F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
        for c in dict.fromkeys([instrument, *columns, "rank"])
    ]
    return ranked.groupBy(*keys).agg(*chosen)


def with_best_series(
    df: DataFrame, keys: Sequence[str], instrument: str, ranking: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """Original rows labelled by instrument plus the BEST rows."""
    others = [c for c in df.columns if c not in (*keys, instrument)]
    best = best_series(df, keys, instrument, others, ranking, ties).withColumn("analysis_group", F.lit("BEST"))
    labelled = df.withColumns(
        {"rank": rank_of(F.col(instrument), ranking, UNLISTED_INSTRUMENT), "analysis_group": F.col(instrument)}
    )
    return labelled.unionByName(best, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts; null keys count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def rows_of_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return null_safe_join(df, duplicate_keys(df, keys).drop("duplicate_count"), keys, "left_semi")


def top_two(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Largest and second largest value per group (equal values count twice)."""
    spec = W.partitionBy(*keys).orderBy(F.col(value).desc())
    kept = df.where(F.col(value).isNotNull()).select(*keys, value)
    kept = kept.withColumn("__rn", F.row_number().over(spec)).where("__rn <= 2")
    return kept.groupBy(*keys).agg(
        F.max(F.when(F.col("__rn") == 1, F.col(value))).alias("largest"),
        F.max(F.when(F.col("__rn") == 2, F.col(value))).alias("second"),
    )


def union_distinct(old: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows plus new ones, full-row duplicates removed."""
    return old.unionByName(new, allowMissingColumns=True).dropDuplicates()


def value_counts(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """`(metric, value)` rows: how often each value of each column occurs, in one pass."""
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    cells = F.explode(F.array(*[
        F.concat(F.lit(f"{label}."), F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c, label in names.items()
    ]))
    return df.select(cells.alias("metric")).groupBy("metric").agg(F.count(F.lit(1)).alias("value"))
