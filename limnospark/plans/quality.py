"""Weighted quality score (CG) of profiler measurements."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from limnospark.functions.dates import period_label
from limnospark.functions.numbers import number_of
from limnospark.functions.text import file_name_metadata, quality_column
from limnospark.operators.matching import positional_join
from limnospark.operators.specs import ref


def weighted_scores(rows: DataFrame, keys: Sequence[str], weight: str, score: str) -> DataFrame:
    """Mean of `score` weighted by |weight| over complete pairs, with the reason where there is none."""
    w, q = F.abs(number_of(rows, weight)), number_of(rows, score)
    complete = w.isNotNull() & q.isNotNull()
    sums = rows.groupBy(*keys).agg(
        F.count_if(complete).alias("n_pairs"), F.sum(F.when(complete, w)).alias("sw"), F.sum(F.when(complete, w * q)).alias("swq")
    )
    status = (
        F.when(F.col("n_pairs") == 0, "error: no valid data").when(F.col("sw") == 0, "error: weights sum to zero").otherwise("ok")
    )
    return sums.select(*keys, "n_pairs", F.try_divide(F.col("swq"), F.col("sw")).alias("cg"), status.alias("status"))


def quality_metrics(
    normalized: DataFrame, raw: DataFrame, weight: str = "percent_q", grain: str = "daily",
    points: Sequence[str] = (), months: Sequence[str] = (), all_months: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, label: df,
) -> dict[str, DataFrame]:
    """Scores and log of every file.

    Both tables carry `file` (`<point>_Points_<date>[_<time>].csv`) and `row_no`; rows pair up by
    row number and files of unequal length are errors. Filters on the name come before any join. `keep` may write the
    table of one row per file, which scores and log both read.
    """
    score = quality_column(raw.columns)

    def named(df: DataFrame) -> DataFrame:
        meta = file_name_metadata(F.col("file"), "Points", numeric_station=True)
        return df.withColumn("meta", meta).select(
            "*", F.upper("meta.station_id").alias("point"), F.col("meta.measurement_date").alias("date"),
            F.coalesce("meta.measurement_time", F.when(F.col("meta.measurement_date").isNotNull(), "000000")).alias("time"),
        ).drop("meta")

    def wanted(df: DataFrame) -> DataFrame:
        df = df.where(F.col("date").isNotNull())
        if points:
            ids = [str(p).strip().upper().replace("P", "") for p in points]
            df = df.where(F.replace("point", F.lit("P"), F.lit("")).isin(*ids))
        if months and not all_months:
            df = df.where(F.substring("date", 1, 6).isin(*months))
        return df

    tagged = named(normalized)
    a = wanted(tagged).select("file", "row_no", "point", "date", "time", ref(weight).alias("weight"))
    b = wanted(named(raw)).select("file", "row_no", ref(score).alias("score"))
    paired = positional_join(a, b, "file", "row_no")
    w, q = F.abs(number_of(paired, "weight")), number_of(paired, "score")
    complete = w.isNotNull() & q.isNotNull()
    sums = paired.groupBy("file").agg(
        F.first("point", True).alias("point"), F.first("date", True).alias("date"), F.first("time", True).alias("time"),
        F.count("__in_left").alias("n_normalized"), F.count("__in_right").alias("n_raw"),
        F.count_if(complete).alias("n_pairs"), F.sum(F.when(complete, w)).alias("sw"), F.sum(F.when(complete, w * q)).alias("swq"),
    ).where("n_normalized > 0")
    status = (
        F.when(F.col("n_raw") == 0, "missing_raw")
        .when(F.col("n_raw") != F.col("n_normalized"), "error")
        .when(F.col("n_pairs") == 0, "error").when(F.col("sw") == 0, "error").otherwise("ok")
    )
    reason = (
        F.when(F.col("n_raw") == 0, "raw file not found")
        .when(F.col("n_raw") != F.col("n_normalized"),
              F.format_string("length mismatch: normalized=%d, raw=%d", "n_normalized", "n_raw"))
        .when(F.col("n_pairs") == 0, "no valid data").when(F.col("sw") == 0, "weights sum to zero")
    )
    scored = sums.withColumns({
        "status": status, "reason": reason, "period": period_label(F.col("date"), F.col("time"), grain),
        "cg": F.when(status == "ok", F.try_divide(F.col("swq"), F.col("sw"))),
    })
    scored = keep(scored.drop("n_normalized", "n_raw", "n_pairs", "sw", "swq"), "scored")
    skipped = tagged.where("date is null").select("file").distinct().select(
        "file", F.lit("skipped").alias("status"), F.lit("filename_not_recognized").alias("reason"))
    log = scored.select("file", "status", "reason", "point", "date", "time").unionByName(skipped, allowMissingColumns=True)
    return {"measurements": scored.where("status = 'ok'").select("point", "date", "time", "period", "cg", "file"), "log": log}


def score_pivot(measurements: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Mean score per point and period, with the number the points sort by."""
    wide = measurements.groupBy("point").pivot("period", list(periods)).agg(F.avg("cg"))
    return wide.withColumn("point_number", F.replace("point", F.lit("P"), F.lit("")).try_cast("int"))
