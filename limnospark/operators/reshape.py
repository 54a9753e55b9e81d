"""Pivots, period calendars and completion of missing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions.text import point_token_text
from limnospark.operators.groups import grouped_median, null_safe_join

AGGREGATIONS = ("mean", "sum", "median", "min", "max", "first")


def period_count(early: str, late: str, grain: str) -> int:
    """How many months or days lie between two dates (`YYYYMMDD`), both included."""
    first, last = (datetime.strptime(d, "%Y%m%d") for d in (early, late))
    return max((last.year - first.year) * 12 + last.month - first.month + 1 if grain == "monthly" else (last - first).days + 1, 0)


def period_axis(early: str, late: str, grain: str, start: int = 0, count: int | None = None) -> list[str]:
    """Labels of the months or days from `early` to `late`, or `count` of them from number `start` on."""
    first, whole = datetime.strptime(early, "%Y%m%d"), period_count(early, late, grain)
    numbers = range(start, whole if count is None else min(start + count, whole))
    if grain == "monthly":
        months = [first.year * 12 + first.month - 1 + i for i in numbers]
        return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in months]
    return [(first + timedelta(days=i)).strftime("%Y%m%d").zfill(8) for i in numbers]


def aggregate(
    df: DataFrame, keys: Sequence[str], parameters: Sequence[str], method: str, order: Sequence[str] = ()
) -> DataFrame:
    """One value per parameter and group. A sum without values is 0; the median is exact."""
    method = (method or "mean").lower()
    if method not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation: {method}")
    if method == "median":
        # The parameters become rows of one table, so that one selection finds the middle of each group and parameter.
        cells = F.array(*[F.struct(F.lit(i).alias("__parameter"), F.col(f"`{name}`").cast("double").alias("__value")) for i, name in enumerate(parameters)])
        long = df.select(*keys, F.inline(cells))
        medians = grouped_median(long, [*keys, "__parameter"], "__value", "__median")
        wide = medians.groupBy(*keys).agg(*[F.max(F.when(F.col("__parameter") == i, F.col("__median"))).alias(name) for i, name in enumerate(parameters)])
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).drop("__rows")
        return null_safe_join(groups, wide, keys, "left")

    def one(name: str) -> Column:
        column = F.col(f"`{name}`")
        if method == "first":
            if not order:
                raise ValueError("first needs an order")
            return F.min_by(column, F.when(column.isNotNull(), F.struct(*order)))
        if method == "sum":
            return F.coalesce(F.sum(column), F.lit(0.0))
        return {"mean": F.avg, "min": F.min, "max": F.max}[method](column)

    return df.groupBy(*keys).agg(*[one(name).alias(name) for name in parameters])


def pivot_periods(
    grouped: DataFrame, row_keys: Sequence[str], period: str, periods: Sequence[str], parameters: Sequence[str],
    separator: str = " | ",
) -> DataFrame:
    """Row keys x (period, parameter) columns in period-major order."""
    wide = grouped.groupBy(*row_keys).pivot(period, list(periods)).agg(
        *[F.first(f"`{p}`", ignorenulls=True).alias(p) for p in parameters]
    )
    columns = [
        F.col(f"`{t}`" if len(parameters) == 1 and f"{t}_{p}" not in wide.columns else f"`{t}_{p}`").alias(f"{t}{separator}{p}")
        for t in periods for p in parameters
    ]
    return wide.select(*row_keys, *columns)


def requested_rows(
    instruments: DataFrame | None, points: Sequence[str], spark
) -> DataFrame:
    """Requested points, for every instrument where there is one."""
    tokens = list(dict.fromkeys(point_token_text(p) for p in points))
    listed = F.explode(F.array(*[F.lit(t) for t in tokens])).alias("station_id")
    if instruments is None:
        return spark.range(1).select(listed)
    return instruments.select("instrument", listed)


def complete_rows(wide: DataFrame, wanted: DataFrame, row_keys: Sequence[str]) -> DataFrame:
    """Exactly the wanted rows, empty where nothing was measured."""
    return null_safe_join(wanted.select(*row_keys), wide, row_keys, "left")


def complete_periods(grouped: DataFrame, row_keys: Sequence[str], period: str, early: str | None, late: str | None, grain: str) -> DataFrame:
    """Long form with one row per row key and period of the calendar, which Spark makes where it is joined."""
    rows = grouped.select(*row_keys).distinct()
    if not early or not late:
        return null_safe_join(rows.withColumn(period, F.lit(None).cast("string")).limit(0), grouped, [*row_keys, period], "left")
    step, pattern = ("interval 1 month", "yyyyMM") if grain == "monthly" else ("interval 1 day", "yyyyMMdd")
    first, last = F.to_date(F.lit(early), "yyyyMMdd"), F.to_date(F.lit(late), "yyyyMMdd")
    days = F.sequence(F.trunc(first, "month") if grain == "monthly" else first, last, F.expr(step))
    calendar = rows.select(*row_keys, F.explode(days).alias("__day")).select(*row_keys, F.date_format("__day", pattern).alias(period))
    return null_safe_join(calendar, grouped, [*row_keys, period], "left")


def unpivot_sources(
    df: DataFrame, base: Sequence[str], sources: Sequence[tuple[str, Mapping[str, str]]], value: str
) -> DataFrame:
    """One row per (row, source column) with the source's labels; a single scan."""
    entries = [
        F.struct(*[F.lit(text).alias(label) for label, text in labels.items()],
                 F.col(f"`{column}`").cast("double").alias(value))
        for column, labels in sources
    ]
    return df.select(*base, F.explode(F.array(*entries)).alias("__entry")).select(*base, "__entry.*")


def first_by_type(df: DataFrame, keys: Sequence[str], kind: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Columns for the listed kinds holding the first non-null value; rows with a null key are dropped."""
    kept = df.dropna(subset=list(keys)).where(F.col(kind).isin(*names))
    return kept.groupBy(*keys).agg(
        *[F.min(F.when(F.col(kind) == k, F.col(value))).alias(name) for k, name in names.items()]
    )


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value. One pass counts; the schema then depends on the data."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if counts[c]])
