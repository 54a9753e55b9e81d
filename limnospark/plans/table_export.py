"""Export of a normalized table: flat, pivoted by period, or long with every period present."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from limnospark.functions.dates import eight_digit_date, with_computed
from limnospark.functions.text import point_token, point_token_text
from limnospark.operators.reshape import (
    aggregate, complete_periods, complete_rows, period_axis, period_count, pivot_periods, requested_rows,
)
from limnospark.operators.specs import ref
from limnospark.session import written
from limnospark.sources.tables import DATE_NAMES, POINT_NAMES, first_present, instruments_of, only_instrument, parameter_columns, within_months


#: Periods that one pivoted frame may have.
MOST_PERIODS = 1_000


@dataclass(frozen=True)
class ExportRequest:
    table: str = "Summary"
    instrument: str = "all"
    points: Sequence[str] = ()
    parameters: Sequence[str] = ()
    early: str | None = None
    late: str | None = None
    grouping: str = "none"
    aggregation: str = "mean"
    order: Sequence[str] = field(default=("measurement_time",))


def select_rows(df: DataFrame, request: ExportRequest) -> DataFrame:
    """Instrument, point and date filters; adds `date_text` (`YYYYMMDD`), and undated rows leave."""
    df = only_instrument(df, request.instrument)
    point, date = first_present(df.columns, POINT_NAMES), first_present(df.columns, DATE_NAMES)
    if request.points:
        if not point:
            raise KeyError("the table has no station column")
        wanted = sorted({point_token_text(p) for p in request.points})
        df = df.where(point_token(ref(point)).isin(*wanted))
    if not date:
        if request.early or request.late:
            raise KeyError("the table has no date column")
        return df
    df = within_months(df, request.early, request.late)
    df = with_computed(df, {"date_text": eight_digit_date(ref(date))}).where("date_text is not null")
    if request.early:
        df = df.where(F.col("date_text") >= request.early)
    if request.late:
        df = df.where(F.col("date_text") <= request.late)
    return df


def date_bounds(df: DataFrame, request: ExportRequest) -> tuple[str | None, str | None]:
    """Asked bounds, and the data's own where one was left open (one aggregated row)."""
    if (request.early and request.late) or "date_text" not in df.columns:
        return request.early, request.late
    # eight digits that are no date make no calendar
    real = F.when(F.try_to_timestamp("date_text", F.lit("yyyyMMdd")).isNotNull(), F.col("date_text"))
    found = df.agg(F.min(real).alias("lo"), F.max(real).alias("hi")).first()
    return request.early or found["lo"], request.late or found["hi"]


def flat_export(df: DataFrame, parameters: Sequence[str]) -> DataFrame:
    base = ["instrument", first_present(df.columns, POINT_NAMES), "station_name", first_present(df.columns, DATE_NAMES), "measurement_time"]
    names = list(dict.fromkeys([c for c in base if c and c in df.columns] + [p for p in parameters if p in df.columns]))
    return df.select(*[ref(c) for c in names])


def grouped_export(df: DataFrame, request: ExportRequest, parameters: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Long aggregate per row key and period, the row keys, and the numeric parameters."""
    point = first_present(df.columns, POINT_NAMES)
    length = 6 if request.grouping == "monthly" else 8
    work = df.withColumns({"station_id": point_token(ref(point)), "period": F.substring("date_text", 1, length)})
    numeric = [f.name for f in work.schema.fields if f.name in parameters and isinstance(f.dataType, T.NumericType)]
    if not numeric:
        raise ValueError("no numeric parameter to group")
    keys = ["instrument", "station_id"] if "instrument" in work.columns else ["station_id"]
    return aggregate(work, [*keys, "period"], numeric, request.aggregation, request.order), keys, numeric


def _checked(df: DataFrame, request: ExportRequest) -> tuple[DataFrame, list[str]]:
    chosen = select_rows(df, request)
    parameters = list(request.parameters) or parameter_columns(df)
    missing = [p for p in parameters if p not in df.columns]
    if missing:
        raise KeyError(f"parameters not found: {missing}")
    if request.grouping not in ("none", "monthly", "daily"):
        raise ValueError("grouping must be none, monthly or daily")
    return chosen, parameters


def _wanted_rows(chosen: DataFrame, request: ExportRequest, keys: Sequence[str]) -> DataFrame | None:
    """The rows that a pivot has even where nothing was measured; None if the data decide."""
    if not request.points:
        return None
    instruments = None
    if "instrument" in keys:
        instruments = instruments_of(chosen)
        if request.instrument and request.instrument.lower() != "all":
            instruments = chosen.sparkSession.range(1).select(F.lit(request.instrument).alias("instrument"))
    return requested_rows(instruments, request.points, chosen.sparkSession)


def run_export(df: DataFrame, request: ExportRequest, long: bool = False) -> DataFrame:
    """The requested export. `none` is flat, `monthly` and `daily` are pivoted, or long if asked.

    A pivot has a column for each period and parameter and takes up to `MOST_PERIODS` periods; `export_blocks` takes any number.
    """
    chosen, parameters = _checked(df, request)
    if request.grouping == "none":
        return flat_export(chosen, parameters)
    early, late = date_bounds(chosen, request)
    grouped, keys, numeric = grouped_export(chosen, request, parameters)
    if long:
        return complete_periods(grouped, keys, "period", early, late, request.grouping)
    if early and late and period_count(early, late, request.grouping) > MOST_PERIODS:
        raise ValueError(f"{early} to {late} has more than {MOST_PERIODS} periods: use export_blocks, or the long form")
    periods = period_axis(early, late, request.grouping) if early and late else []
    wide = pivot_periods(grouped, keys, "period", periods, numeric)
    wanted = _wanted_rows(chosen, request, keys)
    return wide if wanted is None else complete_rows(wide, wanted, keys)


def export_blocks(
    df: DataFrame, request: ExportRequest, width: int = 120, filled: bool = True, keep: Callable[[DataFrame, str], DataFrame] = written,
) -> Iterator[tuple[list[str], DataFrame]]:
    """A pivot over any number of periods, as one frame for each block of `width` periods, with the block's periods.

    Every frame has the same rows, those of the whole request. The values are grouped once and kept as a table. With `filled`, blocks
    in which nothing was measured are left out, so that a stray date far away adds one block and not all those between.
    """
    chosen, parameters = _checked(df, request)
    if request.grouping == "none":
        raise ValueError("a flat export has no periods")
    early, late = date_bounds(chosen, request)
    if not early or not late:
        return
    grouped, keys, numeric = grouped_export(chosen, request, parameters)
    grouped = keep(grouped, "grouped")
    rows = _wanted_rows(chosen, request, keys)
    rows = grouped.select(*keys).distinct() if rows is None else rows
    count = period_count(early, late, request.grouping)
    held = None
    if filled:
        # number of the period in the calendar, from its label
        first = F.to_date(F.lit(early), "yyyyMMdd")
        day = F.try_to_timestamp(F.rpad("period", 8, "01") if request.grouping == "monthly" else F.col("period"), F.lit("yyyyMMdd")).cast("date")
        number = F.months_between(day, F.trunc(first, "month")).cast("int") if request.grouping == "monthly" else F.date_diff(day, first)
        held = {r.block for r in grouped.select(F.floor(number / width).alias("block")).distinct().collect()}  # one number for each block
    for block in range(-(-count // width)):
        if held is None or block in held:
            periods = period_axis(early, late, request.grouping, block * width, width)
            own = grouped.where(F.col("period").between(periods[0], periods[-1]))
            yield periods, complete_rows(pivot_periods(own, keys, "period", periods, numeric), rows, keys)


def request_metadata(df: DataFrame, request: ExportRequest, bounds: tuple[str | None, str | None]) -> DataFrame:
    """One row that describes an export."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(request.table).alias("table"), F.lit(request.instrument).alias("instrument"),
        F.lit(", ".join(request.points)).alias("points"), F.lit(", ".join(request.parameters)).alias("parameters"),
        F.lit(request.early).cast("string").alias("early_date_requested"), F.lit(request.late).cast("string").alias("late_date_requested"),
        F.lit(bounds[0]).cast("string").alias("early_date_effective"), F.lit(bounds[1]).cast("string").alias("late_date_effective"),
        F.lit(request.grouping).alias("grouping"), F.lit(request.aggregation).alias("aggregation"), "row_count",
    )
