"""Cross-section profiles: the x/y rows of each measurement and an index of measurements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from limnospark.functions import dates as D, text as T
from limnospark.operators.specs import ref
from limnospark.sources.tables import within_months

KEYS = ("station_id", "measurement_date", "measurement_time", "instrument", "instrument_code")


def load_points(df: DataFrame, instruments: Mapping[str, Mapping], file: str | None = None) -> DataFrame:
    """Points of the enabled instruments; the file name fills in what the rows do not say."""
    enabled = {name: str(c.get("code", name)) for name, c in instruments.items() if c.get("enabled")}
    named = T.file_name_metadata(F.col(file), "Points", numeric_station=True) if file else None
    date = next((c for c in ("measurement_date", "date") if c in df.columns), None)
    station = next((c for c in ("station_id", "point") if c in df.columns), None)
    own_date = F.col(date) if date else F.lit(None).cast("string")
    own_station = T.point_code(F.col(station)) if station else F.lit(None).cast("string")
    own_time = T.null_if_empty(F.col("measurement_time").cast("string")) if "measurement_time" in df.columns else F.lit(None).cast("string")
    if named is not None:
        stamp = named["measurement_time"]
        clock = F.concat_ws(":", F.substring(stamp, 1, 2), F.substring(stamp, 3, 2), F.substring(stamp, 5, 2))
        day = D.iso_date_or(own_date, named["measurement_date"])
        own_station = F.coalesce(own_station, T.point_code(named["station_id"]))
        own_time = F.coalesce(own_time, F.when(stamp.isNotNull(), clock))
    else:
        day = D.date_of(df, date) if date else D.iso_date(own_date)
    return D.with_computed(df.where(F.col("instrument").isin(*enabled)), {
        "measurement_date": day, "station_id": own_station, "measurement_time": own_time,
        "instrument_code": T.mapped_name(F.col("instrument"), enabled),
    })


def select_rows(df: DataFrame, instruments: Sequence[str] | None = None, points: Sequence[str] | None = None,
                start: str | None = None, end: str | None = None) -> DataFrame:
    if instruments:
        df = df.where(F.col("instrument").isin(*instruments))
    if points:
        df = df.where(F.col("station_id").isin(*points))
    df = within_months(df, start, end, undated=True)  # a file's name may date a row that has no date of its own
    if start:
        df = df.where(F.col("measurement_date") >= D.iso_date(F.lit(start)))
    if end:
        df = df.where(F.col("measurement_date") <= D.iso_date(F.lit(end)))
    return df


def check_axes(df: DataFrame, x: str, y: str) -> None:
    for axis in (x, y):
        if axis not in df.columns:
            raise ValueError(f"column {axis} is not available; available: {sorted(df.columns)}")


def profile_rows(df: DataFrame, x: str = "distance_m", y: str = "depth_m", keys: Sequence[str] = KEYS) -> DataFrame:
    check_axes(df, x, y)
    return df.select(*[ref(k) for k in keys if k in df.columns], ref(x).alias("x"), ref(y).alias("y"))


def profile_index(df: DataFrame, keys: Sequence[str] = KEYS, source: str | None = None) -> DataFrame:
    """One row per measurement: how many rows it has and where they come from."""
    present = [k for k in keys if k in df.columns]
    origin = [F.min(ref(source)).alias("source_file")] if source else []
    return df.groupBy(*present).agg(F.count(F.lit(1)).alias("n_rows"), *origin)
