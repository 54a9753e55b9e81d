"""Discharge series: model, station and gauge, all in litres per second."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.functions import dates as D, numbers as N, text as T
from limnospark.operators.choose import best_source_daily

FIRST_VALID_DATE = "1990-01-01"
# Column names a Summary table may use.
POINT_CANDIDATES = ("station_id", "point", "point_id", "measurement_point", "punto", "site", "station", "p")
DATE_CANDIDATES = ("measurement_date", "date", "fecha", "datetime")
SOURCE_CANDIDATES = ("instrument", "source", "instrument_code", "instrument_used", "source_code")
LITRE_CANDIDATES = ("q_l/s", "q_ls", "q_total_ls", "q_mean_ls", "q_meas_ls", "caudal_ls", "flow_ls")
CUBIC_CANDIDATES = ("q_m3s", "q_total_m3s", "q(m3/s)", "caudal_m3s", "caudal", "q")
WIDE_DATE_CANDIDATES = ("measurement_date", "date", "datetime", "etime", "timestamp", "fecha")
# Grains a station series may fall back to, best first.
FALLBACKS = {"monthly": ("monthly", "daily"), "daily": ("daily", "hourly"), "hourly": ("hourly",)}


def read_model(spark: SparkSession, folder: str) -> DataFrame:
    """`P<n>_model_data.csv` files as one table `(point, date, q_model_ls)`."""
    df = spark.read.option("header", True).option("pathGlobFilter", "*_model_data.csv").csv(folder)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^P?(\d+)_model_data\.csv$", 1)
    return model_series(df.withColumn("point", F.nullif(name, F.lit(""))))


def model_series(df: DataFrame, flow: str = "q(m3/s)") -> DataFrame:
    return df.select(
        "point", D.date_of(df, "date").alias("date"), (N.number_of(df, flow) * 1000.0).alias("q_model_ls")
    ).dropna()


def read_stations(spark: SparkSession, folder: str) -> DataFrame:
    """`<station>_<timestep>_station_data.csv` files as one tagged table.

    Each timestep is read by itself, because its files have their own columns.
    """
    out = None
    for timestep in FALLBACKS:
        reader = spark.read.option("header", True).option("pathGlobFilter", f"*_{timestep}_station_data.csv")
        try:
            df = reader.csv(folder)
        except AnalysisException:  # no file of this timestep
            continue
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^([^_]+)_", 1)
        tagged = df.select("*", name.alias("station"), F.lit(timestep).alias("timestep"))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no station files in {folder}")
    return out


def stations_with(df: DataFrame, timestep: str) -> DataFrame:
    return df.where(F.col("timestep") == timestep).select("station").distinct()


def station_series(df: DataFrame, timestep: str, flow: str = "q(m3/s)") -> DataFrame:
    """Series at one timestep; a station without it falls back to the next finer grain it has."""
    grains = FALLBACKS[timestep]
    rank = F.array_position(F.array(*[F.lit(g) for g in grains]), F.col("timestep"))
    ranked = df.where(F.col("timestep").isin(*grains)).withColumn("__rank", rank)
    rows = ranked.where("station is not null").select(
        "station", "__rank", D.date_of(ranked, "date").alias("date"),
        (N.number_of(ranked, flow) * 1000.0).alias("q_station_ls"),
        *([F.coalesce("time", F.lit("00:00:00")).alias("time")] if "time" in df.columns else []),
    ).dropna(subset=["date", "q_station_ls"])
    if timestep == "hourly":  # one grain only, so there is nothing to choose
        return rows.select("station", "date", "time", "q_station_ls")
    # One row per station and grain decides. The grains are averaged before the choice, so that the join meets one row
    # per station, grain and period: a few stations with many rows would otherwise be a task each.
    chosen = ranked.groupBy("station").agg(F.min("__rank").alias("__rank"))
    means = station_means(rows, timestep, ("__rank",))
    return means.join(chosen, ["station", "__rank"], "left_semi").drop("__rank")


def station_means(rows: DataFrame, timestep: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean flow per day, or per month named by its first day; `keys` are kept apart."""
    day = D.month_start(F.col("date")) if timestep == "monthly" else F.col("date")
    name = "month" if timestep == "monthly" else "date"
    return rows.groupBy("station", *keys, day.alias(name)).agg(F.avg("q_station_ls").alias("q_station_ls"))


def read_manual_stage(spark: SparkSession, folder: str) -> DataFrame:
    return manual_stage(spark.read.option("header", True).csv(f"{folder}/manual_stage.csv"))


def manual_stage(df: DataFrame) -> DataFrame:
    return df.select(
        T.point_code(F.col("station_id")).alias("station_id"), D.date_of(df, "measurement_date").alias("measurement_date"),
        N.number_of(df, "manual_stage_m").alias("manual_stage_m"),
    )


def find_column(columns: Sequence[str], candidates: Sequence[str], contains: bool = True) -> str | None:
    """A column by name in any letter case, else by a candidate inside its name."""
    lowered = {c.lower(): c for c in columns}
    for candidate in candidates:
        if candidate.lower() in lowered:
            return lowered[candidate.lower()]
    if contains:
        for column in columns:
            if any(candidate.lower() in column.lower() for candidate in candidates):
                return column
    return None


def summary_gauges(df: DataFrame, default_source: str | None = None) -> DataFrame | None:
    """Gauge rows of a Summary table whose columns are found by name; None when they are not there."""
    point = find_column(df.columns, POINT_CANDIDATES)
    date = find_column(df.columns, DATE_CANDIDATES, contains=False)
    source = find_column(df.columns, SOURCE_CANDIDATES)
    litres, cubic = find_column(df.columns, LITRE_CANDIDATES), find_column(df.columns, CUBIC_CANDIDATES)
    if not point or not date or not (litres or cubic):
        return None
    flow = N.number_of(df, litres) if litres else N.number_of(df, cubic) * 1000.0
    name = F.upper(F.col(f"`{source}`").cast("string")) if source else F.lit((default_source or "UNK").upper())
    values = {
        "point": F.trim(F.replace(F.col(f"`{point}`").cast("string"), F.lit("P"), F.lit(""))),
        "date": D.date_of(df, date, day_first=True), "source": name, "q_gauge_ls": flow,
    }
    rows = D.with_computed(df, values).select(*values)
    return rows.dropna(subset=["point", "date", "q_gauge_ls"]).where(F.col("date") >= FIRST_VALID_DATE)


def wide_gauges(df: DataFrame, instrument: Mapping, file: str = "file") -> DataFrame | None:
    """Gauge rows of per-measurement Summary files with a flow column; mean per file's point and date."""
    flow = instrument.get("flow_column")
    if not flow or flow not in df.columns:
        return None
    date = next((c for c in WIDE_DATE_CANDIDATES if c in df.columns), None)
    named = T.file_name_metadata(F.col(file), "Summary", numeric_station=True)
    day = D.date_of(df, date, day_first=True) if date else D.iso_date(named["measurement_date"])
    rows = df.select(
        F.replace(F.upper(named["station_id"]), F.lit("P"), F.lit("")).alias("point"), day.alias("date"),
        F.lit(instrument["code"].upper()).alias("source"),
        N.to_litres(F.col(f"`{flow}`"), instrument.get("flow_unit", "l/s")).alias("q_gauge_ls"), F.col(file).alias("__file"),
    ).dropna().where(F.col("date") >= FIRST_VALID_DATE)
    return rows.groupBy("point", "date", "source", "__file").agg(F.avg("q_gauge_ls").alias("q_gauge_ls")).drop("__file")


def matrix_gauges(df: DataFrame, instrument: Mapping, label: str, values: Sequence[str], file: str = "file") -> DataFrame:
    """Gauge rows of Summary files that state the flow in a labelled row: mean over its cells."""
    wanted = instrument.get("flow_row_label") or "q [l/s]"
    named = T.file_name_metadata(F.col(file), "Summary", numeric_station=True)
    cells = df.where(F.col(label) == wanted).unpivot([file], list(values), "__cell", "__q")
    flow = N.to_litres(F.col("__q"), instrument.get("flow_unit", "l/s"))
    means = cells.groupBy(file).agg(F.avg(flow).alias("q_gauge_ls"))
    return means.select(
        F.replace(F.upper(named["station_id"]), F.lit("P"), F.lit("")).alias("point"),
        D.iso_date(named["measurement_date"]).alias("date"), F.lit(instrument["code"].upper()).alias("source"), "q_gauge_ls",
    ).dropna().where(F.col("date") >= FIRST_VALID_DATE)


def source_codes(instruments: Sequence[Mapping]) -> dict[str, str]:
    """Folded code, name or folder of every instrument -> its code."""
    codes = {}
    for entry in instruments:
        for name in (entry.get("code"), entry.get("name"), entry.get("subdir")):
            if name:
                codes[T.source_key_text(name)] = str(entry["code"]).upper().strip()
    return codes


def gauges_daily(frames: Sequence[DataFrame | None], instruments: Sequence[Mapping], ranking: Sequence[str]) -> DataFrame:
    """One flow per point and day from all gauge frames: source means, then the best-ranked source."""
    parts = [f.select("point", "date", "source", "q_gauge_ls") for f in frames if f is not None]
    if not parts:
        raise ValueError("no gauge frames")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    codes = source_codes(instruments)
    rows = rows.select(
        F.trim("point").alias("point"), "date", T.source_code(F.col("source"), codes).alias("source"), "q_gauge_ls"
    ).where(F.col("point").rlike(r"^\d+$"))
    order = [codes.get(T.source_key_text(code), str(code).upper()) for code in ranking]
    return best_source_daily(rows, ["point", "date"], "source", "q_gauge_ls", order)
