"""Layered tables on disk: one Parquet table per group, partitioned by instrument and run."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from limnospark.functions.text import point_token
from limnospark.functions.dates import eight_digit_date, with_computed
from limnospark.operators.choose import latest_runs
from limnospark.operators.groups import null_safe_join

GROUPS = ("Summary", "Points", "Sections", "Gates")
# Names the station and date columns go by, and columns that are no parameters.
POINT_NAMES = ("station_id", "point", "station_code", "station")
DATE_NAMES = ("measurement_date", "date")
ID_COLUMNS = ("instrument", "station_id", "station_code", "station_name", "point", "measurement_date", "date", "measurement_time")
META_COLUMNS = ("source_file", "source_run_dir", "run_id", "source_csv")
#: Partition column that `write_table` makes of a date: year and month, or null where there is no date.
MONTH = "measurement_month"
WRITE_MODES = {"overwrite": "overwrite", "fail_if_exists": "errorifexists"}


def write_table(
    df: DataFrame, path: str, partitions: Sequence[str] = ("instrument",), policy: str = "overwrite", salts: int = 8,
    spread: Sequence[str] = (), month_of: str | None = None,
) -> None:
    """Write one table as Parquet; `fail_if_exists` refuses to replace one.

    Rows are dealt out by partition and a few salts (a hash of `spread`, by default of all columns), so a partition gets at
    most `salts` files and a large one is still written by as many tasks. `month_of` names a date kept as text or typed: its
    month becomes a partition, too, so that a range of dates opens the months it touches and no others.
    """
    if policy not in WRITE_MODES:
        raise ValueError(f"write policy must be one of {sorted(WRITE_MODES)}")
    if month_of:
        df, partitions = df.withColumn(MONTH, F.substring(eight_digit_date(F.col(f"`{month_of}`")), 1, 6)), (*partitions, MONTH)
    present = [p for p in partitions if p in df.columns]
    salt = F.pmod(F.xxhash64(*(spread or df.columns)), F.lit(salts))
    dealt = df.repartition(*present, salt)
    dealt.write.mode(WRITE_MODES[policy]).partitionBy(*present).option("maxRecordsPerFile", 5_000_000).parquet(path)


def within_months(df: DataFrame, early: str | None, late: str | None, undated: bool = False) -> DataFrame:
    """Rows of the months from `early` to `late` (dates as text), for tables that have the months as partitions; others as they are.

    The exact dates are for the caller to compare. `undated` keeps rows whose month says nothing: none, or that of the epoch.
    """
    if MONTH not in df.columns or not (early or late):
        return df
    month, inside = F.col(MONTH).cast("string"), F.lit(True)
    for bound, holds in ((early, month.__ge__), (late, month.__le__)):
        digits = re.sub("[^0-9]", "", str(bound or ""))
        if len(digits) == 8 and digits[:4] > "1900":  # other spellings of a date are left to the exact comparison
            inside = inside & holds(F.lit(digits[:6]))
    return df.where(inside | month.isNull() | (month == "197001") if undated else inside)


def write_report(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def load_table(spark: SparkSession, root: str, group: str, instrument: str | None = "all") -> DataFrame:
    """A group's table; naming an instrument prunes its partitions."""
    df = spark.read.parquet(f"{root}/{group}")
    return only_instrument(df, instrument)


def load_optional(spark: SparkSession, root: str, group: str, instrument: str | None = "all") -> DataFrame | None:
    try:
        return load_table(spark, root, group, instrument)
    except AnalysisException:
        return None


def only_instrument(df: DataFrame, instrument: str | Sequence[str] | None) -> DataFrame:
    """Rows of the named instruments, in any letter case; `all` keeps every row."""
    names = [instrument] if isinstance(instrument, str) else list(instrument or ())
    names = [n.lower() for n in names if n]
    if not names or "all" in names:
        return df
    if "instrument" not in df.columns:
        raise KeyError("the table has no instrument column")
    return df.where(F.lower("instrument").isin(*names))


def with_instrument(df: DataFrame, partition_value: Column | str) -> DataFrame:
    """`instrument` filled from the partition where the row does not say."""
    fill = F.lit(partition_value) if isinstance(partition_value, str) else partition_value
    own = F.col("instrument") if "instrument" in df.columns else F.lit(None).cast("string")
    return df.withColumn("instrument", F.coalesce(own, fill))


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def instruments_of(df: DataFrame) -> DataFrame:
    return df.select(F.trim("instrument").alias("instrument")).where("instrument <> ''").distinct()


def points_of(df: DataFrame) -> DataFrame:
    """Distinct point codes with a number to sort them by."""
    column = first_present(df.columns, POINT_NAMES)
    code = point_token(F.col(column))
    return df.select(code.alias("point")).where("point is not null").distinct().withColumn("number", point_number(F.col("point")))


def point_number(code: Column) -> Column:
    """Sort key of `P12`-like codes."""
    return F.regexp_replace(F.upper(code), "^P", "").try_cast("int")


def parameter_columns(df: DataFrame, with_metadata: bool = False) -> list[str]:
    """Columns that can be exported: numeric ones first."""
    left_out = {*ID_COLUMNS, *(() if with_metadata else META_COLUMNS)}
    fields = [f for f in df.schema.fields if f.name not in left_out]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric + [f.name for f in fields if f.name not in numeric]


def months_of(df: DataFrame, date: str = "measurement_date") -> DataFrame:
    """Distinct (point, month) of the measurements."""
    column = first_present(df.columns, POINT_NAMES)
    return df.select(
        point_token(F.col(column)).alias("point"), F.substring(eight_digit_date(F.col(date)), 1, 6).alias("month")
    ).distinct()


def run_parts(path: Column) -> Column:
    """What a path `<...>/ingest_x/<run>/outputs/raw_canonical/<instrument>/<group>/<file>` tells, as struct; null where it has another form.

    The parts are cut out at the last seven slashes, which costs a small part of a pattern's time. What stands before them is one line.
    """
    last = lambda n: F.substring_index(path, "/", -n)
    part = lambda n: F.substring_index(last(n), "/", 1)
    names = {"pipeline": 7, "run_id": 6, "instrument": 3, "group": 2, "csv_filename": 1}
    formed = last(5).startswith("outputs/raw_canonical/") & (F.length(last(7)) > F.length(last(6)))
    for n in names.values():
        formed = formed & (part(n) != "")
    formed = formed & ~F.left(path, F.length(path) - F.length(last(7))).rlike(r"[\n\r\u0085\u2028\u2029]")
    folder = F.left(path, F.length(path) - F.length(last(5)) - 1)
    return F.when(formed, F.struct(folder.alias("source_run_dir"), *[part(n).alias(name) for name, n in names.items()]))


def list_runs(files: DataFrame, path: str = "csv_path") -> DataFrame:
    """Runs that hold raw tables: distinct (pipeline, run_id)."""
    described = with_computed(files.select(path), {"__run": run_parts(F.col(path))}).select("__run.*")
    return described.where(F.col("pipeline").startswith("ingest_")).select("pipeline", "run_id").distinct()


def select_runs(
    runs: DataFrame, include: Sequence[str] | DataFrame = (), exclude: Sequence[str] | DataFrame = (), latest_only: bool = False
) -> DataFrame:
    """Runs that are included and not excluded. A list may be a table with the column `run_id`, too, which is joined and may be of any length."""
    kept = runs
    if isinstance(include, DataFrame):
        kept = kept.join(include.select("run_id"), "run_id", "left_semi").select(*runs.columns)
    elif include:
        kept = kept.where(F.col("run_id").isin(*include))
    if isinstance(exclude, DataFrame):
        kept = kept.where("run_id is not null").join(exclude.select("run_id"), "run_id", "left_anti").select(*runs.columns)
    elif exclude:
        kept = kept.where(~F.col("run_id").isin(*exclude))
    return latest_runs(kept) if latest_only else kept


def audit_tables(df: DataFrame, stage: str) -> DataFrame:
    """Which (instrument, group, layout) tables exist, with file and row counts."""
    layout = F.when(F.count_distinct("source_file") > 1, "file_group").otherwise("concat_file")
    return df.groupBy("instrument", "group").agg(
        layout.alias("layout"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("stage", F.lit(stage))


def pair_by_key(summary: DataFrame, points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summary rows with a flag telling whether Points exist for the same measurement."""
    present = points.select(*keys).distinct().withColumn("has_points", F.lit(True))
    return null_safe_join(summary, present, keys, "left").withColumn("has_points", F.coalesce("has_points", F.lit(False)))


def instrument_catalogue(spark: SparkSession, entries: Sequence[Mapping]) -> DataFrame:
    """Instrument catalogue: code, name, folder and how its Summary states the flow."""
    names = ("code", "name", "subdir", "summary_format", "flow_column", "flow_unit", "flow_row_label")
    defaults = {"summary_format": "wide", "flow_unit": "l/s"}
    rows = []
    for entry in entries:
        code, subdir = str(entry.get("code", "")).upper().strip(), str(entry.get("subdir", "")).strip()
        if code and subdir:
            rows.append(tuple({**defaults, **entry, "code": code, "subdir": subdir}.get(n) for n in names))
    if not rows:
        raise ValueError("no instruments defined")
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
