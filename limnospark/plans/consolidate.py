"""Consolidation of ingest runs: the latest file per key, renamed columns, filled trace columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions.dates import with_computed
from limnospark.functions.text import file_name_metadata, null_if_blank
from limnospark.operators.choose import first_row
from limnospark.operators.groups import attach_group_values
from limnospark.operators.specs import RAW_TRACE_COLUMNS, alias_mapping, apply_aliases, ref, trace_first
from limnospark.sources.tables import run_parts, select_runs

# Raw columns that may hold each trace value.
TRACE_CANDIDATES = {
    "station_id": ("station_id", "estacion_num", "ref", "ref val"),
    "station_name": ("station_name", "nombre", "name", "name val", "site_name"),
    "measurement_date": ("measurement_date", "fecha"),
    "measurement_time": ("measurement_time", "hora_ini", "start_time", "timestamp_time"),
    "source_file": ("source_file", "source_csv", "input_path", "raw_source_file"),
    "source_run_dir": ("source_run_dir",), "run_id": ("run_id",),
}


def fill_trace(
    df: DataFrame, file: str, row: str, defaults: Mapping[str, Column], candidates: Mapping[str, Sequence[str]] = TRACE_CANDIDATES
) -> DataFrame:
    """Empty trace cells take the file's first value over the candidate columns, else the default.

    "First" is by row number inside the file. The file's values are attached by row block, so one
    large file does not end up in one task.
    """
    firsts = trace_firsts(df.columns, row, candidates)
    attached = attach_group_values(df, [file], row, firsts)
    return attached.withColumns(_filled(df.columns, firsts, defaults, candidates)).drop(*firsts)


def trace_firsts(columns: Sequence[str], row: str, candidates: Mapping[str, Sequence[str]] = TRACE_CANDIDATES) -> dict[str, Column]:
    """Aggregates: the first non-empty value by row number of each candidate column that is there."""
    firsts: dict[str, Column] = {}
    for name, wanted in candidates.items():
        for i, column in enumerate(c for c in wanted if c in columns):
            value = null_if_blank(ref(column).cast("string"))
            firsts[f"__{name}_{i}"] = F.min_by(value, F.when(value.isNotNull(), F.col(row)))
    return firsts


def _filled(columns: Sequence[str], firsts: Mapping[str, Column], defaults: Mapping[str, Column], candidates: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    filled = {}
    for name in dict.fromkeys([*candidates, *defaults]):
        own = [null_if_blank(ref(name).cast("string"))] if name in columns else []
        found = [F.col(c) for c in firsts if c.rsplit("_", 1)[0] == f"__{name}"]
        default = [defaults[name]] if name in defaults else []
        filled[name] = F.coalesce(*own, *found, *default, F.lit(""))
    return filled


def describe_files(rows: DataFrame, path: str, group: str) -> DataFrame:
    """One row per file: run, instrument, group and what its name says."""
    return described_files(rows.select(path).distinct(), path, group)


def described_files(files: DataFrame, path: str, group: str) -> DataFrame:
    """As `describe_files`, from a table with one row per file."""
    named = file_name_metadata(F.col(path), group)
    told = with_computed(files, {"__run": run_parts(F.col(path))}).select(*[ref(c) for c in files.columns], "__run.*")
    return told.where(F.col("group") == group).withColumn("named", named)


def select_files(
    files: DataFrame, by: Sequence[str] = ("csv_filename",), path: str = "csv_path", deduplicate: bool = True
) -> DataFrame:
    """The latest file per key: run time stamp first, then path; `filename` means the file's name."""
    if not deduplicate:
        return files
    names = {"filename": "csv_filename", "csv_path": path}
    keys = [names.get(k, k) for k in by]
    if not keys:
        raise ValueError("deduplicate_by cannot be empty")
    stamp = F.when(F.col("run_id").rlike(r"^\d{8}_\d{6}$"), F.col("run_id")).otherwise(F.lit(""))
    return first_row(files.withColumn("run_ts", stamp), keys, [F.col("run_ts").desc(), F.col(path).desc()]).drop("run_ts")


def file_values(rows: DataFrame, path: str, row: str, columns: Sequence[str]) -> DataFrame:
    """First non-empty value of each column per file, to deduplicate by columns of the data."""
    return rows.groupBy(path).agg(*[
        F.min_by(null_if_blank(ref(c).cast("string")), F.when(null_if_blank(ref(c).cast("string")).isNotNull(), F.col(row))).alias(c)
        for c in columns
    ])


def manifest(files: DataFrame, selected: DataFrame, path: str = "csv_path") -> DataFrame:
    """Every candidate file with a flag telling whether it was taken."""
    taken = selected.select(path).withColumn("__taken", F.lit(True))
    return files.join(taken, path, "left").select(
        "instrument", "group", path, "csv_filename", F.col("source_run_dir").alias("run_dir"), "run_id",
        F.coalesce("__taken", F.lit(False)).alias("selected"),
    )


def build_group(
    rows: DataFrame, instrument: str, group: str, path: str = "csv_path", row: str = "row_no",
    include: Sequence[str] = (), exclude: Sequence[str] = (), latest_only: bool = False,
    deduplicate: bool = True, by: Sequence[str] = ("filename",), aliases: Mapping | None = None,
) -> dict[str, DataFrame]:
    """One instrument's group from all its runs: the consolidated rows and the manifest.

    One aggregation lists the files and finds the first values that fill their trace columns, so that the rows are joined once,
    to the chosen files. A hash of the path goes before it in grouping and join, since paths begin alike and are slow to sort.
    """
    data = apply_aliases(rows, alias_mapping(aliases, instrument, group)).withColumn("__hash", F.xxhash64(path))
    firsts = trace_firsts([c for c in data.columns if c != "__hash"], row)
    listed = data.groupBy("__hash", path).agg(F.count(F.lit(1)).alias("__rows"), *[value.alias(name) for name, value in firsts.items()])
    files = described_files(listed, path, group).where(F.col("instrument") == instrument)
    if include or exclude or latest_only:
        files = files.join(select_runs(files, include, exclude, latest_only).select("pipeline", "run_id").distinct(), ["pipeline", "run_id"], "left_semi")
    known = {"filename", "csv_filename", "csv_path", "run_id", "source_run_dir", "instrument", "group"}
    from_data = [k for k in by if k not in known]
    keyed = files
    if from_data:
        values = file_values(rows, path, row, [k for k in from_data if k in rows.columns])
        keyed = files.join(values, path, "left")
        for k in from_data:
            own = [F.col(k)] if k in rows.columns else []
            named = [F.col(f"named.{k}")] if k in ("station_id", "measurement_date", "measurement_time") else []
            keyed = keyed.withColumn(k, F.coalesce(*own, *named, F.lit("")))
    chosen = select_files(keyed, by, path, deduplicate)
    # what a path tells is read from it again: written beside the path for the join it takes more room than the path
    kept = data.join(chosen.select("__hash", path, *firsts), ["__hash", path])
    kept = with_computed(kept, {"__run": run_parts(F.col(path)), "__named": file_name_metadata(F.col(path), group)})
    filled = kept.withColumns(_filled(data.columns, firsts, {
        "station_id": F.col("__named.station_id"), "measurement_date": F.col("__named.measurement_date"),
        "measurement_time": F.col("__named.measurement_time"), "instrument": F.col("__run.instrument"),
        "source_file": F.col(path), "source_run_dir": F.col("__run.source_run_dir"), "run_id": F.col("__run.run_id"),
    }, TRACE_CANDIDATES))
    out = filled.drop("__hash", "__run", "__named", *firsts, path, row)
    return {"rows": trace_first(out, RAW_TRACE_COLUMNS), "manifest": manifest(files, chosen, path)}
