"""Table normalization from a declarative spec (a plain dictionary).

Spec keys: `columns` (name -> source/sources and dtype), `metadata`, `metadata_policy`,
`derived`, `required`, `transforms`, `qc`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions import dates as D, numbers as N, text as T

TRACE_COLUMNS = (
    "station_id", "station_code", "station_name", "measurement_date", "measurement_time",
    "instrument", "source_file", "source_run_dir", "run_id",
)
RAW_TRACE_COLUMNS = tuple(c for c in TRACE_COLUMNS if c != "station_code")
QC_STATUS = "qc_status"


def ref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def sources_of(spec: Mapping) -> list[str]:
    if "sources" in spec:
        if not isinstance(spec["sources"], (list, tuple)):
            raise ValueError("sources must be a list")
        return [str(s) for s in spec["sources"]]
    if "source" in spec:
        return [str(spec["source"])]
    raise ValueError("a column spec needs source or sources")


def coalesce_sources(columns: Sequence[str], sources: Sequence[str]) -> Column:
    """First non-null of the sources that exist; none gives a null text."""
    found = [ref(s).cast("string") for s in sources if s in columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def check_required(columns: Sequence[str], required: Sequence[str]) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def trace_first(df: DataFrame, trace: Sequence[str] = TRACE_COLUMNS) -> DataFrame:
    """Trace columns first (added as nulls where absent), the rest in their order."""
    head = [ref(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in trace]
    return df.select(*head, *[ref(c) for c in df.columns if c not in trace])


def _derived(value: Column, operation: str, constant) -> Column:
    if operation == "copy":
        return value
    number, k = N.to_number(value, decimal_comma=True), None if constant is None else float(constant)
    if operation == "multiply":
        return number * k
    if operation == "divide":
        return F.try_divide(number, F.lit(k))
    if operation == "add":
        return number + k
    if operation == "subtract":
        return number - k
    raise ValueError(f"unknown derived operation: {operation}")


def _typed(column: Column, dtype: str | None, comma: bool) -> Column:
    if dtype == "float":
        return N.to_number(column, decimal_comma=comma)
    if dtype == "int":
        return N.whole_number(N.to_number(column))
    if dtype == "date":
        return D.spec_date(column)
    if dtype == "datetime":
        return D.spec_datetime(column)
    if dtype == "time_hhmmss":
        return D.spec_time(column)
    return column.cast("string")


def apply_metadata_policy(values: dict[str, Column], policy: Mapping | None) -> dict[str, Column]:
    """Normalize station, date and time among named expressions; adds `station_code` when enabled."""
    policy, out = policy or {}, dict(values)
    code = policy.get("station_code") or {}
    if "station_id" in out:
        out["station_id"] = T.station_id(out["station_id"], policy.get("station_id"))
    if code.get("enabled") and "station_id" in out:
        out["station_code"] = T.station_code(out["station_id"], code)
    elif "station_code" in out:
        out["station_code"] = T.station_code(out["station_code"], code)
    if "measurement_date" in out:
        out["measurement_date"] = D.measurement_date(out["measurement_date"], policy.get("measurement_date"))
    if "measurement_time" in out:
        out["measurement_time"] = D.measurement_time(out["measurement_time"], policy.get("measurement_time"))
    return out


def normalize_table(df: DataFrame, spec: Mapping, qc_column: bool = False) -> DataFrame:
    """Raw table to the common schema.

    One projection for the sources and policies and one for types and rules; no row moves.
    With `qc_column` a row that breaks a rule says so instead of failing the table.
    """
    columns_spec = spec.get("columns") or {}
    values: dict[str, Column] = {}
    for name, column_spec in columns_spec.items():
        values[name] = coalesce_sources(df.columns, sources_of(column_spec))
    for name, column_spec in (spec.get("metadata") or {}).items():
        source = coalesce_sources(df.columns, sources_of(column_spec))
        keep = name in values and not column_spec.get("overwrite", False)
        values[name] = F.coalesce(values[name], source) if keep else source
    for name in TRACE_COLUMNS:
        if name not in values:
            values[name] = ref(name).cast("string") if name in df.columns else F.lit(None).cast("string")
    derived = {}
    for name, rule in (spec.get("derived") or {}).items():
        origin = rule.get("from")
        if not origin:
            raise ValueError(f"derived column {name} needs from")
        known = {**values, **derived}
        derived[name] = (
            _derived(known[origin], rule.get("operation"), rule.get("value"))
            if origin in known else F.lit(None).cast("double")
        )
    values = apply_metadata_policy({**values, **derived}, spec.get("metadata_policy"))
    check_required(list(values), spec.get("required") or ())

    steps = [t["name"] for t in spec.get("transforms") or ()]
    unknown = set(steps) - {"strip_strings", "numeric_commas_to_dots", "enforce_dtypes"}
    if unknown:
        raise ValueError(f"unknown transforms: {sorted(unknown)}")
    untyped = df.select(*[column.alias(name) for name, column in values.items()])
    kinds = dict(untyped.dtypes)
    final, flags = [], []
    for name in values:
        column = ref(name)
        dtype = (columns_spec.get(name) or {}).get("dtype")
        if "strip_strings" in steps and kinds[name] == "string":
            column = T.strip(column)
        if "enforce_dtypes" in steps and dtype:
            if dtype == "int":
                flags.append(F.when(N.is_fractional(N.to_number(column)), F.lit(f"{name}: not whole")))
            comma = "numeric_commas_to_dots" in steps
            column = _typed(column, dtype, comma) if kinds[name] == "string" else column
        final.append(column.alias(name))
    out = trace_first(untyped.select(*final, *[f.alias(f"__flag_{i}") for i, f in enumerate(flags)]))
    rules = [c for c in (spec.get("qc") or {}).get("non_negative") or () if c in out.columns]
    notes = [F.col(f"__flag_{i}") for i in range(len(flags))]
    notes += [F.when(ref(c) < 0, F.lit(f"{c}: negative")) for c in rules]
    if qc_column:
        status = F.concat_ws("; ", *notes) if notes else F.lit("")
        out = out.withColumn(QC_STATUS, F.when(status == "", "ok").otherwise(status))
    elif rules:
        out = out.withColumns({
            c: F.when(ref(c) < 0, F.raise_error(F.lit(f"column {c} contains negative values")).cast("double"))
            .otherwise(ref(c).cast("double"))
            for c in rules
        })
    return out.drop(*[f"__flag_{i}" for i in range(len(flags))])


def negative_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Which of the columns hold a negative value, as one row of flags per instrument."""
    return df.groupBy("instrument").agg(
        *[F.coalesce(F.bool_or(ref(c) < 0), F.lit(False)).alias(c) for c in columns if c in df.columns]
    )


def alias_mapping(aliases: Mapping | None, instrument: str, group: str) -> dict[str, str]:
    """Old -> new names; later and more specific levels win."""
    merged: dict[str, str] = {}
    for level in ("*", instrument):
        for part in ("*", group):
            for old, new in (((aliases or {}).get(level) or {}).get(part) or {}).items():
                if not str(old).strip() or not str(new).strip():
                    raise ValueError("aliases must map names that are not empty")
                merged[str(old).strip()] = str(new).strip()
    return merged


def apply_aliases(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; where the new name exists its empty cells take the old column's value."""
    names, values = list(df.columns), {c: ref(c) for c in df.columns}
    for old, new in mapping.items():
        if old not in values:
            continue
        if new not in values:
            names.append(new)
            values[new] = values[old]
        else:
            values[new] = F.coalesce(F.nullif(values[new], F.lit("")), F.nullif(values[old], F.lit("")))
        if old != new:
            names.remove(old)
            del values[old]
    return df.select(*[values[name].alias(name) for name in names])
