"""Audit reports over whole layers: columns, duplicates, hydraulics, units, ranges, ingest runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions.numbers import number_of, relative_difference, relative_difference_floor
from limnospark.operators.choose import top_two, value_counts
from limnospark.operators.groups import null_safe_join
from limnospark.operators.specs import RAW_TRACE_COLUMNS, TRACE_COLUMNS, ref
from limnospark.plans.validation import MEASUREMENT_KEYS

# Extra key columns tried per group, expected columns, tolerances and range rules.
GROUP_KEYS = {"Summary": (), "Points": ("point_index", "distance_m"), "Sections": ("section_index", "section_id", "distance_m"), "Gates": ()}
SUMMARY_EXPECTED = (*TRACE_COLUMNS, "q_total_m3s", "q_total_ls", "area_total_m2")
POINTS_EXPECTED = (*TRACE_COLUMNS, "point_index", "distance_m", "depth_m", "area_m2", "q_m3s", "q_ls")
SAME_POINT_COLUMNS = (*MEASUREMENT_KEYS, "point_index", "distance_m", "depth_m", "area_m2", "q_m3s", "q_ls")
TOLERANCE_PCT = 1.0
SMALLEST_TOLERANCE = 1e-9
CHECKS = (
    ("q_m3s", "q_total_m3s", "q_m3s", 5e-4), ("q_ls", "q_total_ls", "q_ls", 0.5), ("area_m2", "area_total_m2", "area_m2", 1e-3),
)
RANGE_RULES = {
    "area_total_m2": {"min": 0, "severity": "error"}, "area_m2": {"min": 0, "severity": "error"},
    "depth_mean_m": {"min": 0, "severity": "error"}, "depth_m": {"min": 0, "severity": "error"},
    "temperature_c": {"min": -5, "max": 45, "severity": "warning"},
    "q_total_m3s": {"severity": "info"}, "q_m3s": {"severity": "info"},
}
UNIT_PAIRS = (("q_total_m3s", "q_total_ls"), ("q_m3s", "q_ls"))


def expected_columns(stage: str, group: str) -> Sequence[str]:
    if stage == "raw_canonical":
        return RAW_TRACE_COLUMNS
    return {"Summary": SUMMARY_EXPECTED, "Points": POINTS_EXPECTED}.get(group, TRACE_COLUMNS)


def audit_columns(df: DataFrame, stage: str, group: str, by: Sequence[str] = ("instrument",)) -> DataFrame:
    """Missing and all-empty expected columns per table part; one aggregation."""
    expected = expected_columns(stage, group)
    present = [c for c in expected if c in df.columns]
    missing = [c for c in expected if c not in df.columns]
    filled = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(ref(c)).alias(f"f{i}") for i, c in enumerate(present)]
    )
    empty = F.concat_ws(";", *[F.when(F.col(f"f{i}") == 0, F.lit(c)) for i, c in enumerate(present)])
    return filled.select(
        F.lit(stage).alias("stage"), F.lit(group).alias("group"), *by, "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        F.lit("missing_columns" if missing else "ok").alias("status"), F.lit(";".join(missing)).alias("missing_columns"),
        empty.alias("empty_expected_columns"), F.lit(";".join(df.columns)).alias("columns"),
    )


def trace_missing(df: DataFrame) -> list[str]:
    """Trace columns a raw table lacks."""
    return [c for c in RAW_TRACE_COLUMNS if c not in df.columns]


def duplicate_key(columns: Sequence[str], group: str) -> tuple[list[str], list[str]]:
    """Key columns of a group, and the ones it should have but lacks."""
    missing = [c for c in MEASUREMENT_KEYS if c not in columns]
    if missing:
        return [], missing
    extra = next((c for c in GROUP_KEYS.get(group, ()) if c in columns), None)
    if extra:
        return [*MEASUREMENT_KEYS, extra], []
    return list(MEASUREMENT_KEYS), list(GROUP_KEYS.get(group, ()))


def audit_duplicates(df: DataFrame, group: str, by: Sequence[str] = ("instrument",)) -> DataFrame:
    """Duplicated rows and keys per part of a table. Gates have no reliable key and are only counted."""
    keys, missing = duplicate_key(df.columns, group)
    if group == "Gates" or missing:
        status = "not_checked" if group == "Gates" else ("missing_group_key_columns" if keys else "missing_key_columns")
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(group).alias("group"), *by, F.lit(status).alias("status"), "n_rows",
            F.lit(";".join(missing)).alias("missing_key_columns"))
    counts = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("n") > 1
    report = counts.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(repeated, F.col("n")).otherwise(0)).alias("n_duplicated_rows"),
        F.count_if(repeated).alias("n_duplicate_keys"),
    )
    return report.select(
        F.lit(group).alias("group"), *by, F.when(F.col("n_duplicate_keys") > 0, "duplicates").otherwise("ok").alias("status"),
        "n_rows", F.lit(";".join(keys)).alias("key_columns_used"), "n_duplicated_rows", "n_duplicate_keys",
    )


def audit_hydraulics(
    summary: DataFrame, points: DataFrame, keys: Sequence[str] = MEASUREMENT_KEYS,
    tolerance_pct: float = TOLERANCE_PCT, same_point: Sequence[str] = SAME_POINT_COLUMNS,
) -> DataFrame:
    """One row per measurement and check; a gap passes by its absolute or its percent tolerance.

    Repeated Points rows are dropped first; sums of only missing values stay missing.
    """
    subset = [c for c in same_point if c in points.columns]
    usable = [c for c in CHECKS if c[1] in summary.columns and c[2] in points.columns]
    narrow = points.select(*[ref(c) for c in dict.fromkeys([*keys, *subset, *[c[2] for c in usable]])])
    kept = narrow.dropDuplicates(subset) if subset else narrow
    if not usable:
        raise ValueError("no comparable columns")
    sums = kept.groupBy(*keys).agg(
        *[F.sum(number_of(kept, p)).alias(f"sum_{name}") for name, _, p, _ in usable], F.lit(True).alias("__in")
    )
    merged = null_safe_join(
        summary.select(*[ref(k) for k in keys], *[number_of(summary, s).alias(s) for _, s, _, _ in usable]), sums, keys, "left"
    )
    entries = [
        F.struct(F.lit(name).alias("check"), F.lit(s).alias("summary_column"), F.lit(p).alias("points_column"),
                 F.col(s).alias("summary_value"), F.col(f"sum_{name}").alias("points_sum"),
                 F.lit(max(tol, SMALLEST_TOLERANCE)).alias("abs_tolerance"))
        for name, s, p, tol in usable
    ]
    long = merged.select(
        *[ref(k) for k in keys], F.when(F.col("__in"), "both").otherwise("left_only").alias("merge_status"),
        F.inline(F.array(*entries)),
    )
    gap = F.col("summary_value") - F.col("points_sum")
    percent = relative_difference_floor(F.col("points_sum"), F.col("summary_value"), F.col("abs_tolerance"))
    long = long.withColumns({"diff_abs_summary_minus_points": gap, "diff_pct": percent, "tolerance_pct": F.lit(float(tolerance_pct))})
    long = long.withColumns({
        "within_abs_tolerance": F.abs("diff_abs_summary_minus_points") <= F.col("abs_tolerance"),
        "within_pct_tolerance": F.col("diff_pct") <= F.col("tolerance_pct"),
    })
    status = (
        F.when(F.col("summary_value").isNull() | F.col("points_sum").isNull(), "missing_values")
        .when(F.col("within_abs_tolerance") | F.col("within_pct_tolerance"), "ok").otherwise("mismatch")
    )
    return long.withColumn("status", status)


def dropped_points(points: DataFrame, by: Sequence[str] = ("instrument",), same_point: Sequence[str] = SAME_POINT_COLUMNS) -> DataFrame:
    """Points rows before and after repeated rows are dropped, per instrument."""
    subset = [c for c in same_point if c in points.columns]
    counts = points.groupBy(*dict.fromkeys([*by, *subset])).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by).agg(
        F.sum("n").alias("points_rows_raw"), F.count(F.lit(1)).alias("points_rows_after_dedup"),
        (F.sum("n") - F.count(F.lit(1))).alias("points_rows_dropped_as_duplicates"),
    )


def audit_units(
    df: DataFrame, by: Sequence[str] = ("instrument",), pairs: Sequence[tuple[str, str]] = UNIT_PAIRS,
    tolerance_pct: float = TOLERANCE_PCT,
) -> DataFrame:
    """Cubic-metre against litre columns: rows compared, mismatches and the largest gap."""
    usable = [(m, l) for m, l in pairs if m in df.columns and l in df.columns]
    entries = [F.struct(F.lit(f"{m}_to_{l}").alias("check"), number_of(df, m).alias("m3s"), number_of(df, l).alias("ls")) for m, l in usable]
    long = df.select(*by, F.inline(F.array(*entries)))
    gap = relative_difference_floor(F.col("ls"), F.col("m3s") * 1000.0, SMALLEST_TOLERANCE)
    report = long.withColumn("gap", gap).groupBy(*by, "check").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("gap").alias("n_checked"),
        F.count_if(F.col("gap") > tolerance_pct).alias("n_mismatch"), F.max("gap").alias("max_diff_pct"),
    )
    return report.withColumn("status", F.when(F.col("n_mismatch") > 0, "mismatch").otherwise("ok"))


def audit_ranges(df: DataFrame, by: Sequence[str] = ("instrument",), rules: Mapping[str, Mapping] = RANGE_RULES) -> DataFrame:
    """Flagged rows and value span per rule column; negative flows are information only."""
    present = {c: r for c, r in rules.items() if c in df.columns}

    def flagged(value: Column, column: str, rule: Mapping) -> Column:
        if column.startswith("q"):
            return value < 0
        test = F.lit(False)
        if "min" in rule:
            test = test | (value < float(rule["min"]))
        if "max" in rule:
            test = test | (value > float(rule["max"]))
        return test

    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit("negative_flow_observed" if c.startswith("q") else "range").alias("rule"),
            F.lit("info" if c.startswith("q") else r.get("severity", "warning")).alias("severity"),
            number_of(df, c).alias("v"), F.coalesce(flagged(number_of(df, c), c, r), F.lit(False)).alias("bad"),
        )
        for c, r in present.items()
    ]
    long = df.select(*by, F.inline(F.array(*entries)))
    report = long.groupBy(*by, "column", "rule", "severity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("bad").alias("n_flagged"), F.min("v").alias("min_value"), F.max("v").alias("max_value"),
    )
    return report.withColumn("status", F.when(F.col("n_flagged") > 0, "flagged").otherwise("ok"))


def sheet_crosscheck(
    summary: DataFrame, points: DataFrame, keys: Sequence[str] = ("station_id", "measurement_date", "measurement_time")
) -> DataFrame:
    """Sheet totals against their verticals, with all warnings of a measurement in one text.

    Summary needs `n_points, q_m3s, area_m2, vel_media_ms, prof_media_m, ancho_m`; Points
    `q_m3s, area_m2, prof_m, progr_m, q_percent`.
    """
    p = points.select(*[ref(k) for k in keys], *[number_of(points, c).alias(c) for c in ("q_m3s", "area_m2", "prof_m", "progr_m", "q_percent")])
    sums = p.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points_points"),
        F.coalesce(F.sum("q_m3s"), F.lit(0.0)).alias("q_points_sum"), F.coalesce(F.sum("area_m2"), F.lit(0.0)).alias("area_points_sum"),
        F.avg("prof_m").alias("prof_media_calc"), F.coalesce(F.sum("q_percent"), F.lit(0.0)).alias("q_percent_sum"),
        F.count_if(F.col("progr_m").isNull()).alias("__no_progr"), F.count_if(F.col("prof_m").isNull()).alias("__no_prof"),
        F.count_if(F.col("q_m3s") < 0).alias("__neg_q"), F.count_if(F.col("area_m2") < 0).alias("__neg_area"),
    )
    widths = top_two(p, keys, "progr_m").select(*keys, (F.col("largest") + 0.5 * (F.col("largest") - F.col("second"))).alias("ancho_calc"))
    per_key = null_safe_join(sums, widths, keys, "left")
    s = summary.select(
        *[ref(k) for k in keys],
        *[number_of(summary, c).alias(a) for c, a in (
            ("n_points", "n_points_summary"), ("q_m3s", "q_summary"), ("area_m2", "area_summary"), ("vel_media_ms", "vel_summary"),
            ("prof_media_m", "prof_media_summary"), ("ancho_m", "ancho_summary"))],
    )
    m = null_safe_join(s, per_key.withColumn("__in", F.lit(True)), keys, "left")
    m = m.withColumn("vel_calc", F.try_divide(F.col("q_summary"), F.col("area_summary")))
    m = m.withColumns({
        "q_diff_abs": F.abs(F.col("q_summary") - F.col("q_points_sum")),
        "q_diff_pct": relative_difference(F.col("q_summary"), F.col("q_points_sum")),
        "area_diff_abs": F.abs(F.col("area_summary") - F.col("area_points_sum")),
        "area_diff_pct": relative_difference(F.col("area_summary"), F.col("area_points_sum")),
        "vel_diff_abs": F.abs(F.col("vel_summary") - F.col("vel_calc")),
        "prof_media_diff_abs": F.abs(F.col("prof_media_summary") - F.col("prof_media_calc")),
        "ancho_diff_abs": F.abs(F.col("ancho_summary") - F.col("ancho_calc")),
    })
    # Limits and texts of the warnings.
    warnings = [
        (F.coalesce(F.col("n_points_summary") != F.col("n_points_points"), F.lit(True)), "n_points mismatch"),
        (F.col("q_diff_pct") > 1, "q_m3s Summary != sum Points q_m3s"),
        (F.col("area_diff_pct") > 1, "area_m2 Summary != sum Points area_m2"),
        (F.col("vel_diff_abs") > 0.01, "vel_media_ms != q_m3s/area_m2"),
        (F.col("prof_media_diff_abs") > 0.001, "prof_media_m mismatch"),
        (F.col("ancho_diff_abs") > 0.001, "ancho_m mismatch"),
        (~F.col("q_percent_sum").between(99, 101), "q_percent sum not near 100"),
        (F.col("__no_progr") > 0, "empty progr_m"), (F.col("__no_prof") > 0, "empty prof_m"),
        (F.col("__neg_q") > 0, "negative q_m3s"), (F.col("__neg_area") > 0, "negative area_m2"),
    ]
    text = F.when(F.col("__in"), F.concat_ws(" | ", *[F.when(test, F.lit(name)) for test, name in warnings])).otherwise("Missing Points file")
    m = m.withColumn("warnings", text)
    return m.withColumn("status", F.when(F.col("warnings") == "", "OK").otherwise("CHECK")).drop(
        "__in", "__no_progr", "__no_prof", "__neg_q", "__neg_area")


def ingest_stats(df: DataFrame, by: Sequence[str] = ("group",), file: str = "file", rejected: DataFrame | None = None) -> DataFrame:
    """Files and rows per group, and how many files were rejected."""
    stats = df.groupBy(*by).agg(F.count_distinct(file).alias("n_files"), F.count(F.lit(1)).alias("n_rows"))
    if rejected is None:
        return stats
    bad = rejected.groupBy(*by).agg(F.count_distinct(file).alias("n_rejected"))
    return stats.join(bad, list(by), "left").withColumn("n_rejected", F.coalesce("n_rejected", F.lit(0)))


def status_counts(report: DataFrame) -> DataFrame:
    return value_counts(report, {"status": "status"})
