"""Validation reports over normalized tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from limnospark.functions.numbers import number_of
from limnospark.operators.choose import duplicate_keys
from limnospark.operators.groups import null_safe_join
from limnospark.operators.specs import RAW_TRACE_COLUMNS, ref

MEASUREMENT_KEYS = ("instrument", "station_id", "measurement_date", "measurement_time")
# Report statuses that count as a finding.
BAD_STATUSES = (
    "missing_table", "missing_column", "missing_columns", "missing_key_columns", "duplicate", "has_missing",
    "out_of_range", "missing_pair", "inconsistent",
)
CHECKS = ("required_columns", "duplicates", "completeness", "ranges", "hydraulic_consistency")
Tables = Mapping[str, DataFrame | None]


def required_columns(spark: SparkSession, tables: Tables, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per required column. Only schemas are looked at."""
    rows = []
    for table, columns in required.items():
        df = tables.get(table)
        if df is None:
            rows.append((table, None, "missing_table", f"Missing table: {table}"))
            continue
        for column in columns:
            found = column in df.columns
            rows.append((table, column, "ok" if found else "missing_column", "" if found else f"Missing column: {column}"))
    return spark.createDataFrame(rows, "table string, column string, status string, message string")


def duplicates(tables: Tables, keys: Sequence[str] = MEASUREMENT_KEYS) -> DataFrame | None:
    """Keys with more than one row, per table; a table without the key columns says so."""
    parts = []
    for table in ("Summary", "Points"):
        df = tables.get(table)
        if df is None:
            continue
        missing = sorted(set(keys) - set(df.columns))
        if missing:
            parts.append(df.sparkSession.range(1).select(
                F.lit(table).alias("table"), F.lit("missing_key_columns").alias("status"),
                F.lit(",".join(missing)).alias("missing_key_columns"),
            ))
        else:
            parts.append(duplicate_keys(df, keys).select(F.lit(table).alias("table"), F.lit("duplicate").alias("status"), "*"))
    return _union(parts)


def _union(parts: Sequence[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def completeness(spark: SparkSession, tables: Tables, critical: Mapping[str, Sequence[str]]) -> DataFrame:
    """Missing count and share per critical column; one aggregation per table."""
    schema = "table string, column string, n_rows bigint, n_missing bigint, missing_pct double, status string"
    parts, rows = [], []
    for table, columns in critical.items():
        df = tables.get(table)
        if df is None:
            rows.append((table, None, None, None, None, "missing_table"))
            continue
        present = [c for c in columns if c in df.columns]
        counts = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(ref(c).isNull() | (F.trim(ref(c).cast("string")) == "")).alias(f"m{i}") for i, c in enumerate(present)],
        )
        entries = [
            F.struct(F.lit(c).alias("column"), (F.col(f"m{present.index(c)}") if c in present else F.lit(None).cast("bigint")).alias("n_missing"))
            for c in columns
        ]
        share = F.coalesce(F.try_divide(F.col("n_missing") * 100.0, F.col("n_rows")), F.lit(0.0))
        status = F.when(F.col("n_missing").isNull(), "missing_column").when(F.col("n_missing") == 0, "ok").otherwise("has_missing")
        parts.append(counts.select("n_rows", F.inline(F.array(*entries))).select(
            F.lit(table).alias("table"), "column", "n_rows", "n_missing",
            F.when(F.col("n_missing").isNotNull(), share).alias("missing_pct"), status.alias("status"),
        ))
    if rows:
        parts.append(spark.createDataFrame(rows, schema))
    return _union(parts)


def _rule_text(rule: Mapping) -> str:
    return ";".join(f"{k}={rule[k]}" for k in ("min", "max") if k in rule)


def _breaks(value: Column, rule: Mapping) -> Column:
    test = F.lit(False)
    if "min" in rule:
        test = test | (value < float(rule["min"]))
    if "max" in rule:
        test = test | (value > float(rule["max"]))
    return F.coalesce(test, F.lit(False))


def range_violations(
    tables: Tables, rules: Mapping[str, Mapping[str, Mapping]], trace: Sequence[str] = RAW_TRACE_COLUMNS
) -> DataFrame | None:
    """One row per broken rule. Each table is read once and never shuffled."""
    parts = []
    for table, table_rules in rules.items():
        df = tables.get(table)
        label = F.lit(table).alias("table")
        if df is None:
            continue
        present = {c: r for c, r in table_rules.items() if c in df.columns}
        gone = [c for c in table_rules if c not in df.columns]
        if gone:
            parts.append(df.sparkSession.range(1).select(
                label, F.explode(F.array(*[F.lit(c) for c in gone])).alias("column"), F.lit("missing_column").alias("status")))
        if not present:
            continue
        entries = [
            F.when(_breaks(number_of(df, c), rule), F.struct(
                F.lit(c).alias("column"), number_of(df, c).alias("value"), F.lit(_rule_text(rule)).alias("rule")))
            for c, rule in present.items()
        ]
        base = [ref(c) for c in trace if c in df.columns]
        found = df.select(*base, F.explode(F.array_compact(F.array(*entries))).alias("e"))
        parts.append(found.select(label, *[ref(c) for c in trace if c in df.columns], "e.*", F.lit("out_of_range").alias("status")))
    return _union(parts)


def hydraulic_consistency(
    summary: DataFrame, points: DataFrame, keys: Sequence[str] = MEASUREMENT_KEYS,
    q_tolerance_pct: float = 1.0, area_tolerance_pct: float = 1.0,
) -> DataFrame:
    """Summary against the sums of its Points, with null keys equal and unmatched sides kept.

    Points are summed before the join. The outer join is a left join plus the Points keys that
    no Summary has, because a left join can be split where one key is hot and a full join cannot.
    """
    sums = points.groupBy(*keys).agg(
        F.coalesce(F.sum(number_of(points, "q_m3s")), F.lit(0.0)).alias("q_points_m3s"),
        F.coalesce(F.sum(number_of(points, "q_ls")), F.lit(0.0)).alias("q_points_ls"),
        F.coalesce(F.sum(number_of(points, "area_m2")), F.lit(0.0)).alias("area_points_m2"),
        F.count(number_of(points, "q_m3s")).alias("n_points"),
    )
    measured = ("q_total_m3s", "q_total_ls", "area_total_m2")
    chosen = summary.select(*[ref(k) for k in keys], *[number_of(summary, c).alias(c) for c in measured])
    left = null_safe_join(chosen, sums.withColumn("__in", F.lit(True)), keys, "left").withColumn(
        "merge", F.when(F.col("__in"), "both").otherwise("left_only")
    ).drop("__in")
    only_points = null_safe_join(sums, summary.select(*[ref(k) for k in keys]).distinct(), keys, "left_anti").withColumn(
        "merge", F.lit("right_only")
    )
    merged = left.unionByName(only_points, allowMissingColumns=True)

    def gap(a: str, b: str) -> Column:
        return F.col(a) - F.col(b)

    merged = merged.withColumns({
        "q_diff_m3s": gap("q_points_m3s", "q_total_m3s"),
        "q_diff_ls": gap("q_points_ls", "q_total_ls"),
        "q_rel_diff_pct": F.try_divide(gap("q_points_m3s", "q_total_m3s"), F.col("q_total_m3s")) * 100.0,
        "area_diff_m2": gap("area_points_m2", "area_total_m2"),
        "area_rel_diff_pct": F.try_divide(gap("area_points_m2", "area_total_m2"), F.col("area_total_m2")) * 100.0,
    })
    merged = merged.withColumns({
        "q_ok": F.coalesce(F.abs("q_rel_diff_pct") <= q_tolerance_pct, F.lit(False)),
        "area_ok": F.coalesce(F.abs("area_rel_diff_pct") <= area_tolerance_pct, F.lit(False)),
    })
    status = F.when(F.col("merge") != "both", "missing_pair").when(F.col("q_ok") & F.col("area_ok"), "ok").otherwise("inconsistent")
    return merged.withColumn("status", status)


def failing_counts(report: DataFrame) -> DataFrame:
    """Rows and failed checks of a hydraulic report per instrument."""
    return report.groupBy("instrument").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("status") != "ok").alias("n_not_ok"),
        F.count_if(~F.col("q_ok")).alias("n_q_fail"), F.count_if(~F.col("area_ok")).alias("n_area_fail"),
    )


def suite_summary(reports: Mapping[str, DataFrame | None]) -> DataFrame | None:
    """One row per check: how many report rows, and whether any is a finding."""
    parts = []
    for check, report in reports.items():
        if report is None:
            continue
        bad = F.count_if(F.col("status").isin(*BAD_STATUSES)) if "status" in report.columns else F.lit(0)
        counted = report.agg(F.count(F.lit(1)).alias("n_rows"), bad.alias("bad"))
        found = F.col("bad") > 0
        parts.append(counted.select(
            F.lit(check).alias("check"), F.when(found, "issues_found").otherwise("ok").alias("status"), "n_rows",
            F.when(found, F.lit(f"{check} generated report rows requiring review.")).otherwise("No issues found.").alias("message"),
        ))
    return _union(parts)


def run_suite(spark: SparkSession, tables: Tables, config: Mapping) -> dict[str, DataFrame | None]:
    """All enabled checks and their summary."""
    keys = config.get("keys", MEASUREMENT_KEYS)
    enabled = {c: (config.get("checks") or {}).get(c, True) for c in CHECKS}
    tolerance = config.get("hydraulic_consistency") or {}

    def hydraulic() -> DataFrame:
        summary, points = tables.get("Summary"), tables.get("Points")
        if summary is None or points is None:
            return spark.createDataFrame([("missing_table", "Summary or Points not found.")], "status string, message string")
        gone_s = [c for c in (*keys, "q_total_m3s", "q_total_ls", "area_total_m2") if c not in summary.columns]
        gone_p = [c for c in (*keys, "q_m3s", "q_ls", "area_m2") if c not in points.columns]
        if gone_s or gone_p:
            return spark.createDataFrame(
                [("missing_columns", ",".join(gone_s), ",".join(gone_p))],
                "status string, missing_summary_columns string, missing_points_columns string")
        return hydraulic_consistency(summary, points, keys, float(tolerance.get("q_tolerance_pct", 1.0)),
                                     float(tolerance.get("area_tolerance_pct", 1.0)))

    jobs = {
        "required_columns": lambda: required_columns(spark, tables, config.get("required_columns") or {}),
        "duplicates": lambda: duplicates(tables, keys),
        "completeness": lambda: completeness(spark, tables, (config.get("completeness") or {}).get("critical_columns") or {}),
        "ranges": lambda: range_violations(tables, config.get("ranges") or {}, config.get("traceability_columns", RAW_TRACE_COLUMNS)),
        "hydraulic_consistency": hydraulic,
    }
    reports = {name: job() for name, job in jobs.items() if enabled[name]}
    reports["summary"] = suite_summary(reports)
    return reports
