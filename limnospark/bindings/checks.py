"""Validation and audit. A measurement is an order, its points are the order's lines.

Orders divisible by 97 have no key, so one null key collects many rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import query, rnd, rounded, table
from limnospark.operators.choose import rows_of_duplicate_keys
from limnospark.plans import audit, validation

KEYS = ("instrument", "okey")

SUMMARY_SQL = """
summary AS (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN 'flowtracker' WHEN 1 THEN 'molinete' ELSE 'nivus' END AS instrument,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS okey,
         o_totalprice / 1000 AS q_total_m3s, o_totalprice AS q_total_ls,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 50 END AS area_total_m2
  FROM orders)
"""
POINTS_SQL = """
points AS (
  SELECT CASE l_orderkey % 3 WHEN 0 THEN 'flowtracker' WHEN 1 THEN 'molinete' ELSE 'nivus' END AS instrument,
         CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey END AS okey, l_linenumber AS point_index,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS q_m3s,
         CASE WHEN l_discount > 0 THEN l_extendedprice END AS q_ls, l_quantity * l_tax AS area_m2,
         l_quantity AS depth_m
  FROM lineitem)
"""


def _instrument(key):
    return F.when(key % 3 == 0, "flowtracker").when(key % 3 == 1, "molinete").otherwise("nivus")


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        _instrument(F.col("o_orderkey")).alias("instrument"),
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderkey")).alias("okey"),
        (F.col("o_totalprice") / 1000).alias("q_total_m3s"), F.col("o_totalprice").alias("q_total_ls"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 50).alias("area_total_m2"),
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        _instrument(F.col("l_orderkey")).alias("instrument"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")).alias("okey"), F.col("l_linenumber").alias("point_index"),
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 1000).alias("q_m3s"),
        F.when(F.col("l_discount") > 0, price).alias("q_ls"), (F.col("l_quantity") * F.col("l_tax")).alias("area_m2"),
        F.col("l_quantity").alias("depth_m"),
    )


HYDRAULIC_SQL = f"""
WITH {SUMMARY_SQL}, {POINTS_SQL},
sums AS (
  SELECT instrument, okey, coalesce(sum(q_m3s), 0) AS q_points_m3s, coalesce(sum(q_ls), 0) AS q_points_ls,
         coalesce(sum(area_m2), 0) AS area_points_m2, count(q_m3s) AS n_points
  FROM points GROUP BY ALL),
merged AS (
  SELECT coalesce(s.instrument, p.instrument) AS instrument, coalesce(s.okey, p.okey) AS okey,
         q_total_m3s, q_total_ls, area_total_m2, q_points_m3s, q_points_ls, area_points_m2, n_points,
         CASE WHEN s.instrument IS NULL THEN 'right_only' WHEN p.instrument IS NULL THEN 'left_only' ELSE 'both' END AS merge,
         q_points_m3s - q_total_m3s AS q_diff_m3s, q_points_ls - q_total_ls AS q_diff_ls,
         (q_points_m3s - q_total_m3s) / q_total_m3s * 100 AS q_rel_diff_pct,
         area_points_m2 - area_total_m2 AS area_diff_m2,
         (area_points_m2 - area_total_m2) / area_total_m2 * 100 AS area_rel_diff_pct
  FROM summary s FULL JOIN sums p ON s.instrument = p.instrument AND s.okey IS NOT DISTINCT FROM p.okey),
flagged AS (
  SELECT *, coalesce(abs(q_rel_diff_pct) <= 50, false) AS q_ok, coalesce(abs(area_rel_diff_pct) <= 90, false) AS area_ok
  FROM merged),
report AS (
  SELECT *, CASE WHEN merge <> 'both' THEN 'missing_pair' WHEN q_ok AND area_ok THEN 'ok' ELSE 'inconsistent' END AS status
  FROM flagged)
"""


def hydraulic_report(spark: SparkSession, sf: str) -> DataFrame:
    return validation.hydraulic_consistency(summary(spark, sf), points(spark, sf), KEYS, 50.0, 90.0)


@query("hydraulic_consistency", HYDRAULIC_SQL + f"""
SELECT instrument, okey, merge, status, n_points, q_ok, area_ok,
       {rnd('q_total_m3s', 9)} AS q_total_m3s, {rnd('q_points_m3s', 9)} AS q_points_m3s, {rnd('q_diff_m3s', 9)} AS q_diff_m3s,
       {rnd('q_diff_ls', 3)} AS q_diff_ls, {rnd('q_rel_diff_pct')} AS q_rel_diff_pct,
       {rnd('area_diff_m2')} AS area_diff_m2, {rnd('area_rel_diff_pct')} AS area_rel_diff_pct
FROM report""")
def hydraulic_consistency(spark: SparkSession, sf: str) -> DataFrame:
    report = hydraulic_report(spark, sf).select(
        "instrument", "okey", "merge", "status", "n_points", "q_ok", "area_ok", "q_total_m3s", "q_points_m3s", "q_diff_m3s",
        "q_diff_ls", "q_rel_diff_pct", "area_diff_m2", "area_rel_diff_pct")
    return rounded(report, {"q_total_m3s": 9, "q_points_m3s": 9, "q_diff_m3s": 9, "q_diff_ls": 3, "q_rel_diff_pct": 4,
                            "area_diff_m2": 4, "area_rel_diff_pct": 4})


@query("hydraulic_failing_counts", HYDRAULIC_SQL + """
SELECT instrument, count(*) AS n_rows, count(*) FILTER (status <> 'ok') AS n_not_ok,
       count(*) FILTER (NOT q_ok) AS n_q_fail, count(*) FILTER (NOT area_ok) AS n_area_fail
FROM report GROUP BY instrument""")
def hydraulic_failing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return validation.failing_counts(hydraulic_report(spark, sf))


def by_check(name: str) -> str:
    """Enough digits to keep a sum's exact decimals: nine for cubic metres, two for litres."""
    return f"""CASE WHEN "check" = 'q_ls' THEN {rnd(name, 2)} ELSE {rnd(name, 9)} END"""


@query("hydraulic_audit", f"""
WITH {SUMMARY_SQL}, {POINTS_SQL},
kept AS (SELECT DISTINCT instrument, okey, point_index, depth_m, area_m2, q_m3s, q_ls FROM points),
sums AS (SELECT instrument, okey, sum(q_m3s) AS a, sum(q_ls) AS b, sum(area_m2) AS c, true AS found FROM kept GROUP BY ALL),
merged AS (
  SELECT s.*, a, b, c, found FROM summary s LEFT JOIN sums p ON s.instrument = p.instrument AND s.okey IS NOT DISTINCT FROM p.okey),
long AS (
  SELECT instrument, okey, found, 'q_m3s' AS "check", q_total_m3s AS summary_value, a AS points_sum, 5e-4 AS tol FROM merged
  UNION ALL SELECT instrument, okey, found, 'q_ls', q_total_ls, b, 0.5 FROM merged
  UNION ALL SELECT instrument, okey, found, 'area_m2', area_total_m2, c, 1e-3 FROM merged),
scored AS (
  SELECT *, summary_value - points_sum AS gap, abs(points_sum - summary_value) / greatest(abs(summary_value), tol) * 100 AS pct FROM long)
SELECT instrument, okey, "check", CASE WHEN found THEN 'both' ELSE 'left_only' END AS merge_status,
       {rnd('summary_value', 9)} AS summary_value, {by_check('points_sum')} AS points_sum, {by_check('gap')} AS diff_abs, {rnd('pct')} AS diff_pct,
       CASE WHEN summary_value IS NULL OR points_sum IS NULL THEN 'missing_values'
            WHEN abs(gap) <= tol OR pct <= 40 THEN 'ok' ELSE 'mismatch' END AS status
FROM scored""")
def hydraulic_audit(spark: SparkSession, sf: str) -> DataFrame:
    same = (*KEYS, "point_index", "depth_m", "area_m2", "q_m3s", "q_ls")
    report = audit.audit_hydraulics(summary(spark, sf), points(spark, sf), KEYS, 40.0, same).select(
        *KEYS, "check", "merge_status", "summary_value", "points_sum",
        F.col("diff_abs_summary_minus_points").alias("diff_abs"), "diff_pct", "status")
    litres = F.col("check") == "q_ls"
    exact = {c: F.when(litres, F.round(c, 2)).otherwise(F.round(c, 9)) + 0.0 for c in ("points_sum", "diff_abs")}
    return rounded(report, {"summary_value": 9, "diff_pct": 4}).withColumns(exact)


@query("points_dropped", f"""
WITH {POINTS_SQL}, counts AS (SELECT instrument, okey, point_index, depth_m, count(*) AS n FROM points GROUP BY ALL)
SELECT instrument, CAST(sum(n) AS BIGINT) AS points_rows_raw, count(*) AS points_rows_after_dedup,
       CAST(sum(n) - count(*) AS BIGINT) AS points_rows_dropped_as_duplicates
FROM counts GROUP BY instrument""")
def points_dropped(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dropped_points(points(spark, sf), ("instrument",), (*KEYS, "point_index", "depth_m"))


@query("duplicates_report", """
SELECT 'Summary' AS "table", 'duplicate' AS status, o_custkey AS k1, CAST(o_orderdate AS DATE)::VARCHAR AS k2, count(*) AS duplicate_count
FROM orders GROUP BY ALL HAVING count(*) > 1
UNION ALL
SELECT 'Points', 'duplicate', l_orderkey, l_linenumber::VARCHAR, count(*) FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicates_report(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "Summary": table(spark, sf, "orders").select(F.col("o_custkey").alias("k1"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("k2")),
        "Points": table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("string").alias("k2")),
    }
    return validation.duplicates(tables, ("k1", "k2")).select("table", "status", "k1", "k2", "duplicate_count")


@query("duplicate_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rows_of_duplicate_keys(rows, ["l_orderkey", "l_linenumber"])


@query("duplicates_audit", """
WITH counts AS (
  SELECT l_returnflag AS instrument, l_orderkey, l_suppkey, l_shipdate, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'Points' AS "group", instrument, CASE WHEN count(*) FILTER (n > 1) > 0 THEN 'duplicates' ELSE 'ok' END AS status,
       CAST(sum(n) AS BIGINT) AS n_rows, 'instrument;station_id;measurement_date;measurement_time;point_index' AS key_columns_used,
       CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS n_duplicated_rows, count(*) FILTER (n > 1) AS n_duplicate_keys
FROM counts GROUP BY instrument""")
def duplicates_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("instrument"), F.col("l_orderkey").alias("station_id"), F.col("l_shipdate").alias("measurement_date"),
        F.col("l_suppkey").alias("measurement_time"), F.col("l_linenumber").alias("point_index"))
    return audit.audit_duplicates(rows, "Points")


@query("completeness_report", f"""
WITH o AS (SELECT nullif(o_orderstatus, 'P') AS a, CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE o_orderpriority END AS b FROM orders),
     l AS (SELECT nullif(l_discount, 0) AS c, l_quantity AS d FROM lineitem),
     r AS (
  SELECT 'Summary' AS "table", 'status' AS "column", count(*) AS n_rows, count(*) FILTER (a IS NULL OR trim(a) = '') AS n_missing FROM o
  UNION ALL SELECT 'Summary', 'priority', count(*), count(*) FILTER (b IS NULL OR trim(b) = '') FROM o
  UNION ALL SELECT 'Summary', 'absent', count(*), NULL FROM o
  UNION ALL SELECT 'Points', 'discount', count(*), count(*) FILTER (c IS NULL) FROM l
  UNION ALL SELECT 'Points', 'quantity', count(*), count(*) FILTER (d IS NULL) FROM l)
SELECT "table", "column", n_rows, n_missing, {rnd('n_missing * 100.0 / n_rows')} AS missing_pct,
       CASE WHEN n_missing IS NULL THEN 'missing_column' WHEN n_missing = 0 THEN 'ok' ELSE 'has_missing' END AS status FROM r""")
def completeness_report(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "Summary": table(spark, sf, "orders").select(
            F.nullif("o_orderstatus", F.lit("P")).alias("status"),
            F.when(F.col("o_orderkey") % 10 == 0, " ").otherwise(F.col("o_orderpriority")).alias("priority")),
        "Points": table(spark, sf, "lineitem").select(
            F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.col("l_quantity").alias("quantity")),
    }
    critical = {"Summary": ["status", "priority", "absent"], "Points": ["discount", "quantity"]}
    return rounded(validation.completeness(spark, tables, critical), {"missing_pct": 4})


@query("range_violations", f"""
SELECT 'Points' AS "table", l_orderkey AS station_id, 'depth_m' AS "column", {rnd('l_quantity', 2)} AS value, 'max=45' AS rule,
       'out_of_range' AS status FROM lineitem WHERE l_quantity > 45
UNION ALL SELECT 'Points', l_orderkey, 'temperature_c', {rnd('l_tax * 1000 - 10', 2)}, 'min=-5;max=65', 'out_of_range'
  FROM lineitem WHERE l_tax * 1000 - 10 < -5 OR l_tax * 1000 - 10 > 65
UNION ALL SELECT 'Summary', c_custkey, 'area_total_m2', {rnd('c_acctbal', 2)}, 'min=0', 'out_of_range' FROM customer WHERE c_acctbal < 0""")
def range_violations(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "Points": table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("station_id"), F.col("l_quantity").alias("depth_m"), (F.col("l_tax") * 1000 - 10).alias("temperature_c")),
        "Summary": table(spark, sf, "customer").select(F.col("c_custkey").alias("station_id"), F.col("c_acctbal").alias("area_total_m2")),
    }
    rules = {"Points": {"depth_m": {"max": 45}, "temperature_c": {"min": -5, "max": 65}}, "Summary": {"area_total_m2": {"min": 0}}}
    return rounded(validation.range_violations(tables, rules), {"value": 2})


@query("range_audit", f"""
WITH l AS (SELECT event_type AS instrument, value - 5 AS area_m2, value AS temperature_c, value - 20 AS q_m3s FROM events),
r AS (
  SELECT instrument, 'area_m2' AS "column", 'range' AS rule, 'error' AS severity, area_m2 AS v, area_m2 < 0 AS bad FROM l
  UNION ALL SELECT instrument, 'temperature_c', 'range', 'warning', temperature_c, temperature_c < -5 OR temperature_c > 45 FROM l
  UNION ALL SELECT instrument, 'q_m3s', 'negative_flow_observed', 'info', q_m3s, q_m3s < 0 FROM l)
SELECT instrument, "column", rule, severity, count(*) AS n_rows, count(*) FILTER (bad) AS n_flagged, {rnd('min(v)', 2)} AS min_value,
       {rnd('max(v)', 2)} AS max_value, CASE WHEN count(*) FILTER (bad) > 0 THEN 'flagged' ELSE 'ok' END AS status
FROM r GROUP BY ALL""")
def range_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("instrument"), (F.col("value") - 5).alias("area_m2"), F.col("value").alias("temperature_c"),
        (F.col("value") - 20).alias("q_m3s"))
    return rounded(audit.audit_ranges(rows), {"min_value": 2, "max_value": 2})


@query("unit_consistency", f"""
WITH l AS (
  SELECT l_returnflag AS instrument, l_extendedprice AS m, l_extendedprice * 1000 * (1 + l_linenumber / 200.0) AS s,
         nullif(l_quantity, 1) AS m2, l_quantity * 1000 AS s2 FROM lineitem),
r AS (SELECT instrument, 'q_total_m3s_to_q_total_ls' AS "check", abs(s - m * 1000) / greatest(abs(m * 1000), 1e-9) * 100 AS gap FROM l
      UNION ALL SELECT instrument, 'q_m3s_to_q_ls', abs(s2 - m2 * 1000) / greatest(abs(m2 * 1000), 1e-9) * 100 FROM l)
SELECT instrument, "check", count(*) AS n_rows, count(gap) AS n_checked, count(*) FILTER (gap > 1.2) AS n_mismatch,
       {rnd('max(gap)')} AS max_diff_pct, CASE WHEN count(*) FILTER (gap > 1.2) > 0 THEN 'mismatch' ELSE 'ok' END AS status
FROM r GROUP BY ALL""")
def unit_consistency(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("instrument"), price.alias("q_total_m3s"),
        (price * 1000 * (1 + F.col("l_linenumber") / 200.0)).alias("q_total_ls"),
        F.nullif("l_quantity", F.lit(1.0)).alias("q_m3s"), (F.col("l_quantity") * 1000).alias("q_ls"))
    return rounded(audit.audit_units(rows, tolerance_pct=1.2), {"max_diff_pct": 4})


@query("columns_audit", """
SELECT 'normalized' AS stage, 'Summary' AS "group", o_orderstatus AS instrument, count(*) AS n_rows, 'missing_columns' AS status,
       'station_code;measurement_time;source_file;source_run_dir;run_id;area_total_m2' AS missing_columns,
       concat_ws(';', CASE WHEN count(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) = 0 THEN 'station_name' END,
                      CASE WHEN count(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END) = 0 THEN 'q_total_ls' END) AS empty_expected_columns
FROM orders GROUP BY o_orderstatus""")
def columns_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("instrument"), F.col("o_custkey").alias("station_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("station_name"),
        F.col("o_orderdate").alias("measurement_date"), F.col("o_totalprice").alias("q_total_m3s"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("q_total_ls"))
    return audit.audit_columns(rows, "normalized", "Summary").select(
        "stage", "group", "instrument", "n_rows", "status", "missing_columns", "empty_expected_columns")


@query("validation_suite", HYDRAULIC_SQL + """,
counts AS (
  SELECT 'required_columns' AS "check", 4 AS n_rows, 1 AS bad
  UNION ALL SELECT 'duplicates', count(*), count(*) FROM (
    SELECT instrument, okey FROM summary GROUP BY ALL HAVING count(*) > 1
    UNION ALL SELECT instrument, okey FROM points GROUP BY ALL HAVING count(*) > 1)
  UNION ALL SELECT 'completeness', 2, (SELECT CASE WHEN count(*) FILTER (okey IS NULL) > 0 THEN 1 ELSE 0 END FROM summary)
  UNION ALL SELECT 'ranges', count(*), count(*) FROM points WHERE depth_m > 49
  UNION ALL SELECT 'hydraulic_consistency', count(*), count(*) FILTER (status <> 'ok') FROM report)
SELECT "check", CASE WHEN bad > 0 THEN 'issues_found' ELSE 'ok' END AS status, CAST(n_rows AS BIGINT) AS n_rows FROM counts""")
def validation_suite(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"Summary": summary(spark, sf), "Points": points(spark, sf)}
    config = {
        "keys": KEYS, "required_columns": {"Summary": ["okey", "q_total_m3s", "station_name"], "Points": ["q_m3s"]},
        "completeness": {"critical_columns": {"Summary": ["okey", "instrument"]}}, "ranges": {"Points": {"depth_m": {"max": 49}}},
        "hydraulic_consistency": {"q_tolerance_pct": 50, "area_tolerance_pct": 90},
    }
    return validation.run_suite(spark, tables, config)["summary"].select("check", "status", "n_rows")


@query("sheet_crosscheck", f"""
WITH p AS (
  SELECT l_orderkey AS station_id, count(*) AS n, sum(l_extendedprice) AS q, sum(l_quantity) AS a, avg(l_quantity) AS d,
         sum(l_discount * 100) AS share, list_sort(list(l_quantity), 'DESC') AS ws FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey AS station_id, o_orderkey % 7 AS n, o_totalprice AS q, o_totalprice / 1000 AS a, 1000.0 AS v,
             25.5 AS d, 60.0 AS w FROM orders),
m AS (SELECT s.*, p.n AS pn, p.q AS pq, p.a AS pa, p.d AS pd, p.share, CASE WHEN len(ws) > 1 THEN ws[1] + 0.5 * (ws[1] - ws[2]) END AS pw,
             p.station_id IS NOT NULL AS found FROM s LEFT JOIN p USING (station_id)),
t AS (SELECT *, abs(pq - q) / abs(q) * 100 AS qp, abs(pa - a) / abs(a) * 100 AS ap FROM m),
u AS (SELECT *, CASE WHEN NOT found THEN 'Missing Points file' ELSE concat_ws(' | ',
        CASE WHEN n <> pn THEN 'n_points mismatch' END,
        CASE WHEN qp > 1 THEN 'q_m3s Summary != sum Points q_m3s' END,
        CASE WHEN ap > 1 THEN 'area_m2 Summary != sum Points area_m2' END,
        CASE WHEN abs(v - q / a) > 0.01 THEN 'vel_media_ms != q_m3s/area_m2' END,
        CASE WHEN abs(d - pd) > 0.001 THEN 'prof_media_m mismatch' END,
        CASE WHEN abs(w - pw) > 0.001 THEN 'ancho_m mismatch' END,
        CASE WHEN share NOT BETWEEN 99 AND 101 THEN 'q_percent sum not near 100' END) END AS warnings FROM t)
SELECT station_id, pn AS n_points_points, {rnd('pq', 2)} AS q_points_sum, {rnd('qp')} AS q_diff_pct, {rnd('abs(w - pw)')} AS ancho_diff_abs,
       {rnd('abs(d - pd)')} AS prof_media_diff_abs, warnings, CASE WHEN warnings = '' THEN 'OK' ELSE 'CHECK' END AS status FROM u""")
def sheet_crosscheck(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("station_id"), (F.col("o_orderkey") % 7).alias("n_points"), F.col("o_totalprice").alias("q_m3s"),
        (F.col("o_totalprice") / 1000).alias("area_m2"), F.lit(1000.0).alias("vel_media_ms"), F.lit(25.5).alias("prof_media_m"),
        F.lit(60.0).alias("ancho_m"))
    p = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("station_id"), F.col("l_extendedprice").alias("q_m3s"), F.col("l_quantity").alias("area_m2"),
        F.col("l_quantity").alias("prof_m"), F.col("l_quantity").alias("progr_m"), (F.col("l_discount") * 100).alias("q_percent"))
    report = audit.sheet_crosscheck(s, p, ("station_id",)).select(
        "station_id", "n_points_points", "q_points_sum", "q_diff_pct", "ancho_diff_abs", "prof_media_diff_abs", "warnings", "status")
    return rounded(report, {"q_points_sum": 2, "q_diff_pct": 4, "ancho_diff_abs": 4, "prof_media_diff_abs": 4})


@query("run_stats", """
SELECT source AS "group", lang, count(DISTINCT doc_id % 50) AS n_files, count(*) AS n_rows,
       count(DISTINCT CASE WHEN n_chars > 5000 THEN doc_id % 50 END) AS n_rejected
FROM documents GROUP BY ALL""")
def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("source").alias("group"), "lang", (F.col("doc_id") % 50).alias("file"), "n_chars")
    return audit.ingest_stats(docs, ("group", "lang"), "file", docs.where("n_chars > 5000"))


@query("status_counts", HYDRAULIC_SQL + """
SELECT 'status.' || status AS metric, count(*) AS value FROM report GROUP BY 1""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.status_counts(hydraulic_report(spark, sf))
