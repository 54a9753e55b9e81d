"""Options of the jobs that the other bindings leave at their defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings import consolidation, parsing
from limnospark.bindings.registry import ORACLES, iso, query, rnd, rounded, table
from limnospark.operators.specs import normalize_table
from limnospark.plans import audit, ingest
from limnospark.plans.normalize import fixed_points
from limnospark.sources import dis_text, tables

SPEC = {
    "metadata": {"station_id": {"sources": ["owner"], "overwrite": True}, "station_name": {"sources": ["clerk"], "overwrite": False}, "instrument": {"sources": ["status"]}},
    "columns": {
        "station_id": {"sources": ["key"], "dtype": "string"}, "station_name": {"sources": ["label"], "dtype": "string"}, "price": {"sources": ["price"], "dtype": "float"},
        "day": {"sources": ["day"], "dtype": "date"}, "moment": {"sources": ["moment"], "dtype": "datetime"}, "clock": {"sources": ["clock"], "dtype": "time_hhmmss"},
    },
    "derived": {
        "copied": {"from": "price", "operation": "copy"}, "raised": {"from": "price", "operation": "add", "value": 10},
        "lowered": {"from": "price", "operation": "subtract", "value": 2.5}, "missing": {"from": "absent", "operation": "copy"},
    },
    "required": ["station_id", "price"], "transforms": [{"name": n} for n in ("strip_strings", "numeric_commas_to_dots", "enforce_dtypes")],
}


@query("spec_operations", f"""
SELECT o_custkey::VARCHAR AS station_id, CASE WHEN o_orderkey % 3 = 0 THEN o_clerk ELSE 'L' || o_orderkey END AS station_name, o_orderstatus AS instrument,
       round(o_totalprice, 2) AS price, replace(printf('%.2f', o_totalprice), '.', ',') AS copied, {rnd('round(o_totalprice, 2) + 10', 2)} AS raised, {rnd('round(o_totalprice, 2) - 2.5', 2)} AS lowered,
       NULL::DOUBLE AS missing, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d') || ' 07:08:09' AS moment, '07:08:09' AS clock FROM (SELECT *, 'C' || o_custkey AS o_clerk FROM orders)""")
def spec_operations(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata that overwrites or fills, derived columns by every operation, typed dates and times."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    raw = table(spark, sf, "orders").select(
        k.cast("string").alias("key"), F.col("o_custkey").cast("string").alias("owner"), F.concat(F.lit("C"), F.col("o_custkey")).alias("clerk"), F.col("o_orderstatus").alias("status"),
        F.when(k % 3 != 0, F.concat(F.lit(" L"), k)).alias("label"), F.replace(price, F.lit("."), F.lit(",")).alias("price"), F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd 07:08:09").alias("moment"), F.lit("70809").alias("clock"))
    out = normalize_table(raw, SPEC)
    shown = out.select("station_id", "station_name", "instrument", "price", "copied", "raised", "lowered", F.col("missing").cast("double").alias("missing"),
                       iso("day").alias("day"), F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"), "clock")
    return rounded(shown, {"raised": 2, "lowered": 2})


@query("chosen_runs", f"""
WITH {consolidation.FILES_SQL}, runs AS (SELECT DISTINCT pipeline, run_id FROM files)
SELECT pipeline, run_id FROM runs WHERE right(run_id, 1) <> '7' AND right(run_id, 2) <> '13'""")
def chosen_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs kept by the lists of runs to include and to exclude."""
    runs = tables.list_runs(consolidation._rows(spark, sf).select("csv_path"))
    names = table(spark, sf, "lineitem").select(F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("_"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("run_id")).where(
        "right(run_id, 2) = '13'").distinct()  # grows with the runs, so it is a table
    left = tables.select_runs(runs, exclude=names)
    wanted = left.where("right(run_id, 1) <> '7'").select("run_id").distinct()
    return left.join(wanted, "run_id", "left_semi").select("pipeline", "run_id")


DIS_SPEC = {
    "encoding": "utf-8-sig",
    "summary": {"key_aliases": {"whole_flow": ["Total Discharge m3_s", "total_discharge_m3_s"], "crew": "operators"}, "required_keys": ["whole flow", "Crew"]},
    "points_table": {"units_within": 3},
}


def _strict(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return ingest.ingest_dis(parsing.dis_files(spark, sf), None, "r4", "/runs/r4", DIS_SPEC, keys=("whole_flow", "crew", "total_area_m2"))


@query("dis_by_spec", parsing.DIS_SQL + """
SELECT file, printf('%.2f', o_totalprice) AS whole_flow, 'Ann | Bob' AS crew, o_orderkey::VARCHAR AS total_area_m2, o_orderpriority AS station_name FROM s WHERE status = 'ok'""")
def dis_by_spec(spark: SparkSession, sf: str) -> DataFrame:
    """Files read by a spec: its names for the fields, its required ones."""
    return _strict(spark, sf)["Summary"].select("file", "whole_flow", "crew", "total_area_m2", "station_name")


@query("dis_strict_metadata", parsing.DIS_SQL + """
SELECT file, 'P' || o_custkey AS station_id, o_orderpriority AS station_name, d AS measurement_date, '101500' AS measurement_time, NULL::INTEGER AS n_verticals FROM s WHERE status = 'ok'""")
def dis_strict_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return dis_text.strict_metadata(_strict(spark, sf)["Summary"])


@query("audit_keys", """
WITH c AS (SELECT l_returnflag AS instrument, l_orderkey, l_shipdate, l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'Sections' AS "group", instrument, CASE WHEN count(*) FILTER (n > 1) > 0 THEN 'duplicates' ELSE 'ok' END AS status, CAST(sum(n) AS BIGINT) AS n_rows,
       'instrument;station_id;measurement_date;measurement_time;section_index' AS keys FROM c GROUP BY instrument
UNION ALL SELECT 'Gates', l_returnflag, 'not_checked', count(*), '' FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'Points', l_returnflag, 'missing_key_columns', count(*), 'measurement_time' FROM lineitem GROUP BY l_returnflag""")
def audit_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates of sections, gates that are only counted, and a table that lacks a key column."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("instrument"), F.col("l_orderkey").alias("station_id"), F.col("l_shipdate").alias("measurement_date"),
        F.col("l_suppkey").alias("measurement_time"), F.col("l_linenumber").alias("section_index"))
    sections, gates = audit.audit_duplicates(rows, "Sections"), audit.audit_duplicates(rows, "Gates")
    points = audit.audit_duplicates(rows.drop("measurement_time"), "Points")
    names = ["group", "instrument", "status", "n_rows"]
    return sections.select(*names, F.col("key_columns_used").alias("keys")).unionByName(gates.select(*names, F.col("missing_key_columns").alias("keys"))).unionByName(
        points.select(*names, F.col("missing_key_columns").alias("keys")))


@query("trace_check", "SELECT o_orderstatus AS instrument, count(*) AS n_rows, 'source_file;run_id' AS missing FROM orders GROUP BY 1")
def trace_check(spark: SparkSession, sf: str) -> DataFrame:
    """Trace columns that a raw table lacks, next to its rows."""
    own = {c: F.lit("x") for c in audit.RAW_TRACE_COLUMNS if c not in ("source_file", "run_id")}
    rows = table(spark, sf, "orders").withColumns(own).withColumn("instrument", F.col("o_orderstatus"))
    missing = ";".join(sorted(audit.trace_missing(rows), key=["source_file", "run_id"].index))
    return rows.groupBy("instrument").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("missing", F.lit(missing))


@query("fixed_points_sections", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, any_value(l_quantity) AS q, any_value(l_tax) AS t, any_value(l_discount) AS d, count(*) AS c FROM lineitem GROUP BY ALL HAVING count(*) = 1),
s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r, count(*) OVER (PARTITION BY l_orderkey) AS n FROM x),
p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pr, count(*) OVER (PARTITION BY l_orderkey) AS pn FROM s WHERE r > 1 AND r < n)
SELECT p.l_orderkey::VARCHAR AS station_id, p.l_linenumber::DOUBLE AS point_index,
       {rnd('sum(s.q * s.t)')} AS area_m2, {rnd('sum(s.q)')} AS q_ls
FROM p JOIN s ON s.l_orderkey = p.l_orderkey AND ((p.pr = 1 AND s.r IN (1, 2)) OR (p.pr > 1 AND p.pr = p.pn AND s.r IN (p.n - 1, p.n)) OR (p.pr > 1 AND p.pr < p.pn AND s.r = p.pr + 1))
GROUP BY ALL""")
def fixed_points_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Profiler points by fixed names, enriched from their sections; the first and last row of an order are sections only."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.first("l_quantity").alias("q"), F.first("l_tax").alias("t"), F.first("l_discount").alias("d"), F.count(F.lit(1)).alias("c")).where("c = 1")
    ends = lines.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"))
    key = {"instrument": F.lit("nivus"), "station_id": F.col("l_orderkey"), "measurement_date": F.lit("20250102"), "measurement_time": F.lit("101112")}
    named = [c.alias(n) for n, c in key.items()]
    sections = lines.select(*named, F.col("l_linenumber").alias("index"), F.col("q").alias("w [m]"), F.col("t").alias("h [m]"), F.col("q").alias("q [l/s]"), F.col("d").alias("factor [%]"))
    points = lines.join(ends, "l_orderkey").where("l_linenumber > low and l_linenumber < high").select(*named, F.col("l_linenumber").alias("index"))
    out = fixed_points(points, sections).select("station_id", "point_index", "area_m2", "q_ls")
    return rounded(out, {"area_m2": 4, "q_ls": 4})
