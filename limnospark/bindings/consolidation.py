"""Consolidation of runs. A raw file is an order line, its run is named after the ship date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import iso, query, rnd, rounded, table
from limnospark.operators.choose import best_series, latest_per_key, latest_runs, union_distinct, value_counts
from limnospark.plans.consolidate import build_group, describe_files, manifest, select_files
from limnospark.sources import tables

# A path of every line: .../ingest_<flag>/<run>/outputs/raw_canonical/flowtracker/Summary/P<order>_Summary_<n>.csv
PATH_SQL = """'/db/runs/ingest_' || lower(l_returnflag) || '/' || strftime(l_shipdate, '%Y%m%d') || '_' || lpad(l_suppkey::VARCHAR, 6, '0')
  || '/outputs/raw_canonical/flowtracker/Summary/P' || l_orderkey || '_Summary_2025010' || l_linenumber || '_101500.csv'"""
FILES_SQL = f"""
files AS (SELECT DISTINCT {PATH_SQL} AS csv_path, 'ingest_' || lower(l_returnflag) AS pipeline,
            strftime(l_shipdate, '%Y%m%d') || '_' || lpad(l_suppkey::VARCHAR, 6, '0') AS run_id,
            'P' || l_orderkey || '_Summary_2025010' || l_linenumber || '_101500.csv' AS csv_filename, l_orderkey, l_linenumber FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY csv_filename ORDER BY run_id DESC, csv_path DESC) AS rn FROM files)
"""


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    run = F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("_"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))
    path = F.concat(
        F.lit("/db/runs/ingest_"), F.lower("l_returnflag"), F.lit("/"), run, F.lit("/outputs/raw_canonical/flowtracker/Summary/P"),
        F.col("l_orderkey"), F.lit("_Summary_2025010"), F.col("l_linenumber"), F.lit("_101500.csv"))
    return table(spark, sf, "lineitem").select(
        path.alias("csv_path"), (F.col("l_partkey") * 100 + F.col("l_quantity")).cast("bigint").alias("row_no"),
        F.when(F.col("l_partkey") % 2 == 0, F.col("l_linestatus")).alias("nombre"),
        F.when(F.col("l_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("s"), F.col("l_partkey"))).alias("station_name"),
        F.col("l_extendedprice").alias("q_m3s"))


@query("latest_per_key", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS run, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""")
def latest_per_key_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return rows.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("run"), "l_partkey", "l_suppkey", "l_quantity")


@query("manifest", f"""
WITH {FILES_SQL} SELECT 'flowtracker' AS instrument, 'Summary' AS "group", csv_path, csv_filename, run_id, rn = 1 AS selected FROM ranked""")
def manifest_query(spark: SparkSession, sf: str) -> DataFrame:
    files = describe_files(_rows(spark, sf), "csv_path", "Summary")
    return manifest(files, select_files(files)).select("instrument", "group", "csv_path", "csv_filename", "run_id", "selected")


@query("consolidate_runs", f"""
WITH {FILES_SQL},
rows AS (SELECT {PATH_SQL} AS csv_path, l_partkey * 100 + CAST(l_quantity AS BIGINT) AS row_no, CASE WHEN l_partkey % 2 = 0 THEN l_linestatus END AS nombre,
                CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 's' || l_partkey END AS station_name, l_extendedprice AS q_m3s FROM lineitem),
kept AS (SELECT rows.*, l_orderkey, l_linenumber, run_id, pipeline FROM rows JOIN ranked USING (csv_path) WHERE rn = 1)
SELECT 'P' || l_orderkey AS station_id,
       coalesce(nullif(station_name, ''), first_value(nullif(station_name, '') IGNORE NULLS) OVER w, first_value(nombre IGNORE NULLS) OVER w, '') AS station_name,
       '2025010' || l_linenumber AS measurement_date, '101500' AS measurement_time, 'flowtracker' AS instrument, csv_path AS source_file,
       '/db/runs/' || pipeline || '/' || run_id AS source_run_dir, run_id, nombre, {rnd('q_m3s', 2)} AS discharge
FROM kept WINDOW w AS (PARTITION BY csv_path ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def consolidate_runs(spark: SparkSession, sf: str) -> DataFrame:
    out = build_group(_rows(spark, sf), "flowtracker", "Summary", aliases={"*": {"Summary": {"q_m3s": "discharge"}}})["rows"]
    return rounded(out, {"discharge": 2})


@query("latest_runs", f"""
WITH {FILES_SQL} SELECT pipeline, max(run_id) AS run_id FROM files GROUP BY pipeline""")
def latest_runs_query(spark: SparkSession, sf: str) -> DataFrame:
    runs = tables.list_runs(_rows(spark, sf).select("csv_path"))
    return tables.select_runs(runs, latest_only=True)


@query("incremental_union", """
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, CASE WHEN part = 2 THEN o_orderpriority END AS o_orderpriority
FROM (SELECT *, 1 AS part FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT *, 2 FROM orders WHERE o_orderkey % 3 <> 1)""")
def incremental_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return union_distinct(orders.where("o_orderkey % 3 <> 0").drop("o_orderpriority"), orders.where("o_orderkey % 3 <> 1"))


@query("best_series", """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS v1, nullif(event_id % 5, 0) AS v2,
                  CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 999 END AS r FROM events)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, arg_min(event_type, (r, event_type, event_id)) AS event_type,
       arg_min(v1, (r, event_type, event_id)) FILTER (v1 IS NOT NULL) AS v1, arg_min(v2, (r, event_type, event_id)) FILTER (v2 IS NOT NULL) AS v2, min(r) AS rank
FROM e GROUP BY user_id, d""")
def best_series_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "user_id", iso("ts").alias("day"), "event_type", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v1"),
        F.nullif(F.col("event_id") % 5, F.lit(0)).alias("v2"))
    return best_series(rows, ["user_id", "day"], "event_type", ["v1", "v2"], ["purchase", "click", "view"], ["event_id"])


@query("value_counts", """
SELECT 'segment.' || c_mktsegment AS metric, count(*) AS value FROM customer GROUP BY 1
UNION ALL SELECT 'nation.' || c_nationkey, count(*) FROM customer GROUP BY 1""")
def value_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    return value_counts(table(spark, sf, "customer"), {"c_mktsegment": "segment", "c_nationkey": "nation"})


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("instrument"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string"))
        .otherwise(F.concat(F.lit("p"), F.col("o_custkey"))).alias("station_id"), F.col("o_orderstatus").alias("group"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("measurement_date"), (F.col("o_orderkey") % 3).alias("source_file"))


@query("available_points", "SELECT DISTINCT 'P' || o_custkey AS point, CAST(o_custkey AS INT) AS number FROM orders")
def available_points(spark: SparkSession, sf: str) -> DataFrame:
    return tables.points_of(_catalog(spark, sf))


@query("available_months", "SELECT DISTINCT 'P' || o_custkey AS point, strftime(o_orderdate, '%Y%m') AS month FROM orders")
def available_months(spark: SparkSession, sf: str) -> DataFrame:
    return tables.months_of(_catalog(spark, sf))


@query("table_catalog", """
SELECT o_orderpriority AS instrument, o_orderstatus AS "group", 'file_group' AS layout, count(*) AS n_rows, 'normalized' AS stage
FROM orders GROUP BY ALL""")
def table_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return tables.audit_tables(_catalog(spark, sf), "normalized")


@query("paired_measurements", """
SELECT o_orderkey AS okey, o_custkey AS station, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_orderkey % 5 <> 0) AS has_points FROM orders""")
def paired_measurements(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "orders").select(F.col("o_orderkey").alias("okey"), F.col("o_custkey").alias("station"))
    p = table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("okey"))
    return tables.pair_by_key(s, p, ["okey"])
