"""Smaller jobs on the test tables: lists, flags, fills, sinks read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import query, rnd, rounded, table
from limnospark.operators.reshape import drop_empty_columns
from limnospark.operators.specs import negative_columns
from limnospark.plans import stage_discharge, table_export
from limnospark.session import shared_folder
from limnospark.sources import series, tables


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/limnospark-written-{uuid.uuid4().hex}"


@query("stations_with_timestep", "SELECT DISTINCT event_type AS station FROM events WHERE event_id % 4 = 0 AND event_type IN ('click', 'view')")
def stations_with_timestep(spark: SparkSession, sf: str) -> DataFrame:
    daily = F.col("event_type").isin("click", "view") & (F.col("event_id") % 4 == 0)
    rows = table(spark, sf, "events").select(F.col("event_type").alias("station"), F.when(daily, "daily").otherwise("hourly").alias("timestep"))
    return series.stations_with(rows, "daily")


@query("filled_instrument", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'nivus' END AS instrument FROM orders")
def filled_instrument(spark: SparkSession, sf: str) -> DataFrame:
    own = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus"))
    return tables.with_instrument(table(spark, sf, "orders").select("o_orderkey", own.alias("instrument")), "nivus")


@query("negative_flags", """
SELECT c_mktsegment AS instrument, bool_or(c_acctbal < 0) AS c_acctbal, bool_or(c_custkey < 0) AS c_custkey FROM customer GROUP BY 1""")
def negative_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "instrument")
    return negative_columns(rows, ["c_acctbal", "c_custkey", "absent"])


@query("columns_with_values", "SELECT c_custkey, c_name FROM customer")
def columns_with_values(spark: SparkSession, sf: str) -> DataFrame:
    return drop_empty_columns(table(spark, sf, "customer").select("c_custkey", F.lit(None).cast("string").alias("empty"), "c_name"))


@query("export_request", """
SELECT 'Summary' AS "table", 'all' AS instrument, '7, 12' AS points, 'q' AS parameters, NULL::VARCHAR AS early_date_requested, '20001231' AS late_date_requested,
       strftime(min(o_orderdate), '%Y%m%d') AS early_date_effective, strftime(max(o_orderdate), '%Y%m%d') AS late_date_effective, 'none' AS grouping, 'mean' AS aggregation,
       count(*) AS row_count FROM orders""")
def export_request(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("measurement_date"))
    request = table_export.ExportRequest(table="Summary", instrument="all", points=["7", "12"], parameters=["q"], late="20001231")
    bounds = rows.agg(F.min("measurement_date"), F.max("measurement_date")).first()
    return table_export.request_metadata(rows, request, tuple(bounds))


@query("stage_best_data", f"""
SELECT l_suppkey AS station_id, l_returnflag AS instrument, count(*) AS n_data, {rnd('regr_slope(l_extendedprice, l_quantity)')} AS a,
       {rnd('regr_intercept(l_extendedprice, l_quantity)')} AS b FROM lineitem GROUP BY ALL HAVING count(*) >= 3""")
def stage_best_data(spark: SparkSession, sf: str) -> DataFrame:
    """Straight lines next to the number of their data rows."""
    keys = ("station_id", "instrument")
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station_id"), F.col("l_returnflag").alias("instrument"), F.col("l_quantity").alias("stage_m"),
        F.col("l_extendedprice").alias("q_total_ls"))
    fitted = stage_discharge.fit(pairs, keys)
    lines = fitted["metrics"].where("model = 'poly1'").select(*keys, "model")
    shown = stage_discharge.best_with_data(lines, pairs, fitted["fits"], keys)
    return rounded(shown.select(*keys, "n_data", "a", "b"), {"a": 4, "b": 4})


@query("written_table", f"""
SELECT o_orderstatus AS instrument, o_custkey AS station_id, {rnd('sum(o_totalprice)', 2)} AS q, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""")
def written_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table written by instrument and read back for one of them."""
    root = _folder(spark)
    rows = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("instrument"), F.col("o_custkey").alias("station_id"), F.col("o_totalprice").alias("q"))
    tables.write_table(rows, f"{root}/Summary")
    read = tables.load_table(spark, root, "Summary", "f").groupBy("instrument", "station_id").agg(F.sum("q").alias("q"), F.count(F.lit(1)).alias("n"))
    return rounded(read, {"q": 2})
