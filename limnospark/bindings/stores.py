"""Sinks on the test tables: what the jobs make is written, read back and compared with what they made."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings import analysis, checks, correlations, exports
from limnospark.bindings.registry import ORACLES, iso, query, rounded, table
from limnospark.plans import correlation, registry_export, section_profiles, stage_discharge
from limnospark.plans.table_export import ExportRequest, run_export
from limnospark.session import shared_folder, written
from limnospark.sources import files, series, tables
from limnospark.sources.keyed_files import read_keyed, read_output, write_outputs


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/limnospark-written-{uuid.uuid4().hex}"


@query("written_records", ORACLES["registry_visits"])
def written_records(spark: SparkSession, sf: str) -> DataFrame:
    """All visit records written by export id into a set number of files, and read back."""
    root, visits = _folder(spark), written(exports.registry_visits(spark, sf), "visits")
    registry_export.write_records(visits, root, buckets=16, parts=2)
    return read_keyed(spark, root, visits.schema, "export_id")


@query("written_index", exports.REGISTRY_SQL + "SELECT export_id AS key, CAST(count(*) AS BIGINT) AS rows FROM o WHERE error IS NULL GROUP BY export_id")
def written_index(spark: SparkSession, sf: str) -> DataFrame:
    index = registry_export.write_records(written(exports.registry_gaugings(spark, sf), "gaugings"), _folder(spark), ";", buckets=16)
    return index.select("key", "rows")


@query("written_report", ORACLES["duplicates_report"])
def written_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of duplicate keys as CSV."""
    root, report = _folder(spark), checks.duplicates_report(spark, sf)
    tables.write_report(report, root, ";")
    return spark.read.option("header", True).option("sep", ";").schema(report.schema).csv(root)


@query("written_stage_discharge", ORACLES["stage_run_log"])
def written_stage_discharge(spark: SparkSession, sf: str) -> DataFrame:
    """The stage-discharge run's tables written: pairs and fits by station, the log read back."""
    root, out = _folder(spark), analysis._run(spark, sf, keep=written)
    # the fits are read for their files and for the index of those
    kept = {"analysis_pairs": out["analysis_pairs"], "fits": written(out["fits"], "fits"), "log": out["log"]}
    write_outputs(kept, root, {"analysis_pairs": "station_id", "fits": "station_id"}, buckets=8)
    return read_output(spark, root, "log", out["log"].schema)


@query("written_quality", ORACLES["quality_measurements"])
def written_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The quality run's measurements by point and its log."""
    root, out = _folder(spark), analysis._quality(spark, sf, grain="monthly", keep=written)
    write_outputs({"measurements": out["measurements"], "log": out["log"]}, root, {"measurements": "point"}, buckets=8)
    return rounded(read_keyed(spark, f"{root}/measurements", out["measurements"].schema, "point"), {"cg": 6})


@query("written_correlation", ORACLES["corr_gauge_model_rows"])
def written_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """The correlation's pair rows by point and its summary."""
    root = _folder(spark)
    rows, summary = correlation.gauges_vs_model(
        correlations.gauges(spark, sf), correlations.model(spark, sf), {"x": "model", "y": "gauge"}, start="2024-01-03", end="2024-01-28")
    rows = rounded(rows.withColumn("date", iso("date")), {"q_model_ls": 4, "q_gauge_ls": 4, "q_gauge_pred_ls": 4, "residual_ls": 4})
    write_outputs({"rows": rows, "summary": summary}, root, {"rows": "point"}, buckets=8)
    return read_keyed(spark, f"{root}/rows", rows.schema, "point")


@query("export_of_months", ORACLES["export_flat"])
def export_of_months(spark: SparkSession, sf: str) -> DataFrame:
    """A flat export from a table kept by instrument and month; the request's first date prunes the months before it."""
    root = _folder(spark)
    tables.write_table(exports._lines(spark, sf), f"{root}/Points", month_of="measurement_date")
    read = spark.read.parquet(f"{root}/Points")
    return run_export(read, ExportRequest(instrument="a", points=["3", "P4"], parameters=["q"], early="19960601"))


@query("profiles_of_months", ORACLES["profile_rows"])
def profiles_of_months(spark: SparkSession, sf: str) -> DataFrame:
    """Section profiles from a table kept by month; rows that only their file dates are read, too."""
    root = _folder(spark)
    tables.write_table(analysis.profile_points(spark, sf), f"{root}/Points", month_of="measurement_date")
    loaded = section_profiles.load_points(spark.read.parquet(f"{root}/Points"), analysis.PROFILE_INSTRUMENTS, "file")
    chosen = section_profiles.select_rows(loaded, start="19960101", end="1999-12-31")
    return section_profiles.profile_rows(chosen.withColumn("measurement_date", iso("measurement_date")))


@query("stage_of_months", ORACLES["stage_selected"])
def stage_of_months(spark: SparkSession, sf: str) -> DataFrame:
    """The matched measurements kept by month, read back for some points and years."""
    root = _folder(spark)
    tables.write_table(analysis._matched(spark, sf), f"{root}/matched", partitions=(), month_of="measurement_date")
    df = stage_discharge.select_dates(stage_discharge.select_points(spark.read.parquet(f"{root}/matched"), ["7", "p012"]), "19960101", "1999-12-31")
    out = df.withColumn("q_total_ls", F.col("q_total_ls").cast("double")).select(
        "station_id", iso("measurement_date").alias("measurement_date"), "measurement_time", "instrument", "run_id", "q_total_ls", "manual_stage_m", "instrument_stage_max_m")
    return rounded(out, {"q_total_ls": 2, "manual_stage_m": 2})


@query("manual_stage_files", """
SELECT 'P' || CAST(o_custkey AS VARCHAR) AS station_id, strftime(o_orderdate, '%Y-%m-%d') AS measurement_date,
       CASE WHEN o_orderkey % 5 <> 0 THEN round(o_totalprice, 2) END AS manual_stage_m FROM orders""")
def manual_stage_files(spark: SparkSession, sf: str) -> DataFrame:
    """Manual stages written as a CSV table and read by its reader."""
    root = _folder(spark)
    table(spark, sf, "orders").select(
        F.concat(F.lit("p0"), F.col("o_custkey")).alias("station_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("measurement_date"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise("none").alias("manual_stage_m"),
    ).write.option("header", True).csv(f"{root}/manual_stage.csv")
    read = series.read_manual_stage(spark, root)
    return read.withColumn("measurement_date", iso("measurement_date"))


@query("scanned_lines", "SELECT 'utf-8-sig' AS encoding, c_custkey::VARCHAR || ';' || c_name || ';' || coalesce(c_mktsegment, '') AS line FROM customer")
def scanned_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a folder found by their ending, decoded and cut into lines."""
    root = _folder(spark)
    table(spark, sf, "customer").select(F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", F.coalesce("c_mktsegment", F.lit("")))).write.text(f"{root}/a/b")
    return files.line_table(files.scan_files(spark, root, [".TXT"])).where("line <> ''").select("encoding", "line")


@query("text_csv_rows", """
SELECT s_suppkey::VARCHAR AS "id", CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS "name", lpad(s_suppkey::VARCHAR, 12, '0') AS code FROM supplier""")
def text_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV read as text: codes keep their zeros, words for missing become null."""
    root = _folder(spark)
    key = F.col("s_suppkey").cast("string")
    table(spark, sf, "supplier").select(key.alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "NaN").otherwise(F.col("s_name")).alias("name"), F.lpad(key, 12, "0").alias("code")).write.option(
        "header", True).csv(root)
    return files.read_text_csv(spark, root)


@query("optional_tables", "SELECT 'F' AS instrument, count(*) AS n, false AS gates FROM orders WHERE o_orderstatus = 'F'")
def optional_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is there, and one that is not."""
    root = _folder(spark)
    tables.write_table(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("instrument"), "o_orderkey"), f"{root}/Summary")
    found = tables.load_optional(spark, root, "Summary", "F")
    missing = tables.load_optional(spark, root, "Gates")
    return found.groupBy("instrument").agg(F.count(F.lit(1)).alias("n")).withColumn("gates", F.lit(missing is not None))
