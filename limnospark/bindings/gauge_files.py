"""Summary files of all layouts made from events: tables of a root, tables of an instrument, wide and matrix files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import iso, query, rnd, rounded, table
from limnospark.sources import series, tables
from limnospark.sources.gauge_files import mixed_gauges

ENTRIES = [
    {"code": "pu", "name": "purchase", "subdir": "purchase"}, {"code": "SI", "name": "signup", "subdir": "signup"}, {"code": "ER", "name": "error", "subdir": "error"},
    {"code": "CL", "name": "click", "subdir": "click-log", "flow_column": "flow", "flow_unit": "m3/s"},
    {"code": "VI", "name": "view", "subdir": "view-log", "summary_format": "matrix"}, {"code": "", "name": "nameless", "subdir": "x"},
]
RANKING = ["PU", "click"]


def summary_files(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's events as Summary files `(file, text)`; some purchases are dated before 1990 or have no numeric point."""
    kind, user, day = F.col("event_type"), F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")
    value = F.col("value").cast("string")
    root = F.concat(F.lit("/n/"), user)
    single = F.concat(F.lit("/Summary/P"), user, F.lit("_Summary_"), day, F.lit("_101500.csv"))
    file = (
        F.when(kind.isin("purchase", "error"), F.concat(root, F.lit("/Summary.csv"))).when(kind == "signup", F.concat(root, F.lit("/signup/Summary.csv")))
        .when(kind == "click", F.concat(root, F.lit("/click-log"), single)).otherwise(F.concat(root, F.lit("/view-log"), single))
    )
    head = (
        F.when(kind.isin("purchase", "error"), "Station_ID,Fecha,Instrument,Caudal m3s").when(kind == "signup", "point,date,q_ls").when(kind == "click", "x,flow")
        .otherwise("h [m],1,2")
    )
    dated = F.when((kind == "purchase") & (F.col("event_id") % 10 == 0), F.concat(F.lit("1985"), F.substring(day, 5, 4))).otherwise(day)
    named = F.when((kind == "purchase") & (F.col("event_id") % 11 == 0), F.concat(F.lit("Px"), user)).otherwise(F.concat(F.lit("P"), user))
    line = (
        F.when(kind.isin("purchase", "error"), F.concat_ws(",", named, dated, kind, value)).when(kind == "signup", F.concat_ws(",", user, iso("ts"), value))
        .when(kind == "click", F.concat_ws(",", F.lit("a"), value)).otherwise(F.concat_ws(",", F.lit("q [l/s]"), value, (F.col("value") * 2).cast("string"), F.lit("x")))
    )
    rows = table(spark, sf, "events").select(file.alias("file"), head.alias("head"), F.struct("event_id", line.alias("line")).alias("row"))
    texts = rows.groupBy("file", "head").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return texts.select("file", F.concat_ws("\n", F.array("head"), F.col("rows.line")).alias("text"))


MIXED_SQL = """
raw AS (
  SELECT user_id, CAST(ts AS DATE) AS day, CASE event_type WHEN 'purchase' THEN 'PU' ELSE 'ER' END AS source, value * 1000 AS q, 'table' AS layout FROM events
  WHERE event_type = 'error' OR event_type = 'purchase' AND event_id % 10 <> 0 AND event_id % 11 <> 0
  UNION ALL SELECT user_id, CAST(ts AS DATE), 'SI', value, 'table' FROM events WHERE event_type = 'signup'
  UNION ALL SELECT user_id, CAST(ts AS DATE), 'CL', avg(value * 1000), 'wide' FROM events WHERE event_type = 'click' GROUP BY ALL
  UNION ALL SELECT user_id, CAST(ts AS DATE), 'VI', arg_min(value * 1.5, event_id), 'matrix' FROM events WHERE event_type = 'view' GROUP BY 1, 2
)"""


@query("gauges_mixed_layouts", f"WITH {MIXED_SQL} SELECT layout, source, count(*) AS n, {rnd('sum(q)', 2)} AS q FROM raw GROUP BY ALL")
def gauges_mixed_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each layout and instrument before the best source is chosen; points that are no number are dropped here."""
    entries = [row.asDict() for row in tables.instrument_catalogue(spark, ENTRIES).collect()]  # the catalogue
    rows = mixed_gauges(summary_files(spark, sf), entries).where(F.col("point").rlike(r"^\d+$"))
    codes = F.when(F.col("source") == "PURCHASE", "PU").when(F.col("source") == "ERROR", "ER").otherwise(F.col("source"))
    out = rows.groupBy("layout", codes.alias("source")).agg(F.count(F.lit(1)).alias("n"), F.sum("q_gauge_ls").alias("q"))
    return rounded(out, {"q": 2})


@query("gauges_mixed", f"""
WITH {MIXED_SQL}, means AS (SELECT user_id, day, source, avg(q) AS q FROM raw GROUP BY ALL)
SELECT user_id::VARCHAR AS point, strftime(day, '%Y-%m-%d') AS date, source, {rnd('q', 4)} AS q_gauge_ls FROM means
QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY CASE source WHEN 'PU' THEN 0 WHEN 'CL' THEN 1 ELSE 10000 END, source) = 1""")
def gauges_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """One flow for each point and day from Summary files of every layout."""
    entries = [row.asDict() for row in tables.instrument_catalogue(spark, ENTRIES).collect()]
    out = series.gauges_daily([mixed_gauges(summary_files(spark, sf), entries)], entries, RANKING)
    return rounded(out.withColumn("date", iso("date")), {"q_gauge_ls": 4})
