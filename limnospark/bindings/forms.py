"""Text, date and number forms, and table normalization by a spec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import iso, query, rnd, rounded, spread, table
from limnospark.functions import dates as D, numbers as N, text as T
from limnospark.operators.instrument_specs import instrument_spec
from limnospark.operators.specs import alias_mapping, apply_aliases, normalize_table
from limnospark.plans.consolidate import fill_trace
from limnospark.plans.ingest import resolve_metadata
from limnospark.plans.normalize import enrich_points, fixed_points, fixed_summary
from limnospark.sources.files import decode_text, line_table, robust_csv_rows

DIGITS = {"remove_prefixes": ["P"], "digits_only": True}


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their date written in mixed forms by key."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf, "orders").withColumns({
        "date_text": F.when(k % 5 == 0, F.date_format(d, "yyyyMMdd")).when(k % 5 == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 5 == 2, F.date_format(d, "M/d/yyyy")).when(k % 5 == 3, F.date_format(d, "yyyy/MM/dd HH:mm:ss"))
        .otherwise(F.concat(F.lit("on "), F.date_format(d, "yyyy.MM.dd"))),
        "seconds": (k * 7919) % 86400,
    }).withColumn("clock", F.date_format(F.timestamp_seconds("seconds").cast("timestamp_ntz"), "HH:mm:ss")).withColumn(
        "time_text",
        F.when(k % 4 == 0, F.replace("clock", F.lit(":"), F.lit(""))).when(k % 4 == 1, F.col("clock"))
        .when(k % 4 == 2, F.substring("clock", 1, 5)).otherwise(F.regexp_replace(F.replace("clock", F.lit(":"), F.lit("")), "^0(?=[1-9])", "")),
    )


# Digits are split the way strptime splits them: an hour takes two digits where it can.
_SIX = """lpad((o_orderkey * 7919 % 86400 // 3600)::VARCHAR, 2, '0') || lpad((o_orderkey * 7919 % 86400 // 60 % 60)::VARCHAR, 2, '0')
  || lpad((o_orderkey * 7919 % 60)::VARCHAR, 2, '0')"""
_SPLIT = r"^(2[0-3]|[01]\d|\d)([0-5]\d|\d)([0-5]\d|\d)$"
_SHORT = f"regexp_replace({_SIX}, '^0([1-9])', '\\1')"
_TIME_SQL = f"""CASE WHEN o_orderkey % 4 = 2 THEN left({_SIX}, 4) || '00' WHEN o_orderkey % 4 = 3 THEN
  {" || ".join(f"lpad(regexp_extract({_SHORT}, '{_SPLIT}', {i}), 2, '0')" for i in (1, 2, 3))} ELSE {_SIX} END"""


@query("datetime_normalize", f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS measurement_date,
       {_TIME_SQL} AS measurement_time
FROM orders""")
def datetime_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).select(
        "o_orderkey", D.measurement_date(F.col("date_text")).alias("measurement_date"),
        D.measurement_time(F.col("time_text")).alias("measurement_time"))


@query("date_forms", """
WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS d, o_orderkey % 3 AS m FROM orders)
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS month_first,
       CASE WHEN m = 1 AND day(d) <= 12 THEN strftime(make_date(year(d), day(d), month(d)), '%Y-%m-%d') ELSE strftime(d, '%Y-%m-%d') END AS day_first,
       strftime(d, '%Y%m%d') AS eight_digits, strftime(d, '%Y-%m-%d') AS serial, strftime(d, '%d/%m/%Y') || ' 10:20:30' AS stamp,
       strftime(date_trunc('month', d), '%Y-%m-%d') AS month, strftime(d, '%Y%m') AS period,
       strftime(d, '%Y/%m/%d') || ' 01:02:03' AS first_stamp, CASE WHEN year(d) >= 2000 THEN strftime(d, '%Y-%m-%d') END AS path_date,
       strftime(d, '%Y%m%d') AS file_date, strftime(d, '%Y-%m-%d') AS or_file
FROM o""")
def date_forms(spark: SparkSession, sf: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.date_format(d, "yyyyMMdd")).when(k % 3 == 1, F.date_format(d, "MM/dd/yyyy")).otherwise(iso(d))
    compact = F.date_format(d, "yyyyMMdd")
    serial = F.datediff(d.cast("date"), F.to_date(F.lit("1899-12-30"))).cast("string")
    stamp = D.measurement_timestamp(iso(d), F.lit("10:20:30"))
    # The file is one of a few, so its rows are dealt out; what is shown twice is worked out once.
    orders = D.with_computed(spread(table(spark, sf, "orders").select("o_orderkey", "o_orderdate")), {"text": text, "compact": compact})
    dates = D.with_computed(orders, {"month_first": D.iso_date(F.col("text"))})
    compact = F.col("compact")
    return dates.select(
        "o_orderkey", iso("month_first").alias("month_first"), iso(D.iso_date(F.col("text"), day_first=True)).alias("day_first"),
        D.eight_digit_date(F.concat(F.lit("P1_"), compact, F.lit("_x"))).alias("eight_digits"), iso(D.serial_date(serial)).alias("serial"),
        D.format_stamp(stamp, "%d/%m/%Y %H:%M:%S").alias("stamp"), iso(D.month_start(F.col("month_first"))).alias("month"),
        D.period_label(compact, F.lit(None), "monthly").alias("period"),
        D.first_stamp(F.concat(F.lit("start "), iso(d), F.lit(" 01:02:03 end"))).alias("first_stamp"),
        iso(D.path_date(F.concat(F.lit("/data/20009999_"), compact, F.lit("/a.xls")))).alias("path_date"),
        D.file_stamp(F.concat(F.lit("P1_20000101_010101_"), compact, F.lit("_101112.xml")))["measurement_date"].alias("file_date"),
        iso(D.iso_date_or(F.lit("1970-01-01"), compact)).alias("or_file"))


@query("text_codes", """
SELECT c_custkey, c_custkey::VARCHAR AS station_id, 'P' || c_custkey AS station_code, 'P' || c_custkey AS point_code,
       'P' || c_custkey AS point_token, 'P' || c_custkey AS file_station, 'P' || c_custkey AS spoken,
       'P' || c_custkey AS named_station, '20250102' AS named_date, replace(lower(c_mktsegment), ' ', '_') || '_percent' AS snake,
       CASE WHEN c_custkey % 3 = 0 THEN 'FT' WHEN c_custkey % 3 = 1 THEN 'NV' ELSE c_mktsegment END AS source,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS cleaned, 'P' || c_custkey AS folder_station,
       '70' || lpad(c_custkey::VARCHAR, greatest(2, length(c_custkey::VARCHAR))::INT, '0') AS legacy,
       lower(c_mktsegment) || ' o' AS label, c_custkey::VARCHAR AS bare, c_custkey / 2.0 AS coord_y, -c_custkey / 4.0 + 0.0 AS coord_x,
       lpad(c_custkey::VARCHAR, greatest(6, length(c_custkey::VARCHAR))::INT, '0') AS padded
FROM customer""")
def text_codes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    key = k.cast("string")
    p = F.concat(F.lit("P"), key)
    codes = {T.source_key_text("Flow-Tracker"): "FT", T.source_key_text("nivus"): "NV"}
    named = T.file_name_metadata(F.concat(F.lit("/x/"), p, F.lit("_Summary_20250102_030405.csv")), "Summary")
    spot = T.coordinates(F.concat(F.lit("Y = "), F.replace((k / 2).cast("string"), F.lit("."), F.lit(",")), F.lit("; x=-"), (k / 4).cast("string")))
    source = F.when(k % 3 == 0, "flow tracker").when(k % 3 == 1, " NIVUS ").otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey", T.station_id(F.concat(F.lit(" p"), key, F.lit(".0")), DIGITS).alias("station_id"),
        T.station_code(key, {"prefix": "p"}).alias("station_code"), T.point_code(F.concat(F.lit("p00"), key)).alias("point_code"),
        T.point_token(F.when(k % 2 == 0, key).otherwise(F.concat(F.lit("p"), key))).alias("point_token"),
        T.file_station_id(F.concat(F.lit("dir/"), p, F.lit(".TXT.WAD"))).alias("file_station"),
        T.spoken_station_id(F.concat(F.lit("Est. p "), key)).alias("spoken"),
        named["station_id"].alias("named_station"), named["measurement_date"].alias("named_date"),
        T.snake_case(F.concat(F.col("c_mktsegment"), F.lit("  (%)"))).alias("snake"), T.source_code(source, codes).alias("source"),
        T.null_if_empty(F.when(k % 5 == 0, " NaN ").otherwise(F.col("c_name"))).alias("cleaned"),
        T.parent_folder_station(F.concat(F.lit("/raw/P9/"), F.lower(p), F.lit("/a/b.dis"))).alias("folder_station"),
        T.legacy_station_code(F.concat(F.lit("P0"), key)).alias("legacy"),
        T.label_text(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(":  º"))).alias("label"),
        T.bare_id(F.concat(F.lit("Pm"), key)).alias("bare"), spot["coord_y"].alias("coord_y"), (spot["coord_x"] + F.lit(0.0)).alias("coord_x"),
        T.text_transforms(F.concat(F.lit("p"), key), ["strip", "uppercase", {"name": "remove_prefix", "value": "P"}, "digits_only",
                                                        {"name": "zero_pad", "value": 6}]).alias("padded"))


@query("number_forms", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE {rnd('l_extendedprice', 2)} END AS cell,
       CASE WHEN l_linenumber % 2 = 0 THEN {rnd('l_quantity * 1000', 2)} ELSE {rnd('l_quantity', 2)} END AS litres,
       CASE WHEN l_discount = 0 THEN CAST(l_quantity AS BIGINT) END AS whole, l_discount <> 0 AS fractional,
       CASE WHEN l_tax = 0 THEN {rnd('l_quantity')} ELSE {rnd('abs(l_quantity - l_tax) / l_tax * 100')} END AS gap,
       l_partkey::VARCHAR AS markup, {rnd('2 * l_quantity * l_quantity + 3 * l_quantity + 4', 2)} AS curve
FROM lineitem""")
def number_forms(spark: SparkSession, sf: str) -> DataFrame:
    price = F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    q = F.col("l_quantity")
    out = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        N.cell_number(F.when(F.col("l_linenumber") % 7 == 0, "-").otherwise(price)).alias("cell"),
        N.to_litres(q.cast("string"), F.when(F.col("l_linenumber") % 2 == 0, "m^3 / s").otherwise("l/s")).alias("litres"),
        N.whole_number(q + F.col("l_discount")).alias("whole"), N.is_fractional(q + F.col("l_discount")).alias("fractional"),
        N.relative_difference(F.col("l_tax"), q).alias("gap"), N.markup_value(F.format_string("%07d", "l_partkey")).alias("markup"),
        N.predict(F.lit("poly2"), q, F.lit(2.0), F.lit(3.0), F.lit(4.0)).alias("curve"))
    return rounded(out, {"cell": 2, "litres": 2, "gap": 4, "curve": 2})


def raw_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as raw flow-tracker Summary rows, all text."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return _orders(spark, sf).select(
        F.concat(F.lit(" P"), F.col("o_custkey"), F.lit(".0")).alias("station_id"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("station_name"), F.col("o_orderstatus").alias("site_name"),
        F.col("date_text").alias("start_date_time"), F.lit(None).cast("string").alias("measurement_date"), F.col("time_text").alias("measurement_time"),
        F.lit("flowtracker").alias("source"), F.concat(F.lit("f"), k, F.lit(".dis")).alias("input_file"), F.lit("r1").alias("run_id"),
        F.when(k % 2 == 0, price).alias("total_discharge_m3_s"), F.when(k % 2 == 1, F.replace(price, F.lit("."), F.lit(","))).alias("discharge_m3_s"),
        F.when(k % 11 == 0, "n/a").otherwise(F.concat(F.lit(" "), k)).alias("total_area_m2"),
        F.when(k % 13 == 0, "-1.5").otherwise("2.5").alias("total_width_m"), k.alias("okey"))


@query("normalize_spec", f"""
SELECT o_custkey::VARCHAR AS station_id, 'P' || o_custkey AS station_code, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END AS station_name,
       strftime(o_orderdate, '%Y%m%d') AS measurement_date,
       {_TIME_SQL} AS measurement_time,
       'flowtracker' AS instrument, 'f' || o_orderkey || '.dis' AS source_file, NULL AS source_run_dir, 'r1' AS run_id,
       {rnd('o_totalprice', 2)} AS q_total_m3s, {rnd('o_totalprice * 1000', 2)} AS q_total_ls,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey::DOUBLE END AS area_total_m2,
       CASE WHEN o_orderkey % 13 = 0 THEN -1.5 ELSE 2.5 END::DOUBLE AS width_total_m,
       CASE WHEN o_orderkey % 13 = 0 THEN 'width_total_m: negative' ELSE 'ok' END AS qc_status
FROM orders""")
def normalize_spec(spark: SparkSession, sf: str) -> DataFrame:
    out = normalize_table(raw_summary(spark, sf), instrument_spec("flowtracker", "Summary"), qc_column=True)
    out = out.drop("velocity_mean_m_s", "depth_mean_m", "temperature_c")
    return rounded(out, {"q_total_m3s": 2, "q_total_ls": 2})


@query("normalize_sections", f"""
SELECT l_orderkey::VARCHAR AS station_id, CAST(l_linenumber AS BIGINT) AS section_index, l_quantity AS distance_m, {rnd('l_extendedprice', 2)} AS q_ls,
       {rnd('l_extendedprice / 1000', 6)} AS q_m3s, {rnd('l_discount * 100', 4)} AS percent_q, CASE WHEN l_tax > 0 THEN l_tax END AS width_m, l_suppkey::VARCHAR AS run_id,
       l_partkey::VARCHAR AS source_file
FROM lineitem""")
def normalize_sections(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_orderkey")).alias("ref"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("stime"),
        F.lit("nivus").alias("source"), F.col("l_linenumber").cast("string").alias("index"), F.col("l_quantity").cast("string").alias("pos [m]"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("q [l/s]"), (F.col("l_discount") * 100).cast("string").alias("factor [%]"),
        F.when(F.col("l_tax") > 0, F.col("l_tax").cast("string")).otherwise("none").alias("w [m]"), F.col("l_suppkey").alias("run_id"),
        F.col("l_partkey").alias("input_file"))
    out = normalize_table(raw, instrument_spec("nivus", "Sections")).select(
        "station_id", "section_index", "distance_m", "q_ls", "q_m3s", "percent_q", "width_m", "run_id", "source_file")
    return rounded(out, {"q_ls": 2, "q_m3s": 6, "percent_q": 4})


@query("fixed_summary", f"""
SELECT o_orderkey::VARCHAR AS station_id, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS station_name,
       strftime(o_orderdate, '%Y%m%d') AS measurement_date, lpad((o_orderkey % 86400)::VARCHAR, 6, '0') AS measurement_time,
       {rnd("CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_totalprice / 1000 END", 6)} AS q_total_m3s,
       {rnd("CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 1000 ELSE o_totalprice END", 2)} AS q_total_ls
FROM orders""")
def fixed_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = table(spark, sf, "orders").select(
        k.alias("station_id"), F.nullif("o_orderstatus", F.lit("P")).alias("site_name"), F.col("o_orderpriority").alias("nombre"),
        iso("o_orderdate").alias("measurement_date"), F.concat(k % 86400, F.lit(".0")).alias("measurement_time"),
        F.when(k % 2 == 0, F.col("o_totalprice").cast("string")).alias("q_m3s"), F.when(k % 2 == 1, F.col("o_totalprice").cast("string")).alias("q [l/s]"))
    out = fixed_summary(raw).select("station_id", "station_name", "measurement_date", "measurement_time", "q_total_m3s", "q_total_ls")
    return rounded(out, {"q_total_m3s": 6, "q_total_ls": 2})


def _ranked_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Sections are the lines of an order; points are its lines without the first and the last.

    Orders divisible by 5 keep all their lines as points, which breaks the rule on purpose.
    """
    lines = table(spark, sf, "lineitem")
    sections = lines.select(
        F.col("l_orderkey").alias("station_id"), F.lit(None).cast("string").alias("measurement_time"),
        (F.col("l_linenumber") * 1000 + F.col("l_partkey") % 1000).alias("section_index"), "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_quantity").alias("width_m"), F.col("l_tax").alias("depth_m"), F.col("l_extendedprice").alias("q_ls"),
        (F.col("l_discount") * 100).alias("percent_q"))
    ends = sections.groupBy("station_id").agg(
        F.min(F.struct("section_index", "l_partkey", "l_suppkey", "l_extendedprice")).alias("lo"), F.max(F.struct("section_index", "l_partkey", "l_suppkey", "l_extendedprice")).alias("hi"))
    own = F.struct("section_index", "l_partkey", "l_suppkey", "l_extendedprice")
    points = sections.join(ends, "station_id").where((F.col("station_id") % 5 == 0) | ((own != F.col("lo")) & (own != F.col("hi")))).select(
        "station_id", "measurement_time", F.col("section_index").alias("point_index"), "l_partkey", "l_suppkey", "l_extendedprice",
        F.lit(-1.0).alias("area_m2"), F.lit(-1.0).alias("q_ls"), F.lit(-1.0).alias("q_m3s"), F.lit(-1.0).alias("percent_q"))
    return points, sections


@query("section_enrichment", f"""
WITH s AS (SELECT l_orderkey AS station_id, l_linenumber * 1000 + l_partkey % 1000 AS i, l_partkey, l_suppkey, l_quantity * l_tax AS a, l_extendedprice AS q,
                  l_discount * 100 AS f,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber * 1000 + l_partkey % 1000, l_partkey, l_suppkey, l_extendedprice) AS r,
                  count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY i, l_partkey, l_suppkey, q) AS pr, count(*) OVER (PARTITION BY station_id) AS pn
      FROM s WHERE station_id % 5 = 0 OR (r > 1 AND r < n)),
j AS (SELECT p.station_id, p.i, p.l_partkey, p.l_suppkey, p.pr, max(p.n) = max(p.pn) + 2 AS fits, coalesce(sum(s.a), 0) AS a, coalesce(sum(s.q), 0) AS q, coalesce(sum(s.f), 0) AS f
      FROM p LEFT JOIN s ON s.station_id = p.station_id AND (
        (p.pr = 1 AND s.r IN (1, 2)) OR (p.pr > 1 AND p.pr = p.pn AND s.r IN (p.n - 1, p.n)) OR (p.pr > 1 AND p.pr < p.pn AND s.r = p.pr + 1))
      GROUP BY ALL)
SELECT station_id, i AS point_index, l_partkey, l_suppkey, {rnd('CASE WHEN fits THEN a ELSE -1 END')} AS area_m2, {rnd('CASE WHEN fits THEN q ELSE -1 END', 2)} AS q_ls,
       {rnd('CASE WHEN fits THEN q / 1000 ELSE -1 END', 6)} AS q_m3s, {rnd('CASE WHEN fits THEN f ELSE -1 END', 2)} AS percent_q FROM j""")
def section_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    points, sections = _ranked_lines(spark, sf)
    ties = ("l_partkey", "l_suppkey", "l_extendedprice")
    out = enrich_points(points, sections, ("station_id", "measurement_time"), ties, ties)
    out = out.select("station_id", "point_index", "l_partkey", "l_suppkey", "area_m2", "q_ls", "q_m3s", "percent_q")
    return rounded(out, {"area_m2": 4, "q_ls": 2, "q_m3s": 6, "percent_q": 2})


@query("fixed_points", f"""
SELECT l_orderkey::VARCHAR AS station_id, l_linenumber::DOUBLE AS point_index, l_linenumber::VARCHAR AS point_label, l_quantity AS distance_m,
       CASE WHEN l_linenumber % 2 = 0 THEN l_tax ELSE l_discount END AS depth_m, {rnd('l_extendedprice', 2)} AS q_m3s, {rnd('l_extendedprice * 1000', 2)} AS q_ls,
       strftime(l_shipdate, '%Y%m%d') AS measurement_date, l_partkey::VARCHAR AS source_csv
FROM lineitem""")
def fixed_points_query(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("l_linenumber") % 2 == 0
    raw = table(spark, sf, "lineitem").select(
        F.lit("molinete").alias("instrument"), F.col("l_orderkey").alias("station_id"), iso("l_shipdate").alias("measurement_date"),
        F.lit("101112").alias("measurement_time"), F.col("l_linenumber").alias("index"), F.col("l_quantity").alias("progr_m"),
        F.when(even, F.col("l_tax")).alias("depth_m"), F.when(~even, F.col("l_discount")).alias("prof_m"),
        F.col("l_extendedprice").alias("q_m3s"), F.col("l_partkey").alias("source_csv"))
    out = fixed_points(raw).select(
        "station_id", "point_index", "point_label", "distance_m", "depth_m", "q_m3s", "q_ls", "measurement_date", "source_csv")
    return rounded(out, {"q_m3s": 2, "q_ls": 2})


@query("alias_merge", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN nullif(o_orderstatus, 'P') END, o_orderpriority) AS station_name, o_custkey AS estacion
FROM orders""")
def alias_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))).alias("station_name"),
        F.col("o_orderpriority").alias("nombre"), F.col("o_custkey").alias("station"))
    aliases = {"*": {"*": {"station": "punto"}, "Summary": {"nombre": "station_name"}}, "molinete": {"Summary": {"station": "estacion"}}}
    return apply_aliases(rows, alias_mapping(aliases, "molinete", "Summary"))


@query("trace_fill", """
WITH o AS (SELECT o_custkey AS file, o_orderkey AS n, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS station_name,
                  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS nombre FROM orders)
SELECT file, n, coalesce(station_name,
         first_value(station_name IGNORE NULLS) OVER w, first_value(nombre IGNORE NULLS) OVER w, '') AS station_name, nombre,
       'file ' || file AS station_id
FROM o WINDOW w AS (PARTITION BY file ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def trace_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("n"),
        F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).otherwise(" ").alias("station_name"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("nombre"))
    return fill_trace(rows, "file", "n", {"station_id": F.concat(F.lit("file "), F.col("file"))}, {"station_name": ("station_name", "nombre")})


@query("metadata_policy", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN lpad(o_custkey::VARCHAR, greatest(4, length(o_custkey::VARCHAR))::INT, '0') ELSE lpad(o_orderkey::VARCHAR, greatest(4, length(o_orderkey::VARCHAR))::INT, '0') END AS station_id,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'unnamed' END AS station_name, strftime(o_orderdate, '%Y%m%d') AS measurement_date, '000000' AS measurement_time
FROM orders""")
def metadata_policy(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = _orders(spark, sf).select(
        "o_orderkey", F.when(k % 3 == 0, F.concat(F.lit("p"), F.col("o_custkey"))).otherwise("nan").alias("code"),
        F.when(k % 2 == 0, F.concat(F.col("o_orderpriority"), F.lit(" "))).alias("name"), "date_text",
        F.concat(F.lit("/raw/P"), k, F.lit("/file_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".xml")).alias("path"))
    policy = {
        "station_id": {"sources": [{"type": "raw_field", "key": "code"}, {"type": "path_regex", "pattern": r"/P(?P<value>\d+)/"}],
                       "transforms": ["strip", "uppercase", {"name": "remove_prefix", "value": "P"}, "digits_only", {"name": "zero_pad", "value": 4}]},
        "station_name": {"sources": [{"type": "raw_field", "key": "name"}, {"type": "constant", "value": "unnamed"}]},
        "measurement_date": {"sources": [{"type": "filename_regex", "pattern": r"_(\d{8})\."}]},
    }
    fields = resolve_metadata(policy, {"code": F.col("code"), "name": F.col("name")}, F.col("path"), {
        "station_id": F.lit("?"), "station_name": F.lit("?"), "measurement_date": F.lit("?"), "measurement_time": F.lit("000000")})
    return rows.select("o_orderkey", *[c.alias(n) for n, c in fields.items()])


# Files whose headers differ in order, and of which half lack the name.
@query("csv_mixed_headers", """
SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name || ', ""' ELSE '' END AS name,
       CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer""")
def csv_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    segment = F.when(k % 3 == 0, "NaN").otherwise(F.col("c_mktsegment"))
    full = F.concat(F.lit("id,segment,name\n"), k, F.lit(","), segment, F.lit(',"'), F.col("c_name"), F.lit(', """""\n'))
    short = F.concat(F.lit("segment,other,id\r\n"), segment, F.lit(",ñ,"), k)
    content = F.when(k % 2 == 0, F.encode(full, "UTF-8")).otherwise(F.encode(short, "ISO-8859-1"))
    return robust_csv_rows(table(spark, sf, "customer").select(content.alias("content")), ["id", "name", "segment"])


# Latin-1 bytes without the positions that code page 1252 gives other letters; other texts are written as UTF-8.
LATIN = r"^[\x00-\x7f\u00a0-\u00ff]*$"


@query("decoded_lines", """
WITH d AS (SELECT doc_id, text, doc_id % 2 = 0 OR NOT regexp_full_match(text, '[\\x00-\\x7f\\x{a0}-\\x{ff}]*', 's') AS utf8 FROM documents)
SELECT doc_id, CASE WHEN utf8 OR NOT regexp_matches(text, '[^\\x00-\\x7f]') THEN 'utf-8-sig' ELSE 'cp1252' END AS encoding,
       len(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS n_lines, md5(text) AS digest FROM d""")
def decoded_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as UTF-8 or Latin-1 bytes, decoded and split into lines again."""
    utf8 = (F.col("doc_id") % 2 == 0) | ~F.col("text").rlike(LATIN)
    files = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("path"), F.col("doc_id").alias("name"),
        F.when(utf8, F.encode("text", "UTF-8")).otherwise(F.encode(F.when(~utf8, F.col("text")), "ISO-8859-1")).alias("content"))
    lines = line_table(files).groupBy("name", "encoding").agg(F.count(F.lit(1)).alias("n_lines"))
    digests = files.select("name", F.md5(decode_text(F.col("content"))["text"].cast("binary")).alias("digest"))
    return lines.join(digests, "name").select(F.col("name").alias("doc_id"), "encoding", "n_lines", "digest")
