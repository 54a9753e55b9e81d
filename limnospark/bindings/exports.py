"""Table export and registry export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import query, rnd, rounded, table
from limnospark.operators.groups import grouped_median
from limnospark.operators.matching import first_match_lookup, masked_lookup
from limnospark.plans import registry_export
from limnospark.plans.table_export import ExportRequest, export_blocks, run_export

MONTHS = [f"1997{m:02d}" for m in range(1, 13)]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as a normalized table: instrument = return flag, station = supplier modulo 20."""
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("instrument"), F.when(F.col("l_suppkey") % 2 == 0, (F.col("l_suppkey") % 20).cast("string"))
        .otherwise(F.concat(F.lit("p"), F.col("l_suppkey") % 20)).alias("station_id"), F.col("l_linestatus").alias("station_name"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("measurement_date"), F.col("l_linenumber").alias("measurement_time"),
        F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("price"), "l_orderkey", "l_partkey", "l_suppkey")


LINES_SQL = """
WITH l AS (SELECT l_returnflag AS instrument, 'P' || (l_suppkey % 20) AS station_id, l_linestatus AS station_name, strftime(l_shipdate, '%Y%m%d') AS d, strftime(l_shipdate, '%Y%m') AS period,
                  l_linenumber, l_quantity AS q, l_extendedprice AS price, l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) = 1997)
"""


@query("export_flat", f"""
SELECT l_returnflag AS instrument, CASE WHEN l_suppkey % 2 = 0 THEN (l_suppkey % 20)::VARCHAR ELSE 'p' || (l_suppkey % 20) END AS station_id, l_linestatus AS station_name,
       strftime(l_shipdate, '%Y-%m-%d') AS measurement_date, l_linenumber AS measurement_time, l_quantity AS q
FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 20 IN (3, 4) AND l_shipdate >= DATE '1996-06-01'""")
def export_flat(spark: SparkSession, sf: str) -> DataFrame:
    return run_export(_lines(spark, sf), ExportRequest(instrument="a", points=["3", "P4"], parameters=["q"], early="19960601"))


def _wide_sql(aggregate: dict[str, str], keys: str = "instrument, station_id") -> str:
    cells = ", ".join(f"{rnd(a.replace('@', m), 6)} AS \"{m} | {p}\"" for m in MONTHS for p, a in aggregate.items())
    return f"SELECT {keys}, {cells} FROM l GROUP BY {keys}"


def _pivot(spark: SparkSession, sf: str, method: str, parameters: list[str], **more) -> DataFrame:
    request = ExportRequest(parameters=parameters, early="19970101", late="19971231", grouping="monthly", aggregation=method, **more)
    wide = run_export(_lines(spark, sf), request)
    return wide.select(*[
        (F.round(F.col(f"`{c}`"), 6) + F.lit(0.0)).alias(c) if " | " in c else F.col(c) for c in wide.columns
    ])


@query("export_pivot_monthly", LINES_SQL + _wide_sql({
    "q": "avg(CASE WHEN period = '@' THEN q END)", "price": "avg(CASE WHEN period = '@' THEN price END)"}))
def export_pivot_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _pivot(spark, sf, "mean", ["q", "price"])


@query("export_pivot_sum", LINES_SQL + _wide_sql({"q": "sum(CASE WHEN period = '@' THEN q END)"}))
def export_pivot_sum(spark: SparkSession, sf: str) -> DataFrame:
    return _pivot(spark, sf, "sum", ["q"])


@query("export_pivot_median", LINES_SQL + _wide_sql({"price": "median(CASE WHEN period = '@' THEN price END)"}))
def export_pivot_median(spark: SparkSession, sf: str) -> DataFrame:
    return _pivot(spark, sf, "median", ["price"])


@query("export_pivot_medians", LINES_SQL + _wide_sql({p: f"median(CASE WHEN period = '@' THEN {p} END)" for p in ("q", "price", "l_partkey")}))
def export_pivot_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Exact medians of three parameters at once."""
    return _pivot(spark, sf, "median", ["q", "price", "l_partkey"])


@query("export_daily_blocks", LINES_SQL + f""",
days AS (SELECT strftime(unnest(generate_series(DATE '1997-01-01', DATE '1997-12-31', INTERVAL 1 DAY)), '%Y%m%d') AS day),
means AS (SELECT instrument, station_id, d AS day, avg(q) AS q FROM l GROUP BY ALL)
SELECT k.instrument, k.station_id, day, {rnd('m.q', 6)} AS q FROM (SELECT DISTINCT instrument, station_id FROM l) k CROSS JOIN days LEFT JOIN means m USING (instrument, station_id, day)""")
def export_daily_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """A daily pivot of a year in blocks of 73 days, their cells as rows again."""
    request = ExportRequest(parameters=["q"], early="19970101", late="19971231", grouping="daily")
    out = None
    for periods, wide in export_blocks(_lines(spark, sf), request, width=73, filled=False):
        cells = F.inline(F.array(*[F.struct(F.lit(p).alias("day"), F.col(f"`{p} | q`").alias("q")) for p in periods]))
        rows = wide.select("instrument", "station_id", cells)
        out = rows if out is None else out.unionByName(rows)
    return rounded(out, {"q": 6})


@query("export_pivot_first", LINES_SQL + _wide_sql({
    "q": "arg_min(q, (l_orderkey, l_linenumber, l_partkey, l_suppkey, price)) FILTER (period = '@')"}))
def export_pivot_first(spark: SparkSession, sf: str) -> DataFrame:
    return _pivot(spark, sf, "first", ["q"], order=("l_orderkey", "measurement_time", "l_partkey", "l_suppkey", "price"))


@query("export_pivot_points", LINES_SQL + f""",
wanted AS (SELECT instrument, s.station_id FROM (SELECT DISTINCT instrument FROM l WHERE station_id IN ('P5', 'P7')) i, (VALUES ('P5'), ('P7'), ('P99')) s(station_id))
SELECT w.instrument, w.station_id, {", ".join(f"max(CASE WHEN period = '{m}' THEN q END) AS \"{m} | q\"" for m in MONTHS)}
FROM wanted w LEFT JOIN l ON l.instrument = w.instrument AND l.station_id = w.station_id GROUP BY ALL""")
def export_pivot_points(spark: SparkSession, sf: str) -> DataFrame:
    """Rows for every requested point, also the one without data."""
    return _pivot(spark, sf, "max", ["q"], points=["5", "P7", "99"])


@query("export_complete_long", LINES_SQL + f""",
g AS (SELECT instrument, station_id, period, min(q) AS q FROM l WHERE d BETWEEN '19970110' AND '19970520' AND instrument = 'R' GROUP BY ALL),
cal AS (SELECT DISTINCT instrument, station_id, p.period FROM g, (VALUES ('199701'), ('199702'), ('199703'), ('199704'), ('199705')) p(period))
SELECT cal.instrument, cal.station_id, cal.period, q FROM cal LEFT JOIN g USING (instrument, station_id, period)""")
def export_complete_long(spark: SparkSession, sf: str) -> DataFrame:
    request = ExportRequest(instrument="R", parameters=["q"], early="19970110", late="19970520", grouping="monthly", aggregation="min")
    return run_export(_lines(spark, sf), request, long=True)


@query("grouped_median", f"SELECT l_returnflag, {rnd('median(l_extendedprice)')} AS median, {rnd('median(l_quantity)')} AS median_q FROM lineitem GROUP BY 1")
def grouped_median_query(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    # A low limit treats every flag as hot, which splits each of them.
    prices = grouped_median(lines, ["l_returnflag"], "l_extendedprice", min_rows=1000)
    out = prices.join(grouped_median(lines, ["l_returnflag"], "l_quantity", "median_q"), "l_returnflag")
    return rounded(out, {"median": 4, "median_q": 4})


# Selections: one per order, under a station that has no measurement for every seventh customer; measurements are
# orders, by customer and day. The raw rows of every fourth order stand under another station.
SELECTION_SQL = """
sel AS (SELECT DISTINCT (o_custkey + CASE WHEN o_custkey % 7 = 0 THEN 100000000 ELSE 0 END)::VARCHAR AS station_id, strftime(o_orderdate, '%Y%m%d') AS measurement_date, '101500' AS measurement_time,
               CASE o_custkey % 5 WHEN 0 THEN 'm9' WHEN 1 THEN 'flowtracker' ELSE 'molinete' END AS instrument, 'E' || o_custkey || strftime(o_orderdate, '%Y%m%d') AS export_id
        FROM orders),
meas AS (SELECT o_custkey::VARCHAR AS station_id, strftime(o_orderdate, '%Y%m%d') AS measurement_date, '101500' AS measurement_time,
                CASE o_custkey % 5 WHEN 0 THEN 'm9' WHEN 1 THEN 'flowtracker' ELSE 'molinete' END AS instrument, o_totalprice AS q, o_orderkey FROM orders),
raw AS (SELECT station_id || CASE WHEN o_orderkey % 4 = 0 THEN '/raw' ELSE '' END AS station_id, measurement_date, measurement_time, instrument, min(o_orderkey) AS o_orderkey, max(q) AS q FROM meas GROUP BY ALL)
"""
REGISTRY_SQL = f"""
WITH {SELECTION_SQL},
parts AS (SELECT p_partkey::VARCHAR AS id, (p_partkey % 1900)::VARCHAR AS nro_serie, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS modelo FROM part),
j AS (SELECT sel.*, (SELECT count(*) FROM meas m WHERE m.station_id = sel.station_id AND m.measurement_date = sel.measurement_date AND m.instrument = sel.instrument) AS mc,
             m.q, w.o_orderkey AS raw_key, w.station_id IS NOT NULL AS has_raw
      FROM sel LEFT JOIN (SELECT station_id, measurement_date, instrument, min(q) AS q FROM meas GROUP BY ALL) m USING (station_id, measurement_date, instrument)
               LEFT JOIN raw w USING (station_id, measurement_date, instrument)),
k AS (SELECT *, CASE WHEN has_raw AND (instrument = 'flowtracker' OR (instrument <> 'm9' AND raw_key % 3 = 0)) THEN (raw_key % 2500)::VARCHAR END AS nro_serie,
             CASE WHEN has_raw AND instrument <> 'm9' AND raw_key % 2 = 0 THEN 'ECONOMY' END AS modelo FROM j),
c AS (SELECT k.*, (SELECT count(*) FROM parts p WHERE (k.nro_serie IS NULL OR p.nro_serie = k.nro_serie) AND (k.modelo IS NULL OR p.modelo = k.modelo)) AS ic,
             (SELECT min(p.id) FROM parts p WHERE (k.nro_serie IS NULL OR p.nro_serie = k.nro_serie) AND (k.modelo IS NULL OR p.modelo = k.modelo)) AS iid,
             concat_ws(',', CASE WHEN nro_serie IS NOT NULL THEN 'nro_serie' END, CASE WHEN modelo IS NOT NULL THEN 'modelo' END) AS mask FROM k),
o AS (SELECT *, CASE WHEN instrument = 'm9' THEN 'instrument not configured' WHEN mc = 0 THEN 'measurement not found' WHEN mc > 1 THEN 'multiple measurements found'
               WHEN mask = '' THEN 'no instrument lookup field is filled' WHEN ic = 0 THEN 'instrument lookup failed: ' || mask
               WHEN ic > 1 THEN 'instrument lookup ambiguous: ' || mask END AS error FROM c)
"""


def _registry(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    k = F.col("o_custkey")
    instrument = F.when(k % 5 == 0, "m9").when(k % 5 == 1, "flowtracker").otherwise("molinete")
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    selection = orders.select(
        (k + F.when(k % 7 == 0, 100000000).otherwise(0)).cast("string").alias("station_id"), day.alias("measurement_date"),
        F.lit("101500").alias("measurement_time"), instrument.alias("instrument"), F.concat(F.lit("E"), k, day).alias("export_id")).distinct()
    normalized = orders.select(
        k.alias("station_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("measurement_date"), F.lit("10:15:00").alias("measurement_time"),
        instrument.alias("instrument"), F.col("o_totalprice").alias("q_total_m3s"))
    raw_station = F.concat(k.cast("string"), F.when(F.col("o_orderkey") % 4 == 0, "/raw").otherwise(""))
    raw = orders.groupBy(raw_station.alias("station_id"), day.alias("measurement_date"), instrument.alias("instrument")).agg(
        F.min("o_orderkey").alias("okey"), F.max("o_totalprice").alias("q"))
    raw = raw.select(
        "station_id", "measurement_date", F.lit("101500.0").alias("measurement_time"), F.upper("instrument").alias("instrument"),
        F.concat(F.lit(" "), F.col("okey") % 2500).alias("serial"), F.when(F.col("okey") % 3 == 0, (F.col("okey") % 2500).cast("string")).alias("serial_3"),
        F.when(F.col("okey") % 2 == 0, "ECONOMY").alias("model"),
        F.concat(F.lit("op"), F.col("okey")).alias("operators"))
    lookups = {
        "instrumentos": table(spark, sf, "part").select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("marca"), F.concat(F.col("p_partkey") % 1900, F.lit(" ")).alias("nro_serie"),
            F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("").alias("modelo"), F.lit(None).cast("string").alias("codigo")),
        "tipos_aforos": table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("descripcion"), F.col("n_nationkey").alias("row_no")),
        "instrumentos_rangos": table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("descripcion"), F.col("r_regionkey").alias("row_no")),
    }
    config = {"instruments": {
        "flowtracker": {"id_tipo_actuacion": 4, "tipo_aforo_lookup": "FRANCE", "instrumentos_rangos_lookup": "asia",
                        "instrument_lookup_fields": {"marca": None, "nro_serie": "serial", "modelo": "model"}, "raw_canonical_fields": {"id_operador": "operators"},
                        "normalized_fields": {"caudal": "q_total_m3s"}},
        "molinete": {"id_tipo_actuacion": 5, "id_tipo_aforo": "X", "instrumentos_rangos_lookup": "ASIA", "instrument_lookup_fields": {"modelo": "model", "nro_serie": "serial_3"},
                     "raw_canonical_fields": {"observaciones": "operators"}, "normalized_fields": {"caudal": "q_total_m3s"}},
    }}
    return registry_export.run(selection, normalized, raw, lookups, config)


@query("registry_log", REGISTRY_SQL + """
SELECT CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status, export_id, instrument, station_id, measurement_date, measurement_time,
       has_raw AS raw_canonical_found, error FROM o""")
def registry_log(spark: SparkSession, sf: str) -> DataFrame:
    return _registry(spark, sf)["log"]


@query("registry_visits", REGISTRY_SQL + """
SELECT export_id, '' AS id, station_id AS id_estacion, CASE WHEN instrument = 'flowtracker' AND has_raw THEN 'op' || raw_key ELSE '' END AS id_operador,
       CASE instrument WHEN 'flowtracker' THEN '4' ELSE '5' END AS id_tipo_actuacion, iid AS id_instrumento,
       substr(measurement_date, 7, 2) || '/' || substr(measurement_date, 5, 2) || '/' || left(measurement_date, 4) || ' 10:15:00' AS fecha,
       false AS pendiente, false AS relevante, '' AS lectura_escala, CASE WHEN instrument = 'molinete' AND has_raw THEN 'op' || raw_key ELSE '' END AS observaciones
FROM o WHERE error IS NULL""")
def registry_visits(spark: SparkSession, sf: str) -> DataFrame:
    return _registry(spark, sf)["visits"]


@query("registry_gaugings", REGISTRY_SQL + """
SELECT export_id, station_id AS id_estacion, iid AS id_instrumento, CASE instrument WHEN 'flowtracker' THEN coalesce((SELECT min(n_nationkey)::VARCHAR FROM nation WHERE n_name = 'FRANCE'), '') ELSE 'X' END AS id_tipo_aforo,
       CASE instrument WHEN 'flowtracker' THEN '' ELSE coalesce((SELECT min(r_regionkey)::VARCHAR FROM region WHERE r_name = 'ASIA'), '') END AS id_instrumentos_rangos,
       round(q, 2) AS caudal FROM o WHERE error IS NULL""")
def registry_gaugings(spark: SparkSession, sf: str) -> DataFrame:
    out = _registry(spark, sf)["gaugings"].select("export_id", "id_estacion", "id_instrumento", "id_tipo_aforo", "id_instrumentos_rangos", "caudal")
    return out.withColumn("caudal", F.round(F.col("caudal").cast("double"), 2))


@query("optional_lookup", """
WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Brand#' || (s_suppkey % 26) END AS brand, CASE WHEN s_suppkey % 3 = 0 THEN 'ECONOMY' END AS type,
                  CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey % 50 END AS size FROM supplier),
p AS (SELECT p_partkey, p_brand, p_type, p_size FROM part)
SELECT s_suppkey, concat_ws(',', CASE WHEN brand IS NOT NULL THEN 'brand' END, CASE WHEN type IS NOT NULL THEN 'type' END, CASE WHEN size IS NOT NULL THEN 'size' END) AS lookup_mask,
       CASE WHEN brand IS NULL AND type IS NULL AND size IS NULL THEN 0 ELSE (SELECT count(*) FROM p WHERE (brand IS NULL OR p_brand = brand) AND (type IS NULL OR p_type = type) AND (size IS NULL OR p_size = size)) END AS lookup_count
FROM r""")
def optional_lookup(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    requests = table(spark, sf, "supplier").select(
        "s_suppkey", F.when(k % 2 == 0, F.concat(F.lit("Brand#"), k % 26)).otherwise(" ").alias("brand"), F.when(k % 3 == 0, "ECONOMY").alias("type"),
        F.when(k % 5 == 0, k % 50).alias("size"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size"))
    return masked_lookup(requests, parts, {c: F.col(c) for c in ("brand", "type", "size")}, "id").select("s_suppkey", "lookup_mask", "lookup_count")


@query("single_lookup", """
SELECT c_custkey, coalesce((SELECT arg_min(p_partkey, p_partkey)::VARCHAR FROM part WHERE p_size = c_nationkey + 1), '') AS part FROM customer""")
def single_lookup(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return first_match_lookup(customers, parts, F.col("c_nationkey") + 1, "p_size", "p_partkey", "p_partkey", "part").drop("c_nationkey")


@query("selection_builder", """
WITH s AS (SELECT o_custkey::VARCHAR AS station_id, strftime(o_orderdate, '%Y%m%d') AS measurement_date, lpad((o_orderkey % 86400)::VARCHAR, 6, '0') AS measurement_time,
                  o_orderstatus AS instrument FROM orders WHERE o_orderstatus IN ('F', 'O') AND strftime(o_orderdate, '%Y%m%d') >= '19960101'),
n AS (SELECT *, row_number() OVER (ORDER BY instrument, station_id, measurement_date, measurement_time) AS r FROM s)
SELECT station_id, measurement_date, measurement_time, instrument, 'SEL' || lpad(r::VARCHAR, greatest(3, length(r::VARCHAR))::INT, '0') AS export_id FROM n""")
def selection_builder(spark: SparkSession, sf: str) -> DataFrame:
    summary = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("station_id"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("measurement_date"),
        (F.col("o_orderkey") % 86400).cast("string").alias("measurement_time"), F.col("o_orderstatus").alias("instrument"))
    return registry_export.build_selection(summary, ["F", "O"], early="19960101", prefix="SEL")
