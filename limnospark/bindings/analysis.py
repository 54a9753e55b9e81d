"""Stage-discharge, quality and profile jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from limnospark.functions.numbers import coefficients_struct
from limnospark.bindings.registry import iso, query, rnd, rounded, table
from limnospark.operators import regression
from limnospark.operators.choose import with_best_series
from limnospark.plans import quality, section_profiles, stage_discharge
from limnospark.sources import series

GROUP = ("station_id", "instrument")
# A measurement is an order line: station = supplier, stage = quantity, flow = price.
FIT_SQL = """
WITH d AS (SELECT l_suppkey AS station_id, l_returnflag AS instrument, l_quantity AS x, l_extendedprice AS y FROM lineitem),
c AS (SELECT *, avg(x) OVER g AS mx, avg(y) OVER g AS my FROM d WINDOW g AS (PARTITION BY station_id, instrument)),
s AS (SELECT station_id, instrument, count(*) AS n, any_value(mx) AS mx, any_value(my) AS my, sum((x-mx)^2)/count(*) AS m2, sum((x-mx)^3)/count(*) AS m3,
             sum((x-mx)^4)/count(*) AS m4, sum((x-mx)*(y-my))/count(*) AS cuv, sum((x-mx)^2*(y-my))/count(*) AS cu2v,
             regr_slope(ln(y), ln(x)) AS lb, regr_intercept(ln(y), ln(x)) AS la FROM c GROUP BY 1, 2),
q AS (SELECT *, (cuv * (m4 - m2*m2) - cu2v * m3) / (m2 * (m4 - m2*m2) - m3*m3) AS p, (m2 * cu2v - m3 * cuv) / (m2 * (m4 - m2*m2) - m3*m3) AS qq FROM s),
fits AS (
  SELECT station_id, instrument, 'poly1' AS model, n, cuv / m2 AS a, my - cuv / m2 * mx AS b, NULL::DOUBLE AS c FROM q
  UNION ALL SELECT station_id, instrument, 'poly2', n, qq, p - 2 * qq * mx, my - p * mx + qq * (mx*mx - m2) FROM q
  UNION ALL SELECT station_id, instrument, 'power', n, exp(la), lb, NULL FROM q),
e AS (SELECT f.*, d.x, d.y, CASE model WHEN 'poly1' THEN a*x+b WHEN 'poly2' THEN a*x*x+b*x+f.c ELSE a*pow(x, b) END AS p, avg(y) OVER (PARTITION BY station_id, instrument, model) AS my
      FROM fits f JOIN d USING (station_id, instrument)),
metrics AS (SELECT station_id, instrument, model, count(*) AS n_points, 1 - sum((y-p)^2) / sum((y-my)^2) AS r2, sqrt(avg((y-p)^2)) AS rmse, avg(abs(y-p)) AS mae,
                   sqrt(avg((y-p)^2)) / avg(y) AS nrmse, avg(p-y) AS bias, 100*sum(p-y)/sum(y) AS pbias_pct FROM e GROUP BY 1, 2, 3)
"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station_id"), F.col("l_returnflag").alias("instrument"), F.col("l_quantity").alias("stage_m"),
        F.col("l_extendedprice").alias("q_total_ls"))


@query("stage_fits", FIT_SQL + f"""
SELECT station_id, instrument, model, n AS n_points, {rnd('a')} AS a, {rnd('b')} AS b, {rnd('c')} AS c FROM fits""")
def stage_fits(spark: SparkSession, sf: str) -> DataFrame:
    fits = stage_discharge.fit(_pairs(spark, sf), GROUP)["fits"]
    named = fits.select(*GROUP, "model", "n_points", coefficients_struct(F.col("coefficients")).alias("k"))
    return rounded(named.select(*GROUP, "model", "n_points", "k.*"), {"a": 4, "b": 4, "c": 4})


# Rows of the first two lines of an order carry no finite flow.
@query("stage_fits_nonfinite", FIT_SQL.replace("FROM lineitem)", "FROM lineitem WHERE l_linenumber > 2)") + f"""
SELECT station_id, instrument, model, n_points, {rnd('r2', 6)} AS r2, {rnd('rmse')} AS rmse FROM metrics""")
def stage_fits_nonfinite(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    flow = F.when(line == 1, float("nan")).when(line == 2, float("-inf")).otherwise(F.col("l_extendedprice"))
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station_id"), F.col("l_returnflag").alias("instrument"), F.col("l_quantity").alias("stage_m"), flow.alias("q_total_ls"))
    metrics = stage_discharge.fit(rows, GROUP)["metrics"].select(*GROUP, "model", "n_points", "r2", "rmse")
    return rounded(metrics, {"r2": 6, "rmse": 4})


DIGITS = {"r2": 6, "rmse": 4, "mae": 4, "nrmse": 6, "bias": 4, "pbias_pct": 6}
METRIC_SQL = ", ".join(f"{rnd(c, d)} AS {c}" for c, d in DIGITS.items())


@query("stage_metrics", FIT_SQL + f"SELECT station_id, instrument, model, n_points, {METRIC_SQL} FROM metrics")
def stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stage_discharge.fit(_pairs(spark, sf), GROUP)["metrics"].drop("nse"), DIGITS)


@query("stage_best", FIT_SQL + f"""
SELECT station_id, instrument, model, n_points, {METRIC_SQL} FROM metrics
QUALIFY row_number() OVER (PARTITION BY station_id, instrument ORDER BY mae, model) = 1""")
def stage_best(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stage_discharge.fit(_pairs(spark, sf), GROUP, "mae")["best"].drop("nse"), DIGITS)


@query("stage_curve", FIT_SQL + f""",
best AS (SELECT station_id, instrument, model FROM metrics QUALIFY row_number() OVER (PARTITION BY station_id, instrument ORDER BY r2 DESC, model) = 1),
span AS (SELECT station_id, instrument, min(x) AS lo, max(x) AS hi FROM d GROUP BY 1, 2),
grid AS (SELECT *, lo + (hi - lo) * step / 79 AS x FROM best JOIN fits USING (station_id, instrument, model) JOIN span USING (station_id, instrument), range(80) t(step))
SELECT station_id, instrument, model, CAST(step AS INT) AS step, {rnd('x', 6)} AS x,
       {rnd("CASE model WHEN 'poly1' THEN a*x+b WHEN 'poly2' THEN a*x*x+b*x+c ELSE a*pow(x, b) END")} AS y FROM grid""")
def stage_curve(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf)
    fitted = stage_discharge.fit(pairs, GROUP)
    return rounded(regression.curve_points(fitted["best"], fitted["fits"], pairs, GROUP, "stage_m"), {"x": 6, "y": 4})


# Summary rows of the whole analysis: one order each, several orders of a customer on a day compete.
STAGE_SQL = """
WITH s AS (SELECT 'P' || (o_custkey // 3) AS station_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, lpad((o_orderkey % 86400)::VARCHAR, 6, '0') AS t, o_orderkey AS run_id,
                  CASE o_orderstatus WHEN 'O' THEN 'flowtracker' WHEN 'F' THEN 'molinete' ELSE 'nivus' END AS instrument, o_totalprice AS q,
                  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 100 END AS mean_depth FROM orders),
deep AS (SELECT l_orderkey AS run_id, max(l_quantity) AS max_depth FROM lineitem GROUP BY 1),
m AS (SELECT 'P' || (c_custkey // 3) AS station_id, DATE '1997-01-01' + CAST(c_custkey % 2 AS INT) * INTERVAL 1 MONTH AS d, c_acctbal AS manual FROM customer),
j AS (SELECT s.*, max_depth, manual FROM s LEFT JOIN deep USING (run_id) LEFT JOIN m ON m.station_id = s.station_id AND m.d = s.d),
r AS (SELECT *, CASE instrument WHEN 'nivus' THEN 0 WHEN 'molinete' THEN 1 ELSE 999 END AS rank FROM j),
best AS (SELECT station_id, d, arg_min(instrument, (rank, instrument, t, run_id)) AS instrument, arg_min(q, (rank, instrument, t, run_id)) AS q,
                arg_min(mean_depth, (rank, instrument, t, run_id)) FILTER (mean_depth IS NOT NULL) AS mean_depth,
                arg_min(max_depth, (rank, instrument, t, run_id)) FILTER (max_depth IS NOT NULL) AS max_depth, min(rank) AS rank,
                arg_min(manual, (rank, instrument, t, run_id, manual)) FILTER (manual IS NOT NULL) AS manual FROM r GROUP BY 1, 2),
a AS (SELECT station_id, d, instrument, instrument AS analysis_group, rank, q, mean_depth, max_depth, manual FROM r
      UNION ALL SELECT station_id, d, instrument, 'BEST', rank, q, mean_depth, max_depth, manual FROM best),
long AS (SELECT station_id, d, instrument, analysis_group, rank, q, 'manual' AS stage_type, manual AS stage FROM a
         UNION ALL SELECT station_id, d, instrument, analysis_group, rank, q, 'mean', mean_depth FROM a
         UNION ALL SELECT station_id, d, instrument, analysis_group, rank, q, 'max', max_depth FROM a)
"""


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("p0"), F.expr("o_custkey div 3")).alias("station_id"), F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd").alias("measurement_date"),
        F.lpad((k % 86400).cast("string"), 6, "0").alias("measurement_time"),
        F.when(F.col("o_orderstatus") == "O", " FlowTracker").when(F.col("o_orderstatus") == "F", "molinete").otherwise("nivus").alias("instrument"),
        F.col("o_totalprice").cast("string").alias("q_total_ls"), F.when(k % 3 != 0, F.col("o_totalprice") / 100).alias("depth_mean_m"), k.alias("run_id"))


def _manual(spark: SparkSession, sf: str) -> DataFrame:
    month = F.add_months(F.to_date(F.lit("1997-01-01")), (F.col("c_custkey") % 2).cast("int"))
    return table(spark, sf, "customer").select(
        F.concat(F.lit("P"), F.expr("c_custkey div 3")).alias("station_id"), month.alias("measurement_date"), F.col("c_acctbal").alias("manual_stage_m"))


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    deepest = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(F.max("l_quantity").alias("instrument_stage_max_m"))
    df = stage_discharge.standardize(_summary(spark, sf)).join(deepest, "run_id", "left")
    return stage_discharge.match_manual(df, series.manual_stage(_manual(spark, sf)))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    df = _matched(spark, sf)
    return with_best_series(
        df, ["station_id", "measurement_date"], "instrument", ["nivus", "molinete"], ["measurement_time", "run_id", "manual_stage_m"])


@query("stage_long", STAGE_SQL + f"""
SELECT station_id, strftime(d, '%Y-%m-%d') AS measurement_date, instrument, analysis_group, rank, {rnd('q', 2)} AS q_total_ls, stage_type, {rnd('stage', 6)} AS stage_m
FROM long WHERE stage IS NOT NULL AND q IS NOT NULL""")
def stage_long(spark: SparkSession, sf: str) -> DataFrame:
    pairs = stage_discharge.analysis_pairs(_ranked(spark, sf), "ambas", "both").withColumn("measurement_date", iso("measurement_date"))
    out = pairs.select("station_id", "measurement_date", "instrument", "analysis_group", "rank", "q_total_ls", "stage_type", "stage_m")
    return rounded(out, {"q_total_ls": 2, "stage_m": 6})


@query("stage_selected", STAGE_SQL + f"""
SELECT station_id, strftime(d, '%Y-%m-%d') AS measurement_date, t AS measurement_time, instrument, run_id, {rnd('q', 2)} AS q_total_ls, {rnd('manual', 2)} AS manual_stage_m,
       max_depth AS instrument_stage_max_m
FROM j WHERE station_id IN ('P7', 'P12') AND d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def stage_selected(spark: SparkSession, sf: str) -> DataFrame:
    df = stage_discharge.select_points(_matched(spark, sf), ["7", "p012"])
    df = stage_discharge.select_dates(df, "19960101", "1999-12-31").withColumn("q_total_ls", F.col("q_total_ls").cast("double"))
    out = df.select("station_id", iso("measurement_date").alias("measurement_date"), "measurement_time", "instrument", "run_id", "q_total_ls", "manual_stage_m", "instrument_stage_max_m")
    return rounded(out, {"q_total_ls": 2, "manual_stage_m": 2})


@query("stage_max_depth", """
SELECT 'P' || l_suppkey AS station_id, strftime(l_shipdate, '%Y-%m-%d') AS measurement_date, NULL AS measurement_time, lower(l_returnflag) AS instrument,
       max(l_quantity) AS instrument_stage_max_m FROM lineitem WHERE l_linenumber % 3 <> 0 GROUP BY ALL""")
def stage_max_depth(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P0"), F.col("l_suppkey")).alias("point"), F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
        F.lit(None).cast("string").alias("measurement_time"), F.col("l_returnflag").alias("instrument"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity").cast("string")).otherwise("n/a").alias("depth_m"))
    return stage_discharge.max_stage(stage_discharge.standardize(points)).withColumn("measurement_date", iso("measurement_date"))


LOG_SQL = """,
n AS (SELECT * FROM long WHERE stage IS NOT NULL AND q IS NOT NULL)
SELECT 'rows_diagnostic' AS metric, count(*) AS value FROM a UNION ALL SELECT 'rows_matched', count(*) FROM a UNION ALL SELECT 'rows_analysis', count(*) FROM n
UNION ALL SELECT 'analysis_rows_input', count(*) FROM long UNION ALL SELECT 'analysis_rows_output', count(*) FROM n
UNION ALL SELECT 'analysis_rows_removed_missing_required', (SELECT count(*) FROM long) - (SELECT count(*) FROM n)
UNION ALL SELECT 'manual_stage_matched', count(manual) FROM a UNION ALL SELECT 'manual_stage_missing', count(*) - count(manual) FROM a
UNION ALL SELECT 'analysis_group.' || analysis_group, count(*) FROM a GROUP BY 1
UNION ALL SELECT 'instrument.' || instrument, count(*) FROM a GROUP BY 1
UNION ALL SELECT 'analysis_stage_origin.' || CASE stage_type WHEN 'manual' THEN 'manual' ELSE 'instrument' END, count(*) FROM n GROUP BY 1
UNION ALL SELECT 'analysis_stage_type.' || stage_type, count(*) FROM n GROUP BY 1"""


@query("stage_log", STAGE_SQL + LOG_SQL)
def stage_log(spark: SparkSession, sf: str) -> DataFrame:
    ranked = _ranked(spark, sf)
    return stage_discharge.log_rows(ranked, ranked, stage_discharge.pair_rows(ranked))


# The whole run from the tables: the deepest point comes by station, day, time and instrument.
RUN_SQL = STAGE_SQL.replace(
    "deep AS (SELECT l_orderkey AS run_id, max(l_quantity) AS max_depth FROM lineitem GROUP BY 1)",
    "deep AS (SELECT station_id, d, t, instrument, max(l_quantity) AS max_depth FROM lineitem JOIN s ON run_id = l_orderkey GROUP BY ALL)",
).replace("LEFT JOIN deep USING (run_id)", "LEFT JOIN deep USING (station_id, d, t, instrument)")


def _run(spark: SparkSession, sf: str, **options) -> dict[str, DataFrame]:
    summary = _summary(spark, sf)
    points = summary.join(table(spark, sf, "lineitem"), F.col("run_id") == F.col("l_orderkey")).select(
        "station_id", "measurement_date", "measurement_time", "instrument", F.col("l_quantity").alias("depth_m"))
    manual = series.manual_stage(_manual(spark, sf))
    return stage_discharge.run(summary, points, manual, {
        "instruments": {name: {"enabled": True} for name in ("flowtracker", "molinete", "nivus")},
        "instrument_selection": {"ranking": ["nivus", "molinete"]}, "selection": {"points": "all", "depth_mode": "ambas"}}, **options)


@query("stage_run_log", RUN_SQL + LOG_SQL)
def stage_run_log(spark: SparkSession, sf: str) -> DataFrame:
    return _run(spark, sf)["log"]


@query("stage_run_best", RUN_SQL + f""",
n AS (SELECT station_id, analysis_group, instrument, stage_type, stage AS x, q AS y FROM long WHERE stage IS NOT NULL AND q IS NOT NULL),
c AS (SELECT *, avg(x) OVER g AS mx FROM n WINDOW g AS (PARTITION BY station_id, analysis_group, instrument, stage_type)),
f AS (SELECT station_id, analysis_group, instrument, stage_type, count(*) AS n_points, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
      FROM c GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3 AND var_pop(x) > 0)
SELECT station_id, analysis_group, instrument, stage_type, n_points, {rnd('a', 3)} AS a, {rnd('b', 2)} AS b FROM f""")
def stage_run_best(spark: SparkSession, sf: str) -> DataFrame:
    """Straight lines of the whole run, for groups whose stages differ."""
    out = _run(spark, sf)
    keys = ["station_id", "analysis_group", "instrument", "stage_origin", "stage_type"]
    moving = out["analysis_pairs"].groupBy(*keys).agg((F.max("stage_m") > F.min("stage_m")).alias("moves")).where("moves").drop("moves")
    lines = out["fits"].where("model = 'poly1'").join(moving, keys)
    return rounded(lines.select("station_id", "analysis_group", "instrument", "stage_type", "n_points", "a", "b"), {"a": 3, "b": 2})


@query("stage_wide", f"""
SELECT 'P' || l_suppkey AS station_id, strftime(l_shipdate, '%Y-%m-%d') AS measurement_date, l_orderkey AS run_id, l_returnflag AS instrument,
       min(CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END) AS stage_manual_m, min(CASE WHEN l_linenumber % 3 = 1 THEN l_quantity END) AS stage_mean_m,
       min(CASE WHEN l_linenumber % 3 = 2 THEN l_quantity END) AS stage_max_m
FROM lineitem GROUP BY ALL""")
def stage_wide(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber") % 3
    pairs = table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_suppkey")).alias("station_id"), iso("l_shipdate").alias("measurement_date"), F.col("l_orderkey").alias("run_id"),
        F.col("l_returnflag").alias("instrument"), F.when(n == 0, "manual").when(n == 1, "mean").otherwise("max").alias("stage_type"), F.col("l_quantity").alias("stage_m"))
    return stage_discharge.wide_stages(pairs)


@query("quality_cg", f"""
SELECT l_orderkey, count(*) AS n_pairs, {rnd('sum(l_discount * 100 * l_tax * 100) / nullif(sum(l_discount * 100), 0)', 6)} AS cg,
       CASE WHEN sum(l_discount * 100) = 0 THEN 'error: weights sum to zero' ELSE 'ok' END AS status FROM lineitem GROUP BY 1""")
def quality_cg(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_discount") * -100).alias("w"), (F.col("l_tax") * 100).alias("t"))
    return rounded(quality.weighted_scores(rows, ["l_orderkey"], "w", "t"), {"cg": 6})


# A file is an order (named by customer and date); raw rows of orders divisible by 7 lack their last row.
QUALITY_SQL = """
WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_extendedprice, l_linenumber) AS r, count(*) OVER (PARTITION BY l_orderkey) AS n,
                  l_discount * 100 AS w, l_tax * 100 AS t FROM lineitem),
f AS (SELECT l.*, CASE WHEN l_orderkey % 50 = 0 THEN 'bad name' || l_orderkey ELSE 'P' || l_orderkey || '_Points_' || strftime(o_orderdate, '%Y%m%d') || '_101500.csv' END AS file,
             'P' || l_orderkey AS point, strftime(o_orderdate, '%Y%m%d') AS date, l_orderkey % 50 = 0 AS bad FROM l JOIN orders ON o_orderkey = l_orderkey),
s AS (SELECT file, point, date, bad, count(*) AS n, count(CASE WHEN l_orderkey % 7 <> 0 OR r < f.n THEN 1 END) AS raw_n,
             sum(w) AS sw, sum(w * t) AS swt FROM f GROUP BY ALL),
o AS (SELECT *, CASE WHEN bad THEN 'skipped' WHEN raw_n = 0 THEN 'missing_raw' WHEN raw_n <> n OR sw = 0 THEN 'error' ELSE 'ok' END AS status FROM s)
"""


def _quality(spark: SparkSession, sf: str, **options) -> dict[str, DataFrame]:
    order = W.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber")
    lines = table(spark, sf, "lineitem").withColumns({"row_no": F.row_number().over(order), "n": F.count(F.lit(1)).over(W.partitionBy("l_orderkey"))})
    name = F.when(F.col("l_orderkey") % 50 == 0, F.concat(F.lit("bad name"), F.col("l_orderkey"))).otherwise(
        F.concat(F.lit("P"), F.col("l_orderkey"), F.lit("_Points_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_101500.csv")))
    rows = lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("file", name)
    normalized = rows.select("file", "row_no", (F.col("l_discount") * 100).alias("percent_q"))
    raw = rows.where("l_orderkey % 7 <> 0 or row_no < n").select("file", "row_no", (F.col("l_tax") * 100).alias("tq [%]"))
    return quality.quality_metrics(normalized, raw, **options)


@query("quality_measurements", QUALITY_SQL + f"""
SELECT point, date, '101500' AS time, left(date, 6) AS period, {rnd('swt / sw', 6)} AS cg, file FROM o WHERE status = 'ok'""")
def quality_measurements(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_quality(spark, sf, grain="monthly")["measurements"], {"cg": 6})


@query("quality_log", QUALITY_SQL + """
SELECT file, status, CASE WHEN status = 'skipped' THEN 'filename_not_recognized' WHEN status = 'missing_raw' THEN 'raw file not found'
         WHEN raw_n <> n THEN 'length mismatch: normalized=' || n || ', raw=' || raw_n WHEN status = 'error' THEN 'weights sum to zero' END AS reason,
       CASE WHEN NOT bad THEN point END AS point FROM o""")
def quality_log(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf)["log"].select("file", "status", "reason", "point")


@query("quality_cg_pivot", QUALITY_SQL + f""",
g AS (SELECT 'P' || (CAST(substr(point, 2) AS INT) % 20) AS point, left(date, 6) AS period, swt / sw AS cg FROM o WHERE status = 'ok' AND left(date, 6) IN ('199801', '199802', '199803'))
SELECT point, CAST(substr(point, 2) AS INT) AS point_number, {", ".join(f"{rnd(f"avg(CASE WHEN period = '{m}' THEN cg END)", 6)} AS \"{m}\"" for m in ('199801', '199802', '199803'))}
FROM g GROUP BY point""")
def quality_cg_pivot(spark: SparkSession, sf: str) -> DataFrame:
    months = ["199801", "199802", "199803"]
    scores = _quality(spark, sf, grain="monthly", months=months)["measurements"]
    scores = scores.withColumn("point", F.concat(F.lit("P"), F.substring("point", 2, 9).cast("int") % 20))
    return rounded(quality.score_pivot(scores, months), {m: 6 for m in months})


PROFILE_INSTRUMENTS = {"a": {"enabled": True, "code": "AA"}, "r": {"enabled": True}, "n": {}}


def profile_points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.lower("l_returnflag").alias("instrument"), F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("p00"), F.col("l_suppkey"))).alias("station_id"),
        F.when(F.col("l_partkey") % 2 == 0, "1970-01-01").otherwise(iso("l_shipdate")).alias("measurement_date"), F.col("l_linenumber").alias("distance_m"),
        F.col("l_quantity").alias("depth_m"),
        F.concat(F.lit("/n/P"), F.col("l_suppkey"), F.lit("_Points_"), F.date_format("l_shipdate", "yyyyMMdd"), F.lit("_101500.csv")).alias("file"))


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    loaded = section_profiles.load_points(profile_points(spark, sf), PROFILE_INSTRUMENTS, "file")
    return section_profiles.select_rows(loaded, start="19960101", end="1999-12-31")


PROFILE_SQL = """
WITH p AS (SELECT 'P' || l_suppkey AS station_id, strftime(l_shipdate, '%Y-%m-%d') AS measurement_date, '10:15:00' AS measurement_time, lower(l_returnflag) AS instrument,
                  CASE l_returnflag WHEN 'A' THEN 'AA' ELSE 'r' END AS instrument_code, l_linenumber AS x, l_quantity AS y,
                  '/n/P' || l_suppkey || '_Points_' || strftime(l_shipdate, '%Y%m%d') || '_101500.csv' AS file
           FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '2000-01-01')
"""


@query("profile_rows", PROFILE_SQL + "SELECT * EXCLUDE (file) FROM p")
def profile_rows(spark: SparkSession, sf: str) -> DataFrame:
    return section_profiles.profile_rows(_profiles(spark, sf).withColumn("measurement_date", iso("measurement_date")))


@query("profile_index", PROFILE_SQL + "SELECT * EXCLUDE (file, x, y), count(*) AS n_rows, min(file) AS source_file FROM p GROUP BY ALL")
def profile_index(spark: SparkSession, sf: str) -> DataFrame:
    return section_profiles.profile_index(_profiles(spark, sf).withColumn("measurement_date", iso("measurement_date")), source="file")
