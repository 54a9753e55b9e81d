"""Correlation of series made from events: a point is a user, a station is an event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.bindings.registry import iso, query, rnd, rounded, table
from limnospark.operators.choose import best_source_daily
from limnospark.plans import correlation
from limnospark.sources import series

INSTRUMENTS = [
    {"code": "PU", "name": "purchase", "subdir": "purchase"}, {"code": "CL", "name": "click", "subdir": "click-log"},
    {"code": "SI", "name": "signup", "subdir": "signup"}, {"code": "ER", "name": "error", "subdir": "error"},
]
RANKING = ["PU", "click"]
METRICS = {
    "slope": 6, "intercept": 6, "mean_y": 6, "rmse_direct": 6, "rmse_regression": 6, "mae": 6, "mape": 4, "r2": 6, "pearson": 6,
    "nrmse_direct": 6, "pbias": 6, "nse": 6,
}


def metrics_sql(pairs: str, keys: str, extra: str = "") -> str:
    """Fit and metrics over the rows (`keys`, day, x, y) of a CTE; needs a leading WITH list."""
    return f""",
fits AS (SELECT {keys}, count(*) AS n, avg(y) AS my,
                CASE WHEN count(*) < 2 OR var_pop(x) = 0 THEN 0 ELSE regr_slope(y, x) END AS slope,
                CASE WHEN count(*) < 2 OR var_pop(x) = 0 THEN avg(y) ELSE regr_intercept(y, x) END AS intercept FROM {pairs} GROUP BY ALL),
fitted AS (SELECT p.*, slope, intercept, my, slope * x + intercept AS pred, y - (slope * x + intercept) AS res FROM {pairs} p JOIN fits USING ({keys})),
sums AS (SELECT {keys}, count(*) AS n, any_value(slope) AS slope, any_value(intercept) AS intercept, avg(y) AS mean_y,
                sqrt(avg((y - x) * (y - x))) AS rmse_direct, sqrt(avg(res * res)) AS rmse_regression, avg(abs(res)) AS mae,
                avg(CASE WHEN y <> 0 THEN abs(res / y) END) * 100 AS mape, sum(res * res) AS sr, sum((y - my) * (y - my)) AS st,
                covar_pop(x, y) AS c, stddev_pop(x) AS sx, stddev_pop(y) AS sy, sum(-res) AS sb, sum(y) AS ty,
                strftime(min(day), '%Y-%m-%d') AS "start", strftime(max(day), '%Y-%m-%d') AS "end"{extra} FROM fitted GROUP BY {keys}),
metrics AS (SELECT *, CASE WHEN n >= 2 THEN CASE WHEN st = 0 THEN CASE WHEN sr = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sr / st END END AS r2,
                   CASE WHEN n >= 2 AND sx * sy <> 0 THEN c / (sx * sy) END AS pearson, rmse_direct / nullif(mean_y, 0) AS nrmse_direct,
                   100 * sb / nullif(ty, 0) AS pbias, CASE WHEN st <> 0 THEN 1 - sr / st END AS nse FROM sums)
"""


METRIC_COLUMNS = ", ".join(f"{rnd(name, digits)} AS {name}" for name, digits in METRICS.items())


def shown(summary: DataFrame, keys: list[str], more: list[str] = ()) -> DataFrame:
    out = summary.withColumns({"start": iso("start"), "end": iso("end")}).select(*keys, "n", *METRICS, "start", "end", *more)
    return rounded(out, METRICS)


GAUGE_SQL = """
raw AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE event_type WHEN 'purchase' THEN 'PU' WHEN 'click' THEN 'CL' WHEN 'signup' THEN 'SI' ELSE 'ER' END AS source, avg(value * 1000) AS q
        FROM events WHERE event_type <> 'view' GROUP BY ALL),
gauges AS (SELECT user_id::VARCHAR AS point, day, source, q FROM raw
           QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY CASE source WHEN 'PU' THEN 0 WHEN 'CL' THEN 1 ELSE 10000 END, source) = 1)
"""
MODEL_SQL = "model AS (SELECT user_id::VARCHAR AS point, CAST(ts AS DATE) AS day, avg(value) * 1000 AS q FROM events WHERE event_type = 'view' GROUP BY ALL)"
STATION_SQL = "stations AS (SELECT event_type AS station, CAST(ts AS DATE) AS day, avg(value * 1000) AS q FROM events GROUP BY ALL)"


def gauges(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where("event_type <> 'view'").select(
        F.concat(F.lit("P"), F.col("user_id")).alias("station_id"), F.date_format("ts", "yyyyMMdd").alias("measurement_date"),
        F.col("event_type").alias("instrument"), F.col("value").alias("q_total_m3s"))
    named = rows.withColumn("instrument", F.when(F.col("instrument") == "click", "Click log").otherwise(F.col("instrument")))
    # The flow column is found by its unit; the instrument names fold to codes.
    return series.gauges_daily([series.summary_gauges(named)], INSTRUMENTS, RANKING)


def model(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "events").where("event_type = 'view'").groupBy(
        F.col("user_id").cast("string").alias("point"), F.to_date("ts").alias("date")).agg(F.avg("value").alias("q(m3/s)"))
    return series.model_series(daily)


def station_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("station"), F.lit("hourly").alias("timestep"), F.to_date("ts").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time"),
        F.col("value").alias("q(m3/s)"))


def stations(spark: SparkSession, sf: str) -> DataFrame:
    return series.station_series(station_rows(spark, sf), "daily")


@query("best_source_daily", f"""
SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, {rnd('avg(value)', 6)} AS value FROM events GROUP BY user_id, CAST(ts AS DATE), event_type
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 10000 END, event_type) = 1""")
def best_source_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("user_id", iso("ts").alias("day"), "event_type", "value")
    return rounded(best_source_daily(rows, ["user_id", "day"], "event_type", "value", ["purchase", "click", "view"]), {"value": 6})


@query("gauges_daily", f"WITH {GAUGE_SQL} SELECT point, strftime(day, '%Y-%m-%d') AS date, source, {rnd('q', 4)} AS q_gauge_ls FROM gauges")
def gauges_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gauges(spark, sf).withColumn("date", iso("date")), {"q_gauge_ls": 4})


@query("gauges_per_file", f"""
WITH wide AS (SELECT user_id::VARCHAR AS point, CAST(ts AS DATE) AS day, 'FT' AS source, avg(value) AS q FROM events WHERE event_type NOT IN ('view', 'error') GROUP BY ALL),
matrix AS (SELECT user_id::VARCHAR, CAST(ts AS DATE), 'ML', avg((value + value * 2) / 2) FROM events WHERE event_type IN ('view', 'error') GROUP BY ALL)
SELECT point, strftime(day, '%Y-%m-%d') AS date, source, {rnd('q', 6)} AS q_gauge_ls FROM (SELECT * FROM wide UNION ALL SELECT * FROM matrix)""")
def gauges_per_file(spark: SparkSession, sf: str) -> DataFrame:
    """Per-measurement Summary files: one with a flow column, one with a labelled flow row."""
    file = F.concat(F.lit("/n/P"), F.col("user_id"), F.lit("_Summary_"), F.date_format("ts", "yyyyMMdd"), F.lit("_101500.csv"))
    events = table(spark, sf, "events").withColumn("file", file)
    wide = series.wide_gauges(
        events.where("event_type NOT IN ('view', 'error')").select("file", F.col("value").alias("flow")), {"code": "ft", "flow_column": "flow", "flow_unit": "l/s"})
    rows = events.where("event_type IN ('view', 'error')").select(
        "file", F.explode(F.array(F.lit("q [l/s]"), F.lit("h [m]"))).alias("label"), F.col("value").alias("a"), (F.col("value") * 2).alias("b"))
    matrix = series.matrix_gauges(rows, {"code": "ml"}, "label", ["a", "b"])
    return rounded(wide.unionByName(matrix).withColumn("date", iso("date")), {"q_gauge_ls": 6})


@query("station_daily", f"WITH {STATION_SQL} SELECT station, strftime(day, '%Y-%m-%d') AS date, {rnd('q', 4)} AS q_station_ls FROM stations")
def station_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stations(spark, sf).withColumn("date", iso("date")), {"q_station_ls": 4})


@query("station_monthly", f"""
SELECT l_returnflag AS station, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, {rnd('avg(l_quantity * 1000)', 4)} AS q_station_ls
FROM lineitem GROUP BY ALL""")
def station_monthly(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("station"), F.lit("daily").alias("timestep"), iso("l_shipdate").alias("date"), F.col("l_quantity").alias("q(m3/s)"))
    return rounded(series.station_series(rows, "monthly").withColumn("month", iso("month")), {"q_station_ls": 4})


@query("station_fallback", f"""
WITH e AS (SELECT event_type AS station, CASE WHEN event_type IN ('click', 'view') AND event_id % 4 = 0 THEN 'daily' ELSE 'hourly' END AS step, CAST(ts AS DATE) AS day, value FROM events),
best AS (SELECT station, min(CASE step WHEN 'daily' THEN 1 ELSE 2 END) AS r FROM e GROUP BY 1)
SELECT e.station, strftime(day, '%Y-%m-%d') AS date, {rnd('avg(value * 1000)', 4)} AS q_station_ls FROM e JOIN best b ON e.station = b.station AND r = CASE step WHEN 'daily' THEN 1 ELSE 2 END GROUP BY ALL""")
def station_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Stations with a daily series use it; the others fall back to their hourly one."""
    daily = F.col("event_type").isin("click", "view") & (F.col("event_id") % 4 == 0)
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("station"), F.when(daily, "daily").otherwise("hourly").alias("timestep"), F.to_date("ts").alias("date"), F.col("value").alias("q(m3/s)"))
    return rounded(series.station_series(rows, "daily").withColumn("date", iso("date")), {"q_station_ls": 4})


GAUGE_MODEL_SQL = f"""
WITH {GAUGE_SQL}, {MODEL_SQL}, pairs AS (SELECT point, day, source, m.q AS x, g.q AS y FROM gauges g JOIN model m USING (point, day) WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-28')
{metrics_sql('pairs', 'point', ", array_to_string(list_sort(list(DISTINCT source)), ' ') AS sources")}"""


@query("corr_gauge_model", GAUGE_MODEL_SQL + f'SELECT point, n, {METRIC_COLUMNS}, "start", "end", sources FROM metrics')
def corr_gauge_model(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = correlation.gauges_vs_model(
        gauges(spark, sf), model(spark, sf), {"x": "model", "y": "gauge"}, start="2024-01-03", end="2024-01-28")
    return shown(summary, ["point"], ["sources"])


@query("corr_gauge_model_rows", GAUGE_MODEL_SQL + f"""
SELECT point, strftime(day, '%Y-%m-%d') AS date, source, {rnd('x')} AS q_model_ls, {rnd('y')} AS q_gauge_ls, {rnd('pred')} AS q_gauge_pred_ls,
       {rnd('res')} AS residual_ls FROM fitted""")
def corr_gauge_model_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = correlation.gauges_vs_model(
        gauges(spark, sf), model(spark, sf), {"x": "model", "y": "gauge"}, start="2024-01-03", end="2024-01-28")
    return rounded(rows.withColumn("date", iso("date")), {"q_model_ls": 4, "q_gauge_ls": 4, "q_gauge_pred_ls": 4, "residual_ls": 4})


# Each point is compared with one station, by its number.
LISTED_SQL = "listed AS (SELECT DISTINCT ['click', 'error', 'purchase', 'signup', 'view'][user_id % 5 + 1] AS station, user_id::VARCHAR AS point FROM events)"


def listed(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view")))
    return table(spark, sf, "events").select(
        F.element_at(names, (F.col("user_id") % 5 + 1).cast("int")).alias("station"), F.col("user_id").cast("string").alias("point")).distinct()


@query("corr_window_match", f"""
WITH {GAUGE_SQL}, {STATION_SQL}, {LISTED_SQL},
near AS (SELECT station, point, g.day, g.q AS y, s.q AS x FROM listed JOIN gauges g USING (point) JOIN stations s USING (station) WHERE s.day BETWEEN g.day - 2 AND g.day + 2
         QUALIFY row_number() OVER (PARTITION BY station, point, g.day ORDER BY abs(s.day - g.day), s.day) = 1)
{metrics_sql('near', 'station, point')}
SELECT station, point, n, {METRIC_COLUMNS}, "start", "end" FROM metrics""")
def corr_window_match(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = correlation.gauges_vs_stations(
        gauges(spark, sf), stations(spark, sf), {"x": "station", "y": "gauge"}, listed(spark, sf), match_mode="window", window_days=2)
    return shown(summary, ["station", "point"])


@query("corr_listed_pairs", f"""
WITH {GAUGE_SQL}, {STATION_SQL}, listed(station, point) AS (VALUES ('click', '1'), ('view', '2'), ('purchase', '3'), ('absent', '4')),
pairs AS (SELECT station, point, g.day, s.q AS x, g.q AS y FROM listed JOIN gauges g USING (point) JOIN stations s USING (station) WHERE g.day = s.day)
{metrics_sql('pairs', 'station, point')}
SELECT station, point, n, {METRIC_COLUMNS}, "start", "end" FROM metrics""")
def corr_listed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    listed = correlation.pair_frame(spark, "[click P1] [view 2] [purchase,3] [absent 4]")
    _, summary = correlation.gauges_vs_stations(
        gauges(spark, sf), stations(spark, sf), {"x": "station", "y": "gauge"}, listed)
    return shown(summary, ["station", "point"])


@query("corr_model_station_pairs", f"""
WITH {MODEL_SQL}, {STATION_SQL}, {LISTED_SQL},
pairs AS (SELECT station, point, m.day, m.q AS x, s.q AS y FROM listed JOIN model m USING (point) JOIN stations s USING (station) WHERE m.day = s.day)
{metrics_sql('pairs', 'station, point')}
SELECT station, point, n, {METRIC_COLUMNS}, "start", "end" FROM metrics""")
def corr_model_station_pairs(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = correlation.model_vs_stations(
        model(spark, sf), stations(spark, sf), {"x": "model", "y": "station"}, listed(spark, sf))
    return shown(summary, ["station", "point"])


@query("corr_monthly", f"""
WITH s AS (SELECT l_returnflag AS station, date_trunc('month', l_shipdate)::DATE AS day, avg(l_quantity * 1000) AS q FROM lineitem GROUP BY ALL),
m AS (SELECT l_linestatus AS point, date_trunc('month', day)::DATE AS day, avg(q) AS q FROM (
        SELECT l_linestatus, CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) * 1000 AS q FROM lineitem GROUP BY ALL) GROUP BY ALL),
listed(station, point) AS (VALUES ('A', 'F'), ('R', 'F'), ('N', 'O'), ('N', 'F')),
pairs AS (SELECT station, point, m.day, m.q AS x, s.q AS y FROM listed JOIN m USING (point) JOIN s USING (station) WHERE m.day = s.day)
{metrics_sql('pairs', 'station, point')}
SELECT station, point, n, {", ".join(f"{rnd(c, 3 if c in ('rmse_direct',) else d)} AS {c}" for c, d in METRICS.items())}, "start", "end" FROM metrics""")
def corr_monthly(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    rows = lines.select(F.col("l_returnflag").alias("station"), F.lit("daily").alias("timestep"), iso("l_shipdate").alias("date"), F.col("l_quantity").alias("q(m3/s)"))
    daily = lines.groupBy(F.col("l_linestatus").alias("point"), iso("l_shipdate").alias("date")).agg(F.avg("l_extendedprice").alias("q(m3/s)"))
    _, summary = correlation.model_vs_stations(
        series.model_series(daily), series.station_series(rows, "monthly"), {"x": "model", "y": "station"},
        correlation.pair_frame(spark, "[A F] [R F] [N O] [N F]"), timestep="monthly")
    return rounded(shown(summary, ["station", "point"]), {"rmse_direct": 3})
