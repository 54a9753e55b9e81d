"""Jobs whose cost once grew faster than their input; tests build their own rows."""

from pyspark.sql import functions as F

from limnospark.functions import dates, numbers
from limnospark.operators import matching, regression
from limnospark.plans import quality
from limnospark.plans.consolidate import build_group
from limnospark.sources import series, tables

PATH = "/db/ingest_a/{}/outputs/raw_canonical/ft/Summary/P1_Summary_20250101_10150{}.csv"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_runs_are_excluded_by_a_table(spark):
    runs = spark.createDataFrame([("p", "1"), ("p", "2"), ("q", "2"), ("q", "3"), ("q", None)], "pipeline string, run_id string")
    listed = spark.createDataFrame([("2",), ("2",), (None,)], "run_id string")
    assert {tuple(r) for r in tables.select_runs(runs, exclude=listed).collect()} == {("p", "1"), ("q", "3")}
    assert sorted(tuple(r) for r in tables.select_runs(runs, include=listed).collect()) == [("p", "2"), ("q", "2")]


def test_paths_of_runs_are_cut_like_the_pattern(spark):
    rx = r"^(.*?([^/]+)/([^/]+))/outputs/raw_canonical/([^/]+)/([^/]+)/([^/]+)$"
    good = PATH.format("r1", 0)
    paths = [good, "a/r/outputs/raw_canonical/i/g/f", "r/outputs/raw_canonical/i/g/f", "/r/outputs/raw_canonical/i/g/f", "x//r/outputs/raw_canonical/i/g/f",
             "/a/r/outputs/raw_canonical/i//f", good + "/", "a\n/b/r/outputs/raw_canonical/i/g/f", "a/b\n/r/outputs/raw_canonical/i/g/f\n", "", None, good.replace("outputs", "out")]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    names = ["source_run_dir", "pipeline", "run_id", "instrument", "group", "csv_filename"]
    told = df.select("path", tables.run_parts(F.col("path")).alias("t")).select("path", *[f"t.{n}" for n in names])
    wanted = df.select("path", *[F.nullif(F.regexp_extract("path", rx, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)])
    assert [tuple(r) for r in told.collect()] == [tuple(r) for r in wanted.collect()]


def test_rows_meet_their_files_in_one_join(spark):
    rows = spark.createDataFrame(
        [(PATH.format("20250101_000001", 0), 2, "", "x"), (PATH.format("20250101_000001", 0), 1, " ", None), (PATH.format("20250101_000001", 0), 3, "s", "y"),
         (PATH.format("20250101_000001", 1), 1, None, None), (PATH.format("20250101_000002", 1), None, "t", None), (None, 1, "u", "u")],
        "csv_path string, row_no long, station_name string, nombre string")
    out = build_group(rows, "ft", "Summary")
    assert plan(out["rows"]).count("Join") == 1
    found = {(r.run_id, r.station_name, r.nombre, r.measurement_time) for r in out["rows"].collect()}
    one = "20250101_000001"
    assert found == {(one, "s", "x", "101500"), (one, "s", None, "101500"), (one, "s", "y", "101500"), ("20250101_000002", "t", None, "101501")}
    assert out["manifest"].where("selected").count() == 2 and out["manifest"].count() == 3


def test_station_rows_are_averaged_before_their_grain_is_chosen(spark):
    rows = spark.createDataFrame(
        [("a", "daily", "2025-01-01", 1.0), ("a", "daily", "2025-01-01", 3.0), ("a", "hourly", "2025-01-02", 9.0), ("b", "hourly", "2025-01-02", 5.0),
         ("c", "daily", None, 1.0), ("c", "hourly", "2025-01-02", 5.0), (None, "daily", "2025-01-01", 1.0)],
        "station string, timestep string, date string, `q(m3/s)` double")
    out = series.station_series(rows, "daily")
    assert not plan(out).startswith("Aggregate")
    assert {(r.station, str(r.date), r.q_station_ls) for r in out.collect()} == {("a", "2025-01-01", 2000.0), ("b", "2025-01-02", 5000.0)}


def test_run_keeps_what_its_results_share(spark):
    kept = []
    rows = spark.createDataFrame([("P1_Points_20250101_101500.csv", 1, 2.0), ("bad", 1, 1.0)], "file string, row_no long, percent_q double")
    raw = spark.createDataFrame([("P1_Points_20250101_101500.csv", 1, 3.0)], "file string, row_no long, `tq [%]` double")
    out = quality.quality_metrics(rows, raw, keep=lambda df, label: kept.append(label) or df)
    assert kept == ["scored"]
    assert [(r.point, r.cg) for r in out["measurements"].collect()] == [("P1", 3.0)] and out["log"].count() == 2


def test_curve_fits_carry_no_moment_twice(spark):
    rows = spark.createDataFrame([("a", float(x), 3.0 * x + 1.0) for x in range(1, 6)] + [("b", 2.0, 5.0)] * 3 + [("z", 0.0, 5.0)] * 3, "k string, x double, y double")
    fits = regression.curve_fits(rows, ["k"], "x", "y")
    assert "regr_" not in plan(fits)
    lines = {r.k: {m.model: (round(m.a, 6), round(m.b, 6)) for m in r.models} for r in fits.collect()}
    assert lines["a"]["poly1"] == (3.0, 1.0) and lines["b"]["poly1"] == (1.25, 2.5) and "poly1" not in lines["z"]


def test_full_stamps_are_read_like_others(spark):
    df = spark.createDataFrame([("2025-01-02", "10:20:30"), ("2025-13-02", "10:20:30"), ("2025-1-2", "1:2:3"), (None, "10:20:30")], "d string, t string")
    stamps = [r.s for r in df.select(F.date_format(dates.measurement_timestamp(F.col("d"), F.col("t")), "yyyyMMddHHmmss").alias("s")).collect()]
    assert stamps[0] == "20250102102030" and stamps[1] is None and stamps[3] is None


def test_numbers_are_worked_out_once(spark):
    texts = {"1,5": 1.5, " 2 ": 2.0, "1d": None, "1F": None, "inf": None, "Infinity": float("inf"), "nan": None, "-": None, "": None, "x": None, "1e3": 1000.0, "0x1p1d": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", numbers.cell_number(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == texts
    assert plan(df).count("trim(t") <= 1


def test_requests_of_one_lookup_key_are_dealt_out(spark):
    """Requests that fill nothing, and many of one key, once went to one task each."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    asked = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "gone").alias("a"), F.when(F.col("id") == 9, "q").alias("b"))
    table = spark.createDataFrame([(1, "x", "p"), (2, "x", "q"), (3, None, "q")], "no long, a string, b string")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = matching.masked_lookup(asked, table, {"a": F.col("a"), "b": F.col("b")}, "no", hot_rows=500)
        assert out.columns == ["id", "a", "b", "lookup_mask", "lookup_count", "lookup_value"]
        rows = out.withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    wanted = {0: ("a", 2, "1"), 1: ("a", 0, None), 2: ("", 0, None)}
    assert len(rows) == 3000
    assert all((r.lookup_mask, r.lookup_count, r.lookup_value) == (("a,b", 1, "2") if r.id == 9 else wanted[r.id % 3]) for r in rows)
    for kind in range(3):
        parts = [r.part for r in rows if r.id % 3 == kind]
        assert max(parts.count(p) for p in set(parts)) < 500
