import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnospark.operators import choose, groups, matching, regression, specs
from limnospark.plans import normalize, stage_discharge
from limnospark.operators.instrument_specs import COLUMNS, instrument_spec


def test_rank_runs_on_across_blocks(spark):
    rows = [("hot", i * 3) for i in range(500)] + [("b", 5), ("b", 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, pos int").repartition(7)
    got = {(r.k, r.pos): (r.rank, r.n) for r in groups.rank_in_group(df, ["k"], "pos", size="n", width=50).collect()}
    assert all(got["hot", i * 3] == (i + 1, 500) for i in range(500))
    assert got["b", 1] == (1, 2) and got["b", 5] == (2, 2) and got[None, 2] == (1, 1)


def test_group_values_reach_every_row(spark):
    df = spark.createDataFrame([("a", i, str(i) if i > 7 else None) for i in range(40)] + [(None, 0, "z")], "f string, n int, v string")
    out = groups.attach_group_values(df, ["f"], "n", {"first": F.min_by("v", F.when(F.col("v").isNotNull(), F.col("n")))}, width=10)
    assert {(r.f, r.first) for r in out.collect()} == {("a", "8"), (None, "z")} and out.count() == 41


def test_hot_groups_are_split_and_whole(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"), "id")
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    out = groups.join_group_table(rows, sizes, ["k"], "n", ["id"], min_rows=50)
    assert out.count() == 3000 and out.where("k = 'hot' and top = 1999").count() == 2000


@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [5.0] * 9, list(map(float, range(100))), [1.0, 1.0, 1.0, 9.0]])
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), ("none", None)], "k string, v double")
    assert [(r.k, r.median) for r in groups.grouped_median(df, ["k"], "v", min_rows=2).collect()] == [("g", float(np.median(values)))]


def test_latest_row_costs_one_row_per_task(spark):
    df = spark.createDataFrame([("a", "20250101_000000", 1), ("a", "20250201_000000", 2), ("b", "20240101_000000", 3)], "k string, run string, v int")
    out = choose.latest_per_key(df, ["k"], "run", ["v"])
    assert {(r.k, r.v) for r in out.collect()} == {("a", 2), ("b", 3)}
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()


def test_best_series_chooses_per_column(spark):
    df = spark.createDataFrame(
        [("s", "d", "a", None, 1.0), ("s", "d", "b", 5.0, 2.0), ("s", "d", "z", 9.0, 3.0), (None, "d", "a", 1.0, 1.0)],
        "st string, d string, inst string, x double, y double")
    best = choose.best_series(df, ["st", "d"], "inst", ["x", "y"], ["a", "b"]).collect()
    assert [(r.inst, r.x, r.y, r.rank) for r in best] == [("a", 5.0, 1.0, 0)]


def test_nearest_date_prefers_the_earlier_day(spark):
    left = spark.sql("select 'p' point, date'2025-01-10' date, 1.0 g")
    right = spark.sql("select * from values ('s', date'2025-01-08', 8.0), ('s', date'2025-01-12', 12.0), ('t', date'2025-01-13', 13.0) as t(station, date, v)")
    out = matching.nearest_date_match(left, right, ["point"], ["station"], "date", 2).collect()
    assert [(r.station, r.v) for r in out] == [("s", 8.0)]
    assert "NestedLoop" not in matching.nearest_date_match(left, right, ["point"], ["station"], "date", 2)._jdf.queryExecution().toString()


def test_masked_lookup_counts_matches(spark):
    table = spark.createDataFrame([(1, "A", "x"), (2, "A", "y"), (3, "B", None)], "id int, a string, b string")
    asked = spark.createDataFrame([(1, "A", None), (2, "A", "y"), (3, " ", ""), (4, "C", None), (5, None, "y")], "n int, a string, b string")
    out = matching.masked_lookup(asked, table, {"a": F.col("a"), "b": F.col("b")}, "id")
    assert {r.n: (r.lookup_mask, r.lookup_count) for r in out.collect()} == {1: ("a", 2), 2: ("a,b", 1), 3: ("", 0), 4: ("a", 0), 5: ("b", 1)}


def test_lookup_reports_missing_and_duplicate_rows(spark):
    table = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 3)], "k string, v int")
    asked = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "k string")
    out = matching.lookup_with_count(asked, table, {"k": F.col("k")}, {"k": F.col("k")}, ["v"])
    assert {r.k: r.found_count for r in out.collect()} == {"k1": 1, "k2": 2, "k3": 0}


def test_curves_agree_with_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0.2, 4.0, 200)
    y = 12 * x**1.7 + rng.normal(0, 0.5, 200) + 3
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(x, y)] + [("two", 1.0, 1.0), ("two", 2.0, 2.0)], "k string, x double, y double")
    fits = regression.curve_fits(df, ["k"], "x", "y")
    got = {r.model: r for r in regression.fit_rows(fits, ["k"]).collect()}
    assert {r.k for r in got.values()} == {"g"}
    assert np.allclose([got["poly1"].a, got["poly1"].b], np.polyfit(x, y, 1))
    assert np.allclose([got["poly2"].a, got["poly2"].b, got["poly2"].c], np.polyfit(x, y, 2))
    slope, shift = np.polyfit(np.log(x), np.log(y), 1)
    assert np.allclose([got["power"].a, got["power"].b], [math.exp(shift), slope])
    metrics = {r.model: r for r in regression.curve_metrics(df, fits, ["k"], "x", "y", min_rows=10).collect()}
    p = np.polyval(np.polyfit(x, y, 2), x)
    assert np.isclose(metrics["poly2"].r2, 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert np.isclose(metrics["poly2"].mae, np.abs(y - p).mean())


def test_constant_x_has_no_slope(spark):
    df = spark.createDataFrame([("g", 2.0, 1.0, 1), ("g", 2.0, 3.0, 2), ("one", 5.0, 7.0, 1)], "k string, x double, y double, d int")
    fitted = regression.fitted_pairs(df, ["k"], "x", "y", ["d"])
    got = {r.k: r for r in regression.pair_metrics(fitted, ["k"], "x", "y").collect()}
    assert (got["g"].slope, got["g"].intercept, got["g"].r2, got["g"].pearson) == (0.0, 2.0, 0.0, None)
    assert (got["one"].r2, got["one"].intercept, got["one"].nse) == (None, 7.0, None)


def test_lone_point_takes_two_of_three_sections(spark):
    points = spark.createDataFrame([("a", 1, 9.0), ("b", 1, 9.0), ("b", 2, 9.0)], "m string, point_index int, percent_q double")
    sections = spark.createDataFrame([(m, i, 1.0, float(i), 10.0 * i, 1.0) for m in "ab" for i in (1, 2, 3)],
                                     "m string, section_index int, width_m double, depth_m double, q_ls double, percent_q double")
    out = {(r.m, r.point_index): (r.area_m2, r.q_ls, r.percent_q) for r in normalize.enrich_points(points, sections, ["m"]).collect()}
    assert out == {("a", 1): (3.0, 30.0, 2.0), ("b", 1): (None, None, 9.0), ("b", 2): (None, None, 9.0)}


SPEC = {
    "metadata": {c: {"sources": s} for c, s in {
        "station_id": ["station_id", "estacion"], "station_name": ["station_name", "nombre"], "measurement_date": ["measurement_date", "fecha"],
        "measurement_time": ["measurement_time", "hora_ini"], "instrument": ["instrument"], "source_file": ["source_file", "raw_source_file"]}.items()},
    "metadata_policy": {
        "station_id": {"remove_prefixes": ["P"], "digits_only": True}, "station_code": {"enabled": True, "prefix": "P"},
        "measurement_date": {"input_formats": ["%m/%d/%Y"]}, "measurement_time": {"input_formats": ["%H:%M:%S"]}},
    "columns": {"q_total_m3s": {"source": "q_m3s", "dtype": "float"}, "n": {"source": "n", "dtype": "int"}},
    "derived": {"q_total_ls": {"from": "q_total_m3s", "operation": "multiply", "value": 1000}},
    "required": ["station_id", "q_total_m3s"], "transforms": [{"name": n} for n in ("strip_strings", "numeric_commas_to_dots", "enforce_dtypes")],
    "qc": {"non_negative": ["q_total_m3s"]},
}
RAW = "estacion string, nombre string, fecha string, hora_ini string, instrument string, raw_source_file string, q_m3s string, n string"


def test_one_row_by_spec(spark):
    df = spark.createDataFrame([("P11", "Paso 11", "01/19/2026", "9:15:00", "molinete", "P11.xlsx", "0,082686", "2.5")], RAW)
    row = specs.normalize_table(df, SPEC, qc_column=True).first()
    assert (row.station_id, row.station_code, row.station_name, row.measurement_date, row.measurement_time) == ("11", "P11", "Paso 11", "20260119", "091500")
    assert (row.instrument, row.source_file, row.run_id, row.q_total_m3s) == ("molinete", "P11.xlsx", None, 0.082686)
    # The comma is read before the derived column, which therefore has a value; 2.5 is no whole number.
    assert row.q_total_ls == pytest.approx(82.686) and row.n is None and row.qc_status == "n: not whole"


def test_negative_value_fails_the_table_or_is_flagged(spark):
    df = spark.createDataFrame([("P1", "a", "01/19/2026", "9:15:00", "m", "f", "-1", "2")], RAW)
    assert specs.normalize_table(df, SPEC, qc_column=True).first().qc_status == "q_total_m3s: negative"
    with pytest.raises(Exception, match="negative"):
        specs.normalize_table(df, SPEC).collect()
    with pytest.raises(ValueError, match="required"):
        specs.normalize_table(df, {**SPEC, "required": ["absent"]})


def test_every_instrument_spec_builds(spark):
    for instrument, groups_ in COLUMNS.items():
        for group in groups_:
            out = specs.normalize_table(spark.createDataFrame([("P1", "x")], "station_id string, index string"), instrument_spec(instrument, group))
            assert out.columns[: len(specs.TRACE_COLUMNS)] == list(specs.TRACE_COLUMNS)


def test_alias_levels(spark):
    aliases = {"*": {"*": {"a": "x"}, "Summary": {"a": "y"}}, "m": {"*": {"a": "z"}, "Summary": {"b": "b2"}}}
    assert specs.alias_mapping(aliases, "m", "Summary") == {"a": "z", "b": "b2"}
    assert specs.alias_mapping(aliases, "n", "Summary") == {"a": "y"}


def test_stage_options():
    assert stage_discharge.option("depth_mode", "AMBAS") == "both" and stage_discharge.option("depth_mode", None) == "both"
    assert stage_discharge.option("instrument_stage_mode", " máxima ") == "max" and stage_discharge.option("depth_mode", "instrumento") == "instrument"
    for name, bad in (("depth_mode", "media"), ("instrument_stage_mode", "manual"), ("depth_mode", "x")):
        with pytest.raises(ValueError, match=name):
            stage_discharge.option(name, bad)


def test_sparse_and_missing_positions_make_no_blocks_of_their_own(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 2_000_000_000, 2), ("a", None, 3), ("b", None, 4)], "k string, p long, v int")
    out = groups.attach_group_values(df, ["k"], "p", {"total": F.sum("v")})
    assert sorted((r.k, r.v, r.total) for r in out.collect()) == [("a", 1, 6), ("a", 2, 6), ("a", 3, 6), ("b", 4, 4)]
    ranked = groups.rank_in_group(df, ["k"], "p", ["v"], size="n").collect()
    assert sorted((r.k, r.v, r["rank"], r.n) for r in ranked) == [("a", 1, 2, 3), ("a", 2, 3, 3), ("a", 3, 1, 3), ("b", 4, 1, 1)]


@pytest.mark.parametrize("min_rows", [1, 10**6])
def test_median_with_a_far_outlier(spark, min_rows):
    rows = [("a", float(i % 997)) for i in range(5_000)] + [("a", 1e18), ("b", 3.0), ("b", None), ("c", 1.0), ("c", 2.0), (None, 5.0), ("d", None)]
    out = groups.grouped_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", min_rows=min_rows).collect()
    values = sorted(v for k, v in rows if k == "a")
    assert {r.k: r["median"] for r in out} == {"a": values[len(values) // 2], "b": 3.0, "c": 1.5, None: 5.0}


def test_keyed_files(spark, tmp_path):
    from limnospark.sources.keyed_files import bucket_of, read_keyed, write_keyed

    df = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 != 0, F.concat(F.lit("E"), F.col("id") % 700)).alias("export_id"),
        "id", F.when(F.col("id") % 2 == 0, "").otherwise(F.concat(F.lit('a "b", c;'), F.col("id"))).alias("text"))
    index = write_keyed(df, str(tmp_path / "x"), "export_id", buckets=8, parts=3, sep=";")
    files = list((tmp_path / "x" / "records").glob("*/*/*.csv"))
    assert len(files) <= 24
    back = read_keyed(spark, str(tmp_path / "x"), df.schema, "export_id", sep=";")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    some = read_keyed(spark, str(tmp_path / "x"), df.schema, "export_id", ["E7", "hot", "absent"], buckets=8, sep=";")
    assert some.count() == df.where("export_id in ('E7', 'hot')").count()
    seen = {r.f.split("__bucket=")[1].split("/")[0] for r in some.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(seen) <= 2 and "__bucket" in some._jdf.queryExecution().executedPlan().toString()
    # the index names the rows of each file where a key's records stand
    rows = index.where("key = 'hot'").collect()
    assert sum(r.rows for r in rows) == df.where("export_id = 'hot'").count() and len(rows) == 3
    for r in rows:
        (file,) = (tmp_path / "x" / "records" / f"__bucket={r.bucket}" / f"__part={r.part}").glob("*.csv")
        lines = file.read_text().splitlines()[1:]
        assert {line.split(";")[0] for line in lines[r.first_row:r.first_row + r.rows]} == {"hot"}
        assert all(not line.startswith("hot") for line in lines[:r.first_row])
    assert {r.bucket for r in rows} == {spark.range(1).select(bucket_of(F.lit("hot"), 8)).first()[0]}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_keyed(df, str(tmp_path / "x"), "export_id", policy="fail_if_exists")
    assert write_keyed(df.limit(0), str(tmp_path / "y"), "export_id").count() == 0


def test_mixed_gauge_layouts(spark):
    from limnospark.sources.gauge_files import mixed_gauges

    entries = [
        {"code": "ft", "subdir": "flow", "flow_column": "Q", "flow_unit": "m3/s"}, {"code": "NV", "subdir": "nivus", "summary_format": "long"},
        {"code": "ML", "subdir": "mol", "flow_column": "q"}]
    texts = {
        "/n/Summary.csv": "Station,FECHA,q_ls,source\nP12,20250102,5,x y\nP13,1989-12-31,5,a\nnan,20250102,1,b\nP14,bad,1,c\nP15,03/02/2025,NaN,c\n16.5,20250102,\"7\",NaN\n",
        "/n/flow/Summary.csv": "punto,datetime,my caudal x\n4,2025-01-02 10:00:00,2\n",
        "/n/mol/Summary.csv": "punto,caudal\n4,2\n",  # no date column
        "/n/flow/Summary/P8_Summary_20250103_101500.csv": "Q,date\n1,20250104\n3,20250104\nx,20250104\n5,20250105\n",
        "/n/mol/Summary/P9_Summary_20250103_101500.csv": "q,other\n4,1\n8,1\n",
        "/n/mol/Summary/P10_Summary_20250103_101500.csv": "Q\n4\n",
        "/n/nivus/Summary/P11_Summary_20250106_101500.csv": "name,x\nq [l/s],10,20,y\nq [l/s],99\n",
        "/n/nivus/Summary/P11_Summary_20250107_101500.csv": "q [l/s],-,z\nq [l/s],99\n",
        "/n/nivus/Summary/P11_Summary_2025.csv": "q [l/s],5\n", "/n/other/Summary/P8_Summary_20250103_101500.csv": "q\n5\n", "/n/nivus/Summary/P12_Summary_20250108_101500.csv": "",
    }
    out = mixed_gauges(spark.createDataFrame(list(texts.items()), "file string, text string"), entries)
    got = sorted((r.layout, r.point, str(r.date), r.source, r.q_gauge_ls) for r in out.collect())
    assert got == [
        ("matrix", "11", "2025-01-06", "NV", 15.0), ("table", "12", "2025-01-02", "X Y", 5.0), ("table", "16.5", "2025-01-02", "NAN", 7.0), ("table", "4", "2025-01-02", "FT", 2000.0),
        ("wide", "8", "2025-01-04", "FT", 2000.0), ("wide", "8", "2025-01-05", "FT", 5000.0), ("wide", "9", "2025-01-03", "ML", 6.0)]


def test_dates_prune_months(spark, tmp_path):
    from limnospark.plans import section_profiles
    from limnospark.plans.table_export import ExportRequest, run_export
    from limnospark.sources import tables

    rows = [("nivus", f"P{i % 3}", f"{1996 + i // 12}-{i % 12 + 1:02d}-15", float(i)) for i in range(48)] + [("nivus", "P1", None, -1.0), ("nivus", "P1", "1970-01-01", -2.0)]
    df = spark.createDataFrame(rows, "instrument string, station_id string, measurement_date string, q double")
    tables.write_table(df, str(tmp_path / "t"), month_of="measurement_date")
    read = spark.read.parquet(str(tmp_path / "t"))

    def files_of(out):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and tables.MONTH in plan.split("PartitionFilters")[1].split("]")[0]
        return len(out.select(F.input_file_name()).distinct().collect())

    flat = run_export(read, ExportRequest(parameters=["q"], early="19970310", late="19970520"))
    assert sorted(r.q for r in flat.collect()) == [14.0, 15.0, 16.0]
    files_of(flat)
    moved = stage_discharge.select_dates(read.withColumn("measurement_date", F.to_date("measurement_date")), "1997-03-16", "19970520")
    assert sorted(r.q for r in moved.collect()) == [15.0, 16.0] and files_of(moved) <= 3
    loaded = section_profiles.load_points(read, {"nivus": {"enabled": True}})
    chosen = section_profiles.select_rows(loaded, start="19970310", end="1997-05-20")
    assert sorted(r.q for r in chosen.collect()) == [14.0, 15.0, 16.0]
    files_of(chosen)
    assert run_export(read, ExportRequest(parameters=["q"])).count() == 49
    assert tables.within_months(read, "March 1997", None).count() == 50 and tables.within_months(df, "19970310", None).count() == 50


def test_a_stray_date_makes_one_more_block(spark):
    from limnospark.plans.table_export import ExportRequest, export_blocks, run_export

    rows = [("m9", "P1", "2025-01-05", 1.0), ("m9", "P1", "2025-03-05", 2.0), ("m9", "P2", "9999-12-31", 3.0), ("m9", "P1", "99999999", 9.0), ("m9", "P1", None, 9.0)]
    df = spark.createDataFrame(rows, "instrument string, station_id string, measurement_date string, q double")
    request = ExportRequest(parameters=["q"], grouping="monthly")
    with pytest.raises(ValueError, match="export_blocks"):
        run_export(df, request)
    blocks = list(export_blocks(df, request, width=24))
    assert [(p[0], p[-1], len(p)) for p, _ in blocks] == [("202501", "202612", 24), ("999901", "999912", 12)]
    first, last = ({r.station_id: r.asDict() for r in wide.collect()} for _, wide in blocks)
    assert set(first) == set(last) == {"P1", "P2"}
    assert first["P1"]["202503 | q"] == 2.0 and first["P2"]["202501 | q"] is None and last["P2"]["999912 | q"] == 3.0
    assert len(list(export_blocks(df, ExportRequest(parameters=["q"], grouping="daily", early="20250101", late="20250310"), width=30, filled=False))) == 3
    long = run_export(df, ExportRequest(parameters=["q"], grouping="monthly", late="20250331"), long=True)
    assert sorted((r.period, r.q) for r in long.where("station_id = 'P1'").collect()) == [("202501", 1.0), ("202502", None), ("202503", 2.0)]
    assert list(export_blocks(df.limit(0), request)) == []


def test_periods_of_a_calendar():
    from limnospark.operators.reshape import period_axis, period_count

    assert period_axis("20241130", "20250201", "monthly") == ["202411", "202412", "202501", "202502"]
    assert period_axis("20240228", "20240301", "daily") == ["20240228", "20240229", "20240301"]
    assert period_count("00010101", "99991231", "monthly") == 9999 * 12 and period_axis("00010101", "99991231", "daily", 31, 1) == ["00010201"]
    assert period_axis("20250201", "20250101", "monthly") == []


def test_rows_without_a_position_rank_in_many_parts(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("k"), F.when(F.col("id") % 6 == 0, F.col("id")).alias("pos"), "id")
    plain = groups.rank_in_group(df, ["k"], "pos", size="n")
    rows = {}
    for r in plain.collect():
        rows.setdefault(r.k, []).append((r.rank, r.pos, r.n))
    for found in rows.values():
        found.sort()
        assert [rank for rank, _, _ in found] == list(range(1, len(found) + 1)) and {n for _, _, n in found} == {len(found)}
        positions = [pos for _, pos, _ in found if pos is not None]
        assert positions == sorted(positions) and all(pos is None for _, pos, _ in found[:len(found) - len(positions)])
    tied = groups.rank_in_group(df, ["k"], "pos", ["id"], width=1_000).where("pos is null and k = 'hot'").orderBy("rank").collect()
    assert [r.id for r in tied] == sorted(r.id for r in tied)
    # no task sorts the whole group
    parts = df.where("k = 'hot' and pos is null").groupBy(F.pmod(F.xxhash64("k", "pos", "id"), F.lit(groups.MISSING_PARTS))).count()
    assert parts.agg(F.max("count")).first()[0] < 200


def test_selection_numbers(spark):
    from limnospark.plans.registry_export import numbered

    rows = [(i, s, d, t) for i in ("m9", None, "a") for s in ("2", "10", None) for d in ("20250102", "20241231", "later", None) for t in ("101500", "090000")]
    df = spark.createDataFrame(rows, "instrument string, station_id string, measurement_date string, measurement_time string")
    got = [tuple(r)[:4] for r in numbered(df).orderBy("number").select("instrument", "station_id", "measurement_date", "measurement_time").collect()]
    assert got == sorted(rows, key=lambda r: tuple((v is not None, v or "") for v in r))
    assert [r.number for r in numbered(df).orderBy("number").collect()] == list(range(1, len(rows) + 1))
