import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from limnospark.plans import ingest, validation
from limnospark.plans.correlation import check_roles
from limnospark.sources import files, series, tables
from limnospark.streaming import arrivals


def test_hydraulics_null_keys_and_zero_totals(spark):
    s = spark.createDataFrame([(None, 10.0, 1.0), ("a", 0.0, 1.0), ("b", 5.0, 1.0)], "k string, q_total_m3s double, area_total_m2 double").withColumn("q_total_ls", F.col("q_total_m3s") * 1000)
    p = spark.createDataFrame([(None, 10.0, 1.0), ("a", 0.0, 1.0), ("c", None, None)], "k string, q_m3s double, area_m2 double").withColumn("q_ls", F.col("q_m3s") * 1000)
    out = {r.k or "null": (r.merge, r.status, r.q_points_m3s) for r in validation.hydraulic_consistency(s, p, ["k"]).collect()}
    assert out == {"null": ("both", "ok", 10.0), "a": ("both", "inconsistent", 0.0), "b": ("left_only", "missing_pair", None), "c": ("right_only", "missing_pair", 0.0)}


def test_required_columns_and_missing_tables(spark):
    report = validation.required_columns(spark, {"Summary": spark.range(1)}, {"Summary": ["id", "x"], "Points": ["y"]})
    assert {(r.table, r.status) for r in report.collect()} == {("Summary", "ok"), ("Summary", "missing_column"), ("Points", "missing_table")}
    suite = validation.run_suite(spark, {"Summary": None, "Points": None}, {"checks": {"ranges": False}})
    assert {r.check: r.status for r in suite["summary"].collect()}["hydraulic_consistency"] == "issues_found"


DIS = """﻿File_Name                 P8.TXT.WAD
Nombre del punto de aforo   Paso Ñandú
Fecha y hora de inicio   2025-12-15 11:59:07
Caudal Total   0,1234 m^3/s
# Stations   3
Comment   first
  second

plain
St Reloj PtoAfo Calado Caudal %Q
() () (m) (m) (m^3/s) (%)

0 12:00 0.50 0.00 0.0 0.0 9
1 12:01 1.00 0.30 0.5 30.4
text
2 12:02 1 1 1 1
"""


def test_dis_file_from_bytes(spark, tmp_path):
    from limnospark.sources import dis_text

    (tmp_path / "P8").mkdir()
    (tmp_path / "P8" / "one.DIS").write_bytes(DIS.encode("utf-8").replace("﻿".encode(), b"").replace("Ñ".encode(), b"\xd1").replace("ú".encode(), b"\xfa"))
    (tmp_path / "short.dis").write_text(DIS.replace("1 12:01 1.00 0.30 0.5 30.4", "1 12:01 1.00"))
    (tmp_path / "none.dis").write_text("a  b\n")
    (tmp_path / "other.txt").write_text("a")
    found = dis_text.decode_files(files.scan_files(spark, str(tmp_path), [".dis"]))
    out = ingest.ingest_dis(found, keys=("caudal_total_m3_s", "comment", "unparsed_summary_line_9"))
    row = out["Summary"].first()
    assert (row.station_id, row.station_name, row.measurement_date, row.measurement_time, row.number_stations) == ("P8", "Paso Ñandú", "20251215", "115907", "3")
    assert (row.caudal_total_m3_s, row.comment, row.unparsed_summary_line_9, row.encoding) == ("0.1234", "first | second", "plain", "cp1252")
    points = out["Points"].orderBy("source_line_number").collect()
    assert [(p.station, p.depth_m, p.discharge_m3_s, p.percent_discharge, p.source_line_number) for p in points] == [("0", "0.00", "0.0", "0.0", 13), ("1", "0.30", "0.5", "30.4", 14)]
    rejected = {os.path.basename(r.file): r.status for r in out["rejected"].collect()}
    assert rejected == {"short.dis": "too few values in points row", "none.dis": "points header not found"}


XML = """<archive ver="1"><timestamp time="2025-06-25T10:14:46"><ref val="P8"/><name val="Paso"/><q unit="l/s" val="12.5"/>
<sect index="1"><w unit="m" val="1.0"/></sect><point index="1"><pos unit="m" val="0.5"/><tq unit="%" val="80"/>
<gate index="1"><pos unit="m" val="0.1"/><v unit="m/s" val="0.2"/></gate></point></timestamp></archive>"""


def test_profiler_documents(spark):
    docs = spark.createDataFrame([("/r/P9/a.xml", XML), ("/r/b.xml", "<archive>"), ("/r/c.xml", "<archive ver='2'/>")], "file string, content string")
    out = ingest.ingest_xml(docs, {"station_id": {"sources": [{"type": "raw_field", "key": "station_id"}], "transforms": ["digits_only"]}})
    s = out["Summary"].first()
    assert (s.station_id, s.measurement_date, s.measurement_time, s["q [l/s]"], s.archive_ver) == ("8", "20250625", "101446", "12.5", "1")
    assert [(g.point_index, g["index"], g["v [m/s]"]) for g in out["Gates"].collect()] == [("1", "1", "0.2")]
    assert {r.file: r.status for r in out["rejected"].collect()} == {"/r/b.xml": "unreadable", "/r/c.xml": "no timestamp"}
    assert "Exchange" not in out["Points"]._jdf.queryExecution().executedPlan().toString()


def test_profiler_documents_by_group(spark):
    """A group alone gives the rows that it gives beside the others, from a schema without the others; the rejected files are the same."""
    broken = XML[:XML.index("<gate")] + "<gate"
    docs = spark.createDataFrame([("/r/P9/a.xml", XML), ("/r/P9/b_20250102_030405.xml", XML.replace("2025-06-25T10:14:46", "later")), ("/r/c.xml", broken),
                                  ("/r/d.xml", "<archive ver='2'/>"), ("/r/e.xml", None)], "file string, content string")
    whole = ingest.ingest_xml(docs)
    rejected = sorted(whole["rejected"].collect())
    assert [r.status for r in rejected] == ["unreadable", "no timestamp", "unreadable"]
    for group in ("Summary", "Sections", "Points", "Gates"):
        alone = ingest.ingest_xml(docs, groups=(group,))
        assert sorted(alone) == sorted([group, "rejected"]) and alone[group].columns == whole[group].columns
        assert sorted(map(str, alone[group].collect())) == sorted(map(str, whole[group].collect()))
        assert sorted(alone["rejected"].collect()) == rejected
    assert sorted(ingest.ingest_xml(docs, groups=())["rejected"].collect()) == rejected
    plan = ingest.ingest_xml(docs, groups=("Points",))["Points"]._jdf.queryExecution().optimizedPlan().toString()
    assert "sect" not in plan and "gate" not in plan


def test_dis_summary_cuts_each_stamp_once(spark):
    """An expression that is used twice is worked out twice: the start stamp is cut at slashes, then at dashes."""
    docs = spark.createDataFrame([("/r/P1/a.dis", "x")], "file string, text string")
    plan = ingest.ingest_dis(docs)["Summary"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[/], -1") == 1


def test_dis_files_are_parsed_in_one_function(spark):
    """Lines are read one after another in one function; a summary does not make the points table."""
    docs = spark.createDataFrame([("/r/P1/a.dis", DIS), ("/r/P1/b.dis", None), ("/r/P1/c.dis", "")], "file string, text string")
    out = ingest.ingest_dis(docs)
    for group, tables in (("Summary", 0), ("Points", 1)):
        plan = out[group]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and ("tokens" in plan) == bool(tables)
    assert {r.file[-5]: r.status for r in out["rejected"].collect()} == {"b": "units line not found", "c": "points header not found"}
    assert (out["Summary"].count(), out["Points"].count()) == (1, 2)


def test_dis_patterns_of_a_spec(spark):
    """The patterns of a spec are Java's, and count beside the usual head and instead of the usual rows."""
    from limnospark.sources import dis_text

    texts = ["Key   1 m\nNo Time\nunits\n(m)\n1x 2\n2x 3 4\nend", "St Clock\n(m)\n1 10:00\n2x 4"]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file string, text string")
    spec = {"points_table": {"header_regex": r"^\p{Lu}o Time", "data_row_regex": r"^\p{Nd}x\b", "units_within": 2}, "summary": {"key_aliases": {"Width": "key m"}}}
    found = {r.file: r for r in dis_text.parse_files(docs, spec).collect()}
    assert [(r.line_no, r.tokens) for r in found["0"].rows] == [(5, ["1x", "2"]), (6, ["2x", "3", "4"])] and found["0"].names == ["num_points", "time"]
    assert found["0"].fields == {"width": "1"} and found["0"].status == "ok"
    assert [r.line for r in found["1"].rows] == ["2x 4"] and found["1"].fields == {}


def test_sheet_without_sentence_uses_the_cross(spark):
    cells = [("ESTACION", 1, 0), ("P 7", 1, 1), ("FECHA", 2, 0), ("15/12/2025", 2, 1), ("M.I", 4, 3), ("M.D", 4, 5), ("X", 6, 5), ("AFORO", 0, 0),
             ("Vert n", 10, 0), ("1", 13, 0), ("2,5", 13, 2), ("0,4", 13, 3), ("0,5", 15, 13), ("-", 16, 2), ("3", 14, 5), ("2", 13, 5)]
    df = spark.createDataFrame([("/x/P7_a.xlsx", "S", r, c, v) for v, r, c in cells] + [("/x/bad.xls", "S", 0, 0, "AFORO")], "file string, sheet string, r bigint, c int, value string")
    out = ingest.ingest_cells(df)
    s = out["Summary"].first()
    assert (s.station_id, s.measurement_date, s.measurement_time, s.profile_start_margin, s.ancho_m, s.n_points) == ("P7", "20251215", "000000", "MD", 2.5, 1)
    p = out["Points"].first()
    assert (p.vert_label, p.progr_m, p.prof_m, p.q_percent, p.rev_1_s, p.rev_2_s, p.point_index) == ("1", 2.5, 0.4, 50.0, 2.0, 3.0, 1)


def test_robust_csv_and_text_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,name\n1,Ñandú\n2,\"a, b\"\n3,NaN\n".encode("cp1252"))
    rows = files.read_robust_csv(spark, str(tmp_path / "a.csv"), ["id", "name"]).orderBy("id").collect()
    assert [(r.id, r.name) for r in rows] == [("1", "Ñandú"), ("2", "a, b"), ("3", "")]
    (tmp_path / "b.csv").write_text("id,name\n01,null\n")
    assert [tuple(r) for r in files.read_text_csv(spark, str(tmp_path / "b.csv")).collect()] == [("01", None)]


def test_each_csv_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n3,\"x, \"\"y\"\"\"\n")
    rows = files.read_robust_csv(spark, str(tmp_path), ["a", "b", "c"]).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "2", ""), ('x, "y"', "3", "")]


def test_csv_lines_that_begin_with_an_empty_cell(spark, tmp_path):
    (tmp_path / "1.csv").write_text(",a,b\n1,2,3\n,4,5\n,,6\n7,,\n")
    (tmp_path / "2.csv").write_text('b,a\n,"x, ""y"""\n"",8\n')
    rows = files.read_robust_csv(spark, str(tmp_path), ["a", "b"]).collect()
    assert sorted(tuple(r) for r in rows) == sorted([("2", "3"), ("4", "5"), ("", "6"), ("", ""), ('x, "y"', ""), ("8", "")])
    (tmp_path / "3.txt").write_text(";a|b\n|1;2\n")
    assert [tuple(r) for r in files.read_robust_csv(spark, str(tmp_path / "3.txt"), [";a", "b"], "|").collect()] == [("", "1;2")]


def test_written_tables_are_salted(spark, tmp_path):
    df = spark.range(20_000).selectExpr("if(id % 10 = 0, 'nivus', 'molinete') AS instrument", "id").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would join such small parts
    try:
        tables.write_table(df, str(tmp_path / "t"), salts=3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = [len(list((tmp_path / "t" / f"instrument={part}").glob("*.parquet"))) for part in ("nivus", "molinete")]
    assert max(counts) <= 3 and sum(counts) > 2  # sixteen tasks would have left sixteen files each
    assert tables.load_table(spark, str(tmp_path), "t").agg({"id": "sum"}).first()[0] == sum(range(20_000))


def test_series_folders(spark, tmp_path):
    (tmp_path / "P3_model_data.csv").write_text("date,q(m3/s)\n2025-01-01,2\n2025-01-02,x\n")
    (tmp_path / "44_daily_station_data.csv").write_text("date,q(m3/s)\n2025-01-01,1\n2025-01-31,3\n")
    (tmp_path / "45_hourly_station_data.csv").write_text("date,time,q(m3/s)\n2025-01-01,01:00:00,1\n2025-01-01,,2\n")
    assert [(r.point, r.q_model_ls) for r in series.read_model(spark, str(tmp_path)).collect()] == [("3", 2000.0)]
    stations = series.read_stations(spark, str(tmp_path)).cache()
    assert {(r.station, r.q_station_ls) for r in series.station_series(stations, "daily").collect()} == {("44", 1000.0), ("44", 3000.0), ("45", 1500.0)}
    assert [(r.station, str(r.month), r.q_station_ls) for r in series.station_series(stations, "monthly").collect()] == [("44", "2025-01-01", 2000.0)]
    assert {r.time for r in series.station_series(stations, "hourly").collect()} == {"01:00:00", "00:00:00"}


def test_tables_are_pruned_by_instrument(spark, tmp_path):
    df = spark.createDataFrame([("nivus", "1", 2.0), ("molinete", "2", 3.0)], "instrument string, station_id string, q double")
    tables.write_table(df, str(tmp_path / "Summary"))
    one = tables.load_table(spark, str(tmp_path), "Summary", "NIVUS")
    assert [r.station_id for r in one.collect()] == ["1"]
    assert tables.load_optional(spark, str(tmp_path), "Gates") is None
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        tables.write_table(df, str(tmp_path / "Summary"), policy="fail_if_exists")
    assert tables.parameter_columns(df) == ["q"]


def test_roles():
    assert check_roles("gauges_vs_model", {"x": "Model", "y": "gauge"}) == ("model", "gauge")
    with pytest.raises(ValueError):
        check_roles("gauges_vs_model", {"x": "gauge", "y": "gauge"})


def test_arrivals_keep_the_latest_run(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, run string, v int"
    for rows in ([("a", "2", 1), ("b", "1", 1)], [("a", "1", 9), ("b", "3", 3), ("b", "3", 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = arrivals.read_arrivals(spark, source, spark.createDataFrame([], schema).schema, files_per_batch=1)
    arrivals.keep_latest(stream, f"{root}/latest", f"{root}/c1", ["k"], "run", ["v"]).trigger(availableNow=True).start().awaitTermination()
    arrivals.keep_distinct(stream, f"{root}/distinct", f"{root}/c2").trigger(availableNow=True).start().awaitTermination()
    assert {(r.k, r.v) for r in arrivals.latest_table(spark, f"{root}/latest", ["k"], "run", ["v"]).collect()} == {("a", 1), ("b", 3)}
    assert arrivals.distinct_table(spark, f"{root}/distinct").count() == 4


def long_sheet(n, sheet="CALCULO", file="/x/P7_a.xlsx"):
    """A sheet of `n` verticals, three rows apart, whose labels and values lie on either side of the index's blocks."""
    cells = [("AFORO", 0, 0), ("ESTACION", 1, 0), ("P 7", 1, 8), ("FECHA", 2, 0), ("15/12/2025", 2, 8), ("Vert n", 10, 0)]
    for k in range(n):
        r = 13 + 3 * k
        cells += [(f"{k}.0", r, 0), (str(k % 97), r, 2), (str(k % 5), r, 3), ("0,5", r + 2, 13), (str(k), r, 5), (str(k + 1), r + 1, 5), ("-", r + 1, 2)]
    end = 13 + 3 * n
    cells += [("TOTALES", end, 1), ("0,75", end, 10), ("3", end, 11), ("4", end, 12), ("5", end + 1, 2), ("9", end, 13)]
    return [(file, sheet, r, c, v) for v, r, c in cells]


def test_long_sheets_are_read_in_blocks(spark):
    from limnospark.sources import cell_table

    n = 400
    rows = long_sheet(n) + [("/x/P7_a.xlsx", "CALCULO", 1290, 0, "Molinete"), ("/x/P7_a.xlsx", "CALCULO", 1291, 1, "OTT")] + [
        ("/x/P7_a.xlsx", "A", 0, 0, "AFORO"), ("/x/P7_a.xlsx", "A", 5, 0, "ESTACION")]
    rows += [("/x/P7_a.xlsx", "CALCULO", 252, 4, "Observaciones"), ("/x/P7_a.xlsx", "CALCULO", 252, 5, "calm"), ("/x/P7_a.xlsx", "CALCULO", 258, 15, "and clear")]
    cells = spark.createDataFrame(rows, "file string, sheet string, r bigint, c int, value string").repartition(5)
    index = cell_table.sheet_index(cells)
    blocks = {(r.sheet, r.block): len(r.grid) for r in index.collect()}
    assert len(blocks) == 7 and max(blocks.values()) < 700
    out = ingest.ingest_cells(cells, sheet="CALCULO")
    s = out["Summary"].first()
    assert (s.station_id, s.n_points, s.q_m3s, s.area_m2, s.vel_media_ms, s.molinete, s.observaciones, s.ancho_m) == ("P7", n, 4.0, 3.0, 0.75, "OTT", "calm and clear", 96.0)
    points = out["Points"].orderBy("point_index").collect()
    assert [(p.point_index, p.row, p.progr_m, p.prof_m, p.rev_1_s, p.rev_2_s, p.vert_label) for p in points] == [
        (k + 1, 13 + 3 * k, k % 97, k % 5, k, k + 1, str(k)) for k in range(n)]
    assert {p.q_percent for p in points} == {50.0}
    assert abs(s.prof_media_m - sum(k % 5 for k in range(n)) / n) < 1e-9


def test_sheet_choice_and_odd_sheets(spark):
    rows = [("/x/a.xlsx", s, r, c, v) for s, r, c, v in [
        ("B", 0, 0, "Vert n"), ("B", 9, 0, "TOTALES"), ("C", 0, 0, "AFORO"), ("CALCULO", 0, 0, "nothing"), (None, 0, 0, "AFORO")]]
    rows += [("/x/b.xlsx", "Z", 0, 0, None), ("/x/b.xlsx", "Z", 7, 0, " "), ("/x/b.xlsx", "Y", 3, 1, "text")]
    from limnospark.sources import cell_table

    cells = spark.createDataFrame(rows, "file string, sheet string, r bigint, c int, value string")
    index = cell_table.sheet_index(cells)
    chosen = lambda want: {r.file: (r.sheet, r.last) for r in cell_table.sheet_layout(index, want).collect()}
    assert chosen("C") == {"/x/a.xlsx": ("C", 0), "/x/b.xlsx": ("Y", 3)}
    assert chosen("Z")["/x/b.xlsx"] == ("Z", 7) and chosen("B")["/x/a.xlsx"] == ("B", 9)
    out = ingest.ingest_cells(cells)
    assert out["Summary"].count() == 0 and out["rejected"].count() == 2 and out["Points"].count() == 0
    assert ingest.ingest_cells(cells.limit(0))["rejected"].count() == 0


def test_sheets_are_read_in_one_pass(spark):
    cells = spark.createDataFrame(long_sheet(3), "file string, sheet string, r bigint, c int, value string")
    from limnospark.session import written

    kept = []
    out = ingest.ingest_cells(cells, keep=lambda df, label: kept.append(label) or written(df, label))
    for group in ("Points", "Summary"):
        plan = out[group]._jdf.queryExecution().executedPlan().toString()
        assert kept == ["index", "layout"] and plan.count("Exchange hashpartitioning") <= 2 and plan.count("FileScan") == 2


def test_sheet_index_is_made_without_collecting_cells(spark):
    """Cells go through the shuffle packed, and values are looked up while a block's cells are at hand: no grid is written."""
    rows = [("/x/P7_a.xlsx", "S", *cell) for cell in [(0, 0, "AFORO"), (1, 0, "NOMBRE"), (1, 0, "NOMBRE"), (1, 3, "Paso"), (2, 0, "FECHA"), (2, 1, "15/12/2025"), (3, 0, "Nombre"), (3, 1, "later")]]
    cells = spark.createDataFrame([*rows, *long_sheet(100, file="/x/P7_b.xlsx")], "file string, sheet string, r bigint, c int, value string").repartition(7)
    kept = {}
    out = ingest.ingest_cells(cells, keep=lambda df, label: kept.setdefault(label, df))
    plan = kept["index"]._jdf.queryExecution().executedPlan().toString()
    assert "grid" not in kept["index"].columns and "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.file: r.status for r in out["rejected"].collect()} == {"/x/P7_a.xlsx": "no points rows"} and out["Summary"].count() == 1
    assert [(r.n_points, r.q_m3s) for r in out["Summary"].collect()] == [(100, 4.0)] and out["Points"].count() == 100
    # a cell that comes twice stands next to itself
    assert [r.station_name for r in kept["index"].where("file = '/x/P7_a.xlsx'").collect()] == ["NOMBRE"]


def plain_machine(lines):
    """Section and key machine line by line: key -> values."""
    from limnospark.functions.text import snake_case_text
    from limnospark.sources.dis_text import KEY_NAMES, SECTION_TITLES

    section = key = None
    found = {}
    for no, line in enumerate(lines, 1):
        text = line.strip()
        title = SECTION_TITLES.get(snake_case_text(text))
        parts = re.split(r"\s{2,}", text, maxsplit=1)
        name, value = f"unparsed_summary_line_{no}", text
        if text == "" or title:
            key, section = None, title or section
            if text == "":
                continue
        elif section != "beamcheck":
            if len(parts) == 2:
                base = KEY_NAMES.get(snake_case_text(parts[0]), snake_case_text(parts[0]))
                key = f"{section}_{base}" if section in ("discharge_uncertainty_iso", "discharge_uncertainty_statistical") else base
                m = re.fullmatch(r"([-+]?[0-9]+(?:[.,][0-9]+)?)\s*(m\^3/s|m|%|deg ?C)", parts[1].strip(), re.I)
                value = parts[1].strip()
                if m:
                    unit = {"m^3/s": "m3_s", "m": "m", "%": "percent"}.get(m[2].lower(), "degC")
                    key, value = snake_case_text(f"{key}_{unit}") if unit == "degC" else f"{key}_{unit}", m[1].replace(",", ".")
            name = key or name
        found.setdefault(snake_case_text(name), []).append(value)
    return {k: " | ".join(v) for k, v in found.items()}


def test_section_and_key_machine(spark):
    from limnospark.sources import dis_text

    rng = random.Random(5)
    kinds = ["", " ", "plain text", "Total Flow   1,5 m^3/s", "Depth  2 m", "Depth  3", "Temp   4 deg C", "Share  5%", "Share  5 %x", "Discharge Uncertainty (ISO)",
             "Discharge Uncertainty (Statistical)", "Automatic Quality Control Test (BeamCheck)", "Operator(s)   Ann", "  Bob", "1.2.3 m  x"]
    texts = []
    for n in [0, 1, 2, 5, 30, 200] * 4:
        texts.append([rng.choice(kinds) for _ in range(n)])
    tail = ["St Clock Depth", "() ()", "1 10:00 5"]
    files_df = spark.createDataFrame([(str(i), "\n".join(t + tail)) for i, t in enumerate(texts)], "file string, text string")
    for r in dis_text.parse_files(files_df).select("file", "fields", "status").collect():
        assert r.fields == plain_machine(texts[int(r.file)]) and r.status == "ok"


def test_long_dis_files_take_time_in_proportion(spark):
    from limnospark.sources import dis_text

    def seconds(n):
        lines = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.when(i % 7 == 0, F.concat(F.lit("Key "), i % 1000, F.lit("   "), i)).when(i % 11 == 0, "").otherwise(F.concat(F.lit("text "), i)))
        df = spark.range(1).select(F.lit("a").alias("file"), F.concat_ws("\n", lines, F.lit("St Clock Depth\n() ()\n1 10:00 5")).alias("text"))
        start = time.perf_counter()
        fields = dis_text.parse_files(df).select(F.map_keys("fields").alias("k"), "status").first()
        assert fields.status == "ok" and len(fields.k) > n // 20
        return time.perf_counter() - start

    seconds(1_000)
    short, long = seconds(10_000), seconds(100_000)
    assert long < 30 * short + 5


def test_what_a_path_tells_is_not_dealt_out(spark):
    """Run, station and date of a file are read from its path after the join, and not written beside it."""
    from limnospark.plans.consolidate import build_group

    path = "/db/runs/ingest_a/20250101_000001/outputs/raw_canonical/flowtracker/Summary/P{}_Summary_20250102_101500.csv"
    rows = spark.createDataFrame([(path.format(i), i, "n" if i else "") for i in (0, 1, 1)], "csv_path string, row_no long, station_name string")
    out = build_group(rows, "flowtracker", "Summary")["rows"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and r"_Summary_(\d{8})" not in plan.split("Join Inner")[1]
    assert sorted((r.station_id, r.measurement_date, r.run_id, r.station_name) for r in out.collect()) == [
        ("P0", "20250102", "20250101_000001", ""), *[("P1", "20250102", "20250101_000001", "n")] * 2]
