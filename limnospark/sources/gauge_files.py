"""Gauge rows from Summary files of three layouts in one scan.

A Summary is one table for all points (`Summary.csv` at the root), one for an instrument (`<folder>/Summary.csv`), or one file for each
measurement (`<folder>/Summary/P<point>_Summary_<date>_<time>.csv`), which states its flow in a column (wide) or in a labelled
row (matrix). The path and the catalogue decide the layout, the file's own header where its columns stand; both are worked out
once for each file. After that all rows have the same columns, and the layout is one of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions import dates as D, numbers as N, text as T
from limnospark.sources.files import MISSING_CELLS, csv_cells
from limnospark.sources.series import (
    CUBIC_CANDIDATES, DATE_CANDIDATES, FIRST_VALID_DATE, LITRE_CANDIDATES, POINT_CANDIDATES, SOURCE_CANDIDATES, WIDE_DATE_CANDIDATES,
)

#: Layouts of the per-measurement files that state the flow in a row.
ROW_FORMATS = ("matrix", "long", "row")
FLOW_LABEL = "q [l/s]"


def _place(header: str, candidates: Sequence[str], contains: bool = True) -> Column:
    """Place (from 1) of a column by name, candidates in order, else the first whose name holds a candidate; null without one."""
    exact = [F.nullif(F.array_position(header, c.lower()), F.lit(0)) for c in candidates]
    inside = F.nullif(F.array_position(F.transform(header, lambda h: F.exists(F.array(*[F.lit(c.lower()) for c in candidates]), lambda c: h.contains(c))), True), F.lit(0))
    return F.coalesce(*exact, *([inside] if contains else []))


def _cell(place: str) -> Column:
    cell = F.get("cells", F.col(place).cast("int") - 1)
    return F.when(~F.trim(cell).isin(*MISSING_CELLS), cell)


def _described(files: DataFrame, instruments: Sequence[Mapping]) -> DataFrame:
    """One row per Summary file: lines, layout, and what the catalogue says of its folder."""
    entries = [
        F.struct(
            F.lit(str(e["subdir"])).alias("subdir"), F.lit(str(e["code"]).upper().strip()).alias("code"),
            F.lit("matrix" if str(e.get("summary_format") or "wide").lower() in ROW_FORMATS else "wide").alias("layout"),
            F.lit(e.get("flow_column")).cast("string").alias("flow_column"), F.lit(e.get("flow_unit") or "l/s").alias("unit"),
            F.lit(e.get("flow_row_label") or FLOW_LABEL).alias("label"))
        for e in instruments
    ]
    parts = F.split("file", "/")
    named = T.file_name_metadata(F.col("file"), "Summary", numeric_station=True)
    df = D.with_computed(files.select("file", "text"), {
        "name": F.get(parts, F.size(parts) - 1), "folder": F.get(parts, F.size(parts) - 2), "above": F.get(parts, F.size(parts) - 3), "named": named})
    single = (F.col("folder") == "Summary") & F.col("named.station_id").isNotNull()
    df = df.where(single | (F.col("name") == "Summary.csv"))
    subdir = F.when(single, F.col("above")).otherwise(F.col("folder"))
    entry = F.get(F.filter(F.array(*entries), lambda e: e["subdir"] == F.col("__subdir")), F.lit(0))
    df = D.with_computed(df.withColumn("__subdir", subdir), {"entry": entry}).drop("__subdir")
    df = df.withColumn("layout", F.when(single, F.col("entry.layout")).otherwise("table")).where("layout is not null")  # files of folders that no instrument has
    return D.with_computed(df, {"lines": F.split("text", r"\r\n|\r|\n")}).drop("text", "name", "folder", "above")


def mixed_gauges(files: DataFrame, instruments: Sequence[Mapping]) -> DataFrame:
    """`(point, date, source, q_gauge_ls, layout)` of all Summary files `(file, text)`, flows in litres per second.

    `instruments` is the catalogue: code, subdir, summary_format, flow_column, flow_unit, flow_row_label. Tables give a row for each of theirs whose
    point, date and flow columns are found; a wide file the mean flow of each date, a matrix file the mean of its first row
    with the label. Rows without a flow or before 1990 are left out.
    """
    df = _described(files, instruments)
    df = D.with_computed(df, {"header": F.transform(csv_cells(F.get("lines", F.lit(0))), lambda h: F.trim(h))})
    df = D.with_computed(df, {"lower": F.transform("header", lambda h: F.lower(h))})
    table, wide = F.col("layout") == "table", F.col("layout") == "wide"
    own_date = F.coalesce(*[F.nullif(F.array_position("header", c), F.lit(0)) for c in WIDE_DATE_CANDIDATES])
    df = D.with_computed(df, {
        "point_at": F.when(table, _place("lower", POINT_CANDIDATES)), "source_at": F.when(table, _place("lower", SOURCE_CANDIDATES)),
        "date_at": F.when(table, _place("lower", DATE_CANDIDATES, contains=False)).when(wide, own_date),
        "litres_at": F.when(table, _place("lower", LITRE_CANDIDATES)), "cubic_at": F.when(table, _place("lower", CUBIC_CANDIDATES)),
        "flow_at": F.when(wide, F.nullif(F.array_position("header", F.col("entry.flow_column")), F.lit(0))),
    }).drop("header", "lower")
    usable = F.when(table, F.col("point_at").isNotNull() & F.col("date_at").isNotNull() & F.coalesce("litres_at", "cubic_at").isNotNull()).when(
        wide, F.col("flow_at").isNotNull()).otherwise(True)
    rows = df.where(usable).select(*[c for c in df.columns if c != "lines"], F.posexplode("lines").alias("pos", "line"))
    rows = rows.where((F.col("line") != "") & ((F.col("pos") > 0) | (F.col("layout") == "matrix")))
    rows = D.with_computed(rows, {"cells": csv_cells(F.col("line"))}).drop("line")
    rows = rows.where((F.col("layout") != "matrix") | (F.get("cells", F.lit(0)) == F.col("entry.label")))
    table_flow = F.when(F.col("litres_at").isNotNull(), N.to_number(_cell("litres_at"))).otherwise(N.to_number(_cell("cubic_at")) * 1000.0)
    # The numbers of a matrix row; their mean is taken here, since the cells stand in one row.
    numbers = F.filter(F.transform(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))), lambda c: N.to_litres(c, F.col("entry.unit"))), lambda v: v.isNotNull())
    mean = F.aggregate(numbers, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(numbers), F.lit(0))
    rows = D.with_computed(rows, {
        "raw_date": F.when(F.col("date_at").isNotNull(), _cell("date_at")).otherwise(F.col("named.measurement_date")),
        "point": F.trim(F.replace(F.when(table, _cell("point_at")).otherwise(F.upper(F.col("named.station_id"))), F.lit("P"), F.lit(""))),
        "source": F.when(F.col("source_at").isNotNull(), F.coalesce(F.upper(_cell("source_at")), F.lit("NAN"))).otherwise(F.coalesce("entry.code", F.lit("UNK"))),
        "q": F.when(table, table_flow).when(wide, N.to_litres(_cell("flow_at"), F.col("entry.unit"))).otherwise(mean),
    })
    rows = D.with_computed(rows.select("file", "layout", "pos", "point", "source", "q", "raw_date"), {"date": D.iso_date(F.col("raw_date"), day_first=True)})
    # The first row with the label decides a matrix file, whatever it holds.
    single = rows.where("layout <> 'table'").groupBy("file", "layout", "point", "source", F.when(F.col("layout") == "wide", F.col("date")).alias("day")).agg(
        F.first("date").alias("date"), F.avg(F.when(F.col("layout") == "wide", F.col("q"))).alias("mean"), F.min_by("q", "pos").alias("first"))
    single = single.select("point", "date", "source", F.when(F.col("layout") == "wide", F.col("mean")).otherwise(F.col("first")).alias("q_gauge_ls"), "layout")
    tables = rows.where("layout = 'table'").select("point", "date", "source", F.col("q").alias("q_gauge_ls"), "layout")
    return tables.unionByName(single).dropna(subset=["point", "date", "q_gauge_ls"]).where(F.col("date") >= FIRST_VALID_DATE)
