"""Instrument files as rows: scan, decode, split into lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Letters of code page 1252 at the C1 positions, and the five bytes it leaves undefined.
CP1252_LETTERS = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰",
    0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•",
    0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
CP1252_UNDEFINED = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
# Cell texts a table reader treats as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def scan_files(spark: SparkSession, root: str, extensions: Sequence[str]) -> DataFrame:
    """Files below `root` with one of the extensions, in any letter case: `(path, name, content)`."""
    patterns = ["".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in ext) for ext in extensions]
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*{" + ",".join(patterns) + "}")
        .load(root)
    )
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), "content")


def decode_text(content: Column, preferred: str | None = None) -> Column:
    """Struct of text and encoding: UTF-8, else code page 1252, else Latin-1."""
    latin = F.decode(content, "ISO-8859-1")
    cp1252 = F.translate(latin, "".join(map(chr, CP1252_LETTERS)), "".join(CP1252_LETTERS.values()))
    undefined = latin.rlike("[" + "".join(f"\\x{b:02x}" for b in CP1252_UNDEFINED) + "]")
    utf8 = F.is_valid_utf8(content.cast("string"))
    plain = content.cast("string")
    without_mark = F.regexp_replace(plain, "^﻿", "")

    def result(text: Column, name: str) -> Column:
        return F.struct(text.alias("text"), F.lit(name).alias("encoding"))

    options = [(utf8, without_mark, "utf-8-sig"), (~undefined, cp1252, "cp1252"), (F.lit(True), latin, "latin-1")]
    hint = (preferred or "").lower()
    if hint in ("latin-1", "latin1", "iso-8859-1"):
        options.insert(0, (F.lit(True), latin, preferred))
    elif hint == "cp1252":
        options.insert(0, (~undefined, cp1252, preferred))
    elif hint in ("utf-8", "utf8", "utf-8-sig"):
        options.insert(0, (utf8, without_mark if hint == "utf-8-sig" else plain, preferred))
    chosen = None
    for test, text, name in options:
        chosen = F.when(test, result(text, name)) if chosen is None else chosen.when(test, result(text, name))
    return chosen


def line_table(files: DataFrame, preferred: str | None = None) -> DataFrame:
    """`(file, name, encoding, line_no, line)`, lines numbered from 1."""
    decoded = files.select("path", "name", decode_text(F.col("content"), preferred).alias("d"))
    return decoded.select(
        F.col("path").alias("file"), "name", F.col("d.encoding").alias("encoding"),
        F.posexplode(F.split("d.text", r"\r\n|\r|\n")).alias("line_no", "line"),
    ).withColumn("line_no", F.col("line_no") + 1)


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_text_csv(spark: SparkSession, path: str, names: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """CSV with every column as text; the usual missing-value texts become null."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).option("escape", '"')
    if names:
        reader = reader.schema(text_schema(names)).option("enforceSchema", False)
    df = reader.csv(path)
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(*MISSING_CELLS), F.col(f"`{c}`")).alias(c) for c in df.columns
    ])


def csv_cells(line: Column, sep: str = ",") -> Column:
    """Cells of one CSV line; quoted cells may hold separators and doubled quotes, but no line breaks."""
    mark = re.escape(sep)
    # a separator in front of the first cell too: an empty match at the start would hide the second one
    raw = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{mark}("(?:[^"]|"")*"|[^{mark}]*)'), F.lit(1))
    return F.transform(raw, lambda cell: F.when(
        (F.length(cell) > 1) & cell.startswith('"') & cell.endswith('"'),
        F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).otherwise(cell))


def read_robust_csv(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    return robust_csv_rows(spark.read.format("binaryFile").load(path), names, sep)


def robust_csv_rows(files: DataFrame, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Columns `names` of CSV files (`content`) in any of the accepted encodings, as text, missing cells as empty text.

    Each file's cells are named by its own header, so files may order their columns differently or lack
    some. Cells do not span lines.
    """
    decoded = files.select(decode_text(F.col("content"))["text"].alias("text"))
    lines = decoded.select(F.split("text", r"\r\n|\r|\n").alias("lines"))
    rows = lines.select(csv_cells(F.get("lines", F.lit(0)), sep).alias("header"), F.posexplode("lines").alias("pos", "line"))
    cells = rows.where((F.col("pos") > 0) & (F.col("line") != "")).select("header", csv_cells(F.col("line"), sep).alias("cells"))

    def named(name: str) -> Column:
        place = F.array_position(F.transform("header", lambda h: F.trim(h)), name).cast("int")
        cell = F.when(place > 0, F.get(F.col("cells"), place - 1))
        return F.when(cell.isNull() | cell.isin(*MISSING_CELLS), F.lit("")).otherwise(cell).alias(name)

    return cells.select(*map(named, names))
