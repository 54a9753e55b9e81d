"""Registry export: selected measurements become a visit record and a gauging record each.

All selections run in one job; a selection that cannot be exported keeps its row in the outcome
log with the reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from limnospark.functions import dates as D, text as T
from limnospark.operators.groups import null_safe_join, rank_in_group
from limnospark.operators.matching import first_match_lookup, lookup_with_count, masked_lookup
from limnospark.sources.keyed_files import write_keyed

SELECTION_COLUMNS = ("station_id", "measurement_date", "measurement_time", "instrument", "export_id")
# Columns of the two records, in order.
VISIT_COLUMNS = (
    "id", "id_estacion", "id_operador", "id_tipo_actuacion", "id_instrumento", "fecha", "pendiente", "relevante",
    "lectura_escala", "observaciones",
)
GAUGING_COLUMNS = (
    "ancho", "caudal", "escala_fin", "escala_inicio", "escala_media", "fecha_fin", "fecha_inicio", "id", "id_actuacion",
    "id_estacion", "id_instrumento", "id_instrumentos_rangos", "id_perfil", "id_tipo_aforo", "observaciones",
    "profundidad", "seccion", "velocidad_media", "radio_hidraulico", "nivel_confiabilidad",
)
MATCH_COLUMNS = ("marca", "nro_serie", "modelo", "codigo")
RAW_FIELDS = (
    "id_operador", "lectura_escala", "escala_inicio", "escala_fin", "escala_media", "observaciones", "radio_hidraulico",
)
MEASURED_FIELDS = ("ancho", "caudal", "profundidad", "seccion", "velocidad_media")
STAMP_FORMAT = "%d/%m/%Y %H:%M:%S"


def check_selection(columns: Sequence[str]) -> None:
    missing = sorted(set(SELECTION_COLUMNS) - set(columns))
    if missing:
        raise ValueError(f"the selection lacks columns: {missing}")


def build_selection(
    summary: DataFrame, instruments: Sequence[str] = (), stations: Sequence[str] = (), early: str | None = None,
    late: str | None = None, prefix: str = "EXP",
) -> DataFrame:
    """Filtered measurements, numbered in order as `<prefix>001`, `<prefix>002`, ..."""
    df = summary.withColumns({
        "measurement_date": D.selection_date(F.col("measurement_date")),
        "measurement_time": D.selection_time(F.col("measurement_time")),
    }).select(*SELECTION_COLUMNS[:4])
    if instruments:
        df = df.where(F.col("instrument").isin(*instruments))
    if stations:
        df = df.where(F.col("station_id").isin(*stations))
    if early:
        df = df.where(F.col("measurement_date") >= early)
    if late:
        df = df.where(F.col("measurement_date") <= late)
    number = numbered(df)
    text = T.pad_left(F.col("number").cast("string"), 3)
    return number.select(*SELECTION_COLUMNS[:4], F.concat(F.lit(prefix), text).alias("export_id"))


def numbered(df: DataFrame) -> DataFrame:
    """Running number of measurements by instrument, station, date and time, missing values first.

    A number is the rows of earlier instruments, plus those of earlier stations of the instrument, plus the rank in the station, which is
    taken in blocks of days. Only counts are ordered beyond a block: one for each station, then one for each instrument.
    """
    keys = ["instrument", "station_id"]
    stations = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    instruments = stations.groupBy("instrument").agg(F.sum("__rows").alias("__all"))
    earlier = lambda spec: spec.rowsBetween(W.unboundedPreceding, -1)
    # one row for each instrument
    first = instruments.select("instrument", F.coalesce(F.sum("__all").over(earlier(W.orderBy(F.col("instrument").asc_nulls_first()))), F.lit(0)).alias("__first"))
    own = F.coalesce(F.sum("__rows").over(earlier(W.partitionBy("instrument").orderBy(F.col("station_id").asc_nulls_first()))), F.lit(0))
    starts = null_safe_join(stations.select(*keys, own.alias("__own")), first, ["instrument"])
    # texts that are no day stand behind all days, in their own order
    day = F.when(F.col("measurement_date").isNotNull(), F.coalesce(F.when(F.length("measurement_date") == 8, F.col("measurement_date").try_cast("int")), F.lit(10 ** 9)))
    ranked = rank_in_group(df.withColumn("__day", day), keys, "__day", ["measurement_date", "measurement_time"], "__rank")
    return null_safe_join(ranked, starts, keys).withColumn("number", F.col("__first") + F.col("__own") + F.col("__rank")).drop(
        "__day", "__rank", "__own", "__first")


def _per_instrument(configs: Mapping[str, Mapping], pick) -> Column:
    """Value that depends on the row's instrument."""
    out = F.lit(None).cast("string")
    for name, config in configs.items():
        value = pick(config or {})
        out = F.when(F.col("instrument") == name, value).otherwise(out)
    return out


def _text(value) -> Column:
    return F.lit("" if value is None else str(value))


def run(
    selection: DataFrame, normalized: DataFrame, raw: DataFrame | None, lookups: Mapping[str, DataFrame], config: Mapping,
    case_insensitive: bool = False,
) -> dict[str, DataFrame]:
    """Visit records, gauging records and the outcome of every selection.

    `lookups` holds `instrumentos`, `tipos_aforos` and `instrumentos_rangos` (the last two with a
    `row_no` that says which row comes first).
    """
    check_selection(selection.columns)
    configs = config["instruments"]
    names = [c for c in normalized.columns]
    asked = selection.select(*[F.col(c).cast("string") for c in SELECTION_COLUMNS])
    keys = {
        "instrument": F.lower("instrument"), "station": F.col("station_id"),
        "date": F.col("measurement_date"), "time": F.col("measurement_time"),
    }

    def table_keys(df: DataFrame) -> dict[str, Column]:
        return {
            "instrument": F.lower("instrument"), "station": F.col("station_id").cast("string"),
            "date": D.lookup_date(F.col("measurement_date")), "time": D.lookup_time(F.col("measurement_time")),
        }

    rows = lookup_with_count(asked, normalized, keys, table_keys(normalized), names, "m")
    raw_names: list[str] = []
    if raw is not None:
        raw_names = list(raw.columns)
        rows = lookup_with_count(rows, raw, keys, table_keys(raw), raw_names, "w")
    else:
        rows = rows.withColumn("w_count", F.lit(0))

    def measured(column: str | None) -> Column:
        return F.coalesce(F.col(f"m.`{column}`").cast("string"), F.lit("")) if column in names else F.lit("")

    def from_raw(column: str | None) -> Column:
        return F.coalesce(T.strip(F.col(f"w.`{column}`").cast("string")), F.lit("")) if column in raw_names else F.lit("")

    rows = rows.withColumns({
        **{f"raw_{f}": _per_instrument(configs, lambda c, f=f: from_raw((c.get("raw_canonical_fields") or {}).get(f))) for f in RAW_FIELDS},
        **{f"val_{f}": _per_instrument(configs, lambda c, f=f: measured((c.get("normalized_fields") or {}).get(f))) for f in MEASURED_FIELDS},
        **{f"key_{f}": _per_instrument(configs, lambda c, f=f: from_raw((c.get("instrument_lookup_fields") or {}).get(f))) for f in MATCH_COLUMNS},
        "known": F.col("instrument").isin(*configs),
        "id_tipo_actuacion": _per_instrument(configs, lambda c: _text(c.get("id_tipo_actuacion"))),
        "tipo_direct": _per_instrument(configs, lambda c: _text(c.get("id_tipo_aforo"))),
        "tipo_key": _per_instrument(configs, lambda c: _text(c.get("tipo_aforo_lookup"))),
        "rango_direct": _per_instrument(configs, lambda c: _text(c.get("id_instrumentos_rangos"))),
        "rango_key": _per_instrument(configs, lambda c: _text(c.get("instrumentos_rangos_lookup"))),
        "id_estacion": measured(config.get("station_column", "station_id")),
        "stamp": D.measurement_timestamp(F.col("m.measurement_date"), F.col("m.measurement_time")),
    })
    rows = masked_lookup(rows, lookups["instrumentos"], {c: F.col(f"key_{c}") for c in MATCH_COLUMNS}, "id", "inst", spread=SELECTION_COLUMNS)
    for table, key, direct, name in (
        ("tipos_aforos", "tipo_key", "tipo_direct", "id_tipo_aforo"),
        ("instrumentos_rangos", "rango_key", "rango_direct", "id_instrumentos_rangos"),
    ):
        rows = first_match_lookup(rows, lookups[table], F.col(key), "descripcion", "id", "row_no", "__found", case_insensitive)
        rows = rows.withColumn(name, F.coalesce(F.nullif(F.col(direct), F.lit("")), F.col("__found"))).drop("__found")

    outcome = (
        F.when(~F.col("known"), "instrument not configured")
        .when(F.col("m_count") == 0, "measurement not found")
        .when(F.col("m_count") > 1, "multiple measurements found")
        .when(F.col("w_count") > 1, "raw_duplicate")
        .when(F.col("stamp").isNull(), "bad date or time")
        .when(F.col("inst_mask") == "", "no instrument lookup field is filled")
        .when(F.col("inst_count") == 0, F.concat(F.lit("instrument lookup failed: "), F.col("inst_mask")))
        .when(F.col("inst_count") > 1, F.concat(F.lit("instrument lookup ambiguous: "), F.col("inst_mask")))
    )
    fecha = D.format_stamp(F.col("stamp"), config.get("output_format", STAMP_FORMAT))
    rows = rows.withColumns({"error": outcome, "fecha": fecha, "id_instrumento": F.col("inst_value")})
    ok = rows.where("error is null")
    empty = F.lit("")
    visit = {
        "id": empty, "id_operador": F.col("raw_id_operador"), "pendiente": F.lit(False), "relevante": F.lit(False),
        "lectura_escala": F.col("raw_lectura_escala"), "observaciones": F.col("raw_observaciones"),
    }
    gauging = {
        **{f: F.col(f"val_{f}") for f in MEASURED_FIELDS},
        **{f: F.col(f"raw_{f}") for f in ("escala_fin", "escala_inicio", "escala_media", "observaciones", "radio_hidraulico")},
        "fecha_fin": F.col("fecha"), "fecha_inicio": F.col("fecha"),
        **{f: empty for f in ("id", "id_actuacion", "id_perfil", "nivel_confiabilidad")},
    }
    log = rows.select(
        F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), "export_id", "instrument",
        "station_id", "measurement_date", "measurement_time", (F.col("w_count") > 0).alias("raw_canonical_found"), "error",
    )
    return {
        "visits": ok.select("export_id", *[visit.get(c, F.col(c)).alias(c) for c in VISIT_COLUMNS]),
        "gaugings": ok.select("export_id", *[gauging.get(c, F.col(c)).alias(c) for c in GAUGING_COLUMNS]),
        "log": log,
    }


def write_records(records: DataFrame, path: str, sep: str = ",", buckets: int = 32, parts: int = 1) -> DataFrame:
    """The records by export id, in a set number of files; the result is their index."""
    return write_keyed(records, path, "export_id", buckets, parts, sep)
