"""Correlation of gauge, model and station series: every pair in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from limnospark.functions.dates import month_start
from limnospark.functions.text import bare_id, parse_pairs
from limnospark.operators.matching import exact_date_match, nearest_date_match
from limnospark.operators.regression import fitted_pairs, pair_metrics

# Which series a workflow compares.
ROLES = {
    "gauges_vs_model": ("gauge", "model"),
    "gauges_vs_stations": ("gauge", "station"),
    "model_vs_stations": ("model", "station"),
}


def check_roles(workflow: str, roles: Mapping[str, str] | None) -> tuple[str, str]:
    """x and y role of a workflow, both allowed and different."""
    allowed = ROLES[workflow]
    x, y = (str((roles or {}).get(axis, "")).lower() for axis in ("x", "y"))
    if {x, y} != set(allowed):
        raise ValueError(f"{workflow} needs the roles {allowed} as x and y, got x={x!r} y={y!r}")
    return x, y


def role_column(role: str) -> str:
    return f"q_{role}_ls"


def _between(df: DataFrame, start: str | None, end: str | None, date: str = "date") -> DataFrame:
    if start and end and str(end) < str(start):
        raise ValueError("the end date is before the start date")
    if start:
        df = df.where(F.col(date) >= F.to_date(F.lit(start)))
    if end:
        df = df.where(F.col(date) <= F.to_date(F.lit(end)))
    return df


def pair_frame(spark: SparkSession, pairs: str | Sequence[tuple[str, str]] | None) -> DataFrame | None:
    """Listed (station, point) pairs as a small table; ids lose their P, Pm and S marks."""
    listed = parse_pairs(pairs) if isinstance(pairs, str) or pairs is None else list(pairs)
    if not listed:
        return None
    df = spark.createDataFrame([(str(a), str(b)) for a, b in listed], "station string, point string")
    return df.select(bare_id(F.col("station"), ("S",)).alias("station"), bare_id(F.col("point"), ("Pm", "P")).alias("point"))


def correlate(
    matched: DataFrame, keys: Sequence[str], roles: tuple[str, str], salt_on: Sequence[str] = ("date",), min_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with the fitted line, and one summary row per pair."""
    x, y = (role_column(r) for r in roles)
    options = {} if min_rows is None else {"min_rows": min_rows}
    fitted = fitted_pairs(matched, keys, x, y, salt_on, **options)
    sources = (
        [F.array_join(F.array_sort(F.collect_set("source")), " ").alias("sources")] if "source" in matched.columns else []
    )
    summary = pair_metrics(fitted, keys, x, y, [F.min("date").alias("start"), F.max("date").alias("end"), *sources])
    equation = F.format_string(f"{roles[1]} = %.6f * {roles[0]} + %.6f", F.col("slope"), F.col("intercept"))
    summary = summary.withColumns({
        "x_role": F.lit(roles[0]), "y_role": F.lit(roles[1]), "equation": equation,
    })
    rows = fitted.select(
        *keys, "date", x, y, F.col("predicted").alias(f"q_{roles[1]}_pred_ls"), F.col("residual").alias("residual_ls"),
        *(["source"] if "source" in matched.columns else []),
    )
    return rows, summary


def gauges_vs_model(
    gauges: DataFrame, model: DataFrame, roles: Mapping[str, str], points: Sequence[str] = (),
    start: str | None = None, end: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Points that have both series, joined on the date."""
    checked = check_roles("gauges_vs_model", roles)
    wanted = [str(p).replace("P", "").strip() for p in points if str(p).strip()]
    left, right = _between(gauges, start, end), _between(model, start, end)
    if wanted:
        left, right = left.where(F.col("point").isin(*wanted)), right.where(F.col("point").isin(*wanted))
    return correlate(left.join(right, ["point", "date"]), ["point"], checked)


def gauges_vs_stations(
    gauges: DataFrame, stations: DataFrame, roles: Mapping[str, str], pairs: DataFrame,
    match_mode: str = "exact", window_days: int = 0, timestep: str = "daily",
) -> tuple[DataFrame, DataFrame]:
    """Gauge days against daily station flows of listed pairs, on the same date or the nearest within a window."""
    checked = check_roles("gauges_vs_stations", roles)
    if timestep != "daily":
        raise ValueError("gauges are compared with daily station flows only")
    if match_mode == "exact":
        matched = exact_date_match(gauges, stations, "date", pairs, "point", "station")
    else:
        left = gauges.join(pairs.dropDuplicates(["station", "point"]), "point")
        matched = nearest_date_match(left, stations, ["point"], ["station"], "date", window_days, ("station",))
    rows, summary = correlate(matched, ["station", "point"], checked)
    return rows, summary.withColumns({"match_mode": F.lit(match_mode), "window_days": F.lit(window_days)})


def model_vs_stations(
    model: DataFrame, stations: DataFrame, roles: Mapping[str, str], pairs: DataFrame, timestep: str = "daily",
) -> tuple[DataFrame, DataFrame]:
    """Model points against station flows of listed pairs; monthly compares monthly means."""
    checked = check_roles("model_vs_stations", roles)
    if timestep == "monthly":
        model = model.groupBy("point", month_start(F.col("date")).alias("date")).agg(F.avg("q_model_ls").alias("q_model_ls"))
        stations = stations.withColumnRenamed("month", "date") if "month" in stations.columns else stations
    matched = exact_date_match(model, stations, "date", pairs, "point", "station")
    return correlate(matched, ["station", "point"], checked)
