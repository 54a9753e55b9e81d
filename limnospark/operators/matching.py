"""Joins of the gauging jobs, written so that each one is an equi-join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from limnospark.functions.text import null_if_blank, strip
from limnospark.operators.choose import first_row

#: Keys of a lookup whose results go to every task at most, and requests from which a key is one of them: there are few enough
#: others of one key for a task.
HOT_KEYS, HOT_ROWS = 1_024, 100_000


def nearest_date_match(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], date: str, days: int,
    match_on: Sequence[str] = (),
) -> DataFrame:
    """Each left row with the right row nearest in time within +-`days`; ties take the earlier date.

    Every left date is fanned out to its 2 * days + 1 candidate dates, which turns the range
    condition into an equality.
    """
    fanned = left.withColumn(
        "__candidate",
        F.explode(F.sequence(F.date_sub(date, days), F.date_add(date, days))),
    )
    renamed = {date: "matched_date", **{key: f"__right_{key}" for key in match_on}}
    condition = F.col("__candidate") == F.col("matched_date")
    for key in match_on:
        condition = condition & (F.col(key) == F.col(f"__right_{key}"))
    joined = fanned.join(right.withColumnsRenamed(renamed), condition).drop(*[f"__right_{key}" for key in match_on])
    gap = F.abs(F.datediff(F.col("matched_date"), F.col(date)))
    keys = list(dict.fromkeys([*left_keys, *right_keys, date]))
    return first_row(joined.drop("__candidate"), keys, [gap, F.col("matched_date")])


def exact_date_match(left: DataFrame, right: DataFrame, date: str, pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Rows of both series on the same date, for the listed pairs.

    Left rows meet their partners through the list, then the right rows by id and date, so a long
    series is dealt out by its dates.
    """
    return left.join(pairs.dropDuplicates([left_id, right_id]), left_id).join(right, [right_id, date])


def positional_join(left: DataFrame, right: DataFrame, file: str, row: str) -> DataFrame:
    """Rows of two files paired by row number; files of unequal length are flagged, not paired blindly.

    The full join works on (file, row), so no file is gathered in one task.
    """
    a = left.withColumn("__in_left", F.lit(1))
    b = right.withColumn("__in_right", F.lit(1))
    return a.join(b, [file, row], "full")


def lookup_with_count(
    requests: DataFrame, table: DataFrame, on: Mapping[str, Column], table_on: Mapping[str, Column],
    payload: Sequence[str], prefix: str = "found",
) -> DataFrame:
    """Left-join requests to a table by key and report how many rows matched.

    The table is reduced to one row per key first, so a key with many rows cannot fan out.
    """
    keys = [f"__k_{name}" for name in on]
    asked = requests.withColumns({f"__k_{n}": c for n, c in on.items()})
    wanted = asked.select(*keys).distinct()
    counted = (
        table.select(
            *[table_on[n].alias(f"__k_{n}") for n in on],
            F.struct(*[F.col(f"`{c}`") for c in payload]).alias(prefix),
        )
        .join(wanted, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(f"{prefix}_count"), F.min(prefix).alias(prefix))
    )
    joined = asked.join(counted, keys, "left").drop(*keys)
    return joined.withColumn(f"{prefix}_count", F.coalesce(F.col(f"{prefix}_count"), F.lit(0)))


def masked_lookup(
    requests: DataFrame, table: DataFrame, criteria: Mapping[str, Column], value: str, prefix: str = "lookup",
    spread: Sequence[str] | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Match on whichever criteria a request fills in.

    Every table row is listed once per non-empty subset of the criteria columns, counted per
    (subset, values), and a request joins on the subset it fills. Adds `<prefix>_mask`,
    `<prefix>_count` and `<prefix>_value`.

    Requests that fill nothing, and those of keys that `hot_rows` requests or more share, are not gathered by key: they are dealt
    out by their columns `spread` (all, if not given), and the results of those keys, the `HOT_KEYS` largest at most, go to every task.
    """
    names = list(criteria)
    masks = [mask for size in range(1, len(names) + 1) for mask in combinations(range(len(names)), size)]

    def key(columns: Sequence[Column], mask: Sequence[int]) -> Column:
        return F.to_json(F.array(*[F.when(F.lit(i in mask), columns[i]) for i in range(len(names))]))

    cells = [F.coalesce(strip(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names]
    listed = table.select(
        F.explode(F.array(*[key(cells, mask) for mask in masks])).alias("__key"),
        F.col(value).cast("string").alias("__value"),
    )

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("__key").agg(F.count(F.lit(1)).alias(f"{prefix}_count"), F.min("__value").alias(f"{prefix}_value"))

    asked = [null_if_blank(c.cast("string")) for c in criteria.values()]
    request_key = F.to_json(F.array(*asked))
    any_filled = F.coalesce(*asked).isNotNull()
    keyed = requests.withColumns({
        f"{prefix}_mask": F.concat_ws(",", *[F.when(c.isNotNull(), F.lit(n)) for n, c in zip(names, asked)]),
        "__key": F.when(any_filled, request_key),
    })
    sizes = keyed.where("__key IS NOT NULL").groupBy("__key").agg(F.count(F.lit(1)).alias("__asked"))
    hot = sizes.where(F.col("__asked") >= hot_rows).orderBy(F.desc("__asked"), "__key").limit(HOT_KEYS).select("__key")
    found = counted(listed.join(F.broadcast(hot), "__key")).withColumnsRenamed({f"{prefix}_count": "__hot_count", f"{prefix}_value": "__hot_value"})
    known = hot.join(F.broadcast(found), "__key", "left").withColumn("__hot", F.lit(True))
    # no listed key begins like the texts that the rows are dealt out by
    apart = F.concat(F.lit("#"), F.xxhash64(*[F.col(f"`{c}`") for c in (requests.columns if spread is None else spread)]))
    dealt = keyed.join(F.broadcast(known), "__key", "left").withColumn(
        "__key", F.when(F.col("__key").isNull() | F.col("__hot").isNotNull(), apart).otherwise(F.col("__key")))
    return dealt.join(counted(listed), "__key", "left").withColumns({
        f"{prefix}_count": F.coalesce(F.col(f"{prefix}_count"), F.col("__hot_count"), F.lit(0)),
        f"{prefix}_value": F.coalesce(F.col(f"{prefix}_value"), F.col("__hot_value")),
    }).drop("__key", "__hot", "__hot_count", "__hot_value")


def first_match_lookup(
    requests: DataFrame, table: DataFrame, key: Column, table_key: str, value: str, order: str, name: str,
    case_insensitive: bool = False,
) -> DataFrame:
    """Single-key lookup; the first table row wins and a missing key gives empty text."""
    fold = (lambda c: F.lower(c)) if case_insensitive else (lambda c: c)
    table_side = table.select(
        fold(F.col(f"`{table_key}`").cast("string")).alias("__key"), F.col(f"`{value}`").cast("string").alias("__value"),
        F.col(f"`{order}`").alias("__order"),
    )
    reduced = table_side.groupBy("__key").agg(F.min_by("__value", "__order").alias(name))
    asked = requests.withColumn("__key", fold(F.nullif(key.cast("string"), F.lit(""))))
    return asked.join(reduced, "__key", "left").drop("__key").withColumn(name, F.coalesce(F.col(name), F.lit("")))

