"""Operators over groups of any size.

A group (one file, one station) may hold a large share of all rows, so none of these puts a
whole group into one task. Ordered work runs on blocks of consecutive positions and carries
small per-block results across; joins against one-row-per-group tables salt the few groups
whose size is far above the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

# Rows of one group that one task sorts together.
BLOCK_POSITIONS = 65_536
# Blocks that the rows of one group without a position are dealt out to.
MISSING_PARTS = 1_024
# A group is hot above this share of all rows, so fewer than 1,024 groups can be hot.
HOT_SHARE = 1.0 / 1024
HOT_MIN_ROWS = 1_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; the left key columns are kept."""
    if how in ("full", "right"):
        raise ValueError("only joins that keep the left keys")
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"__right_{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`") for c in right.columns if c not in keys],
    )
    condition = None
    for i, key in enumerate(keys):
        term = F.col(f"`{key}`").eqNullSafe(F.col(f"__right_{i}"))
        condition = term if condition is None else condition & term
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__right_{i}" for i in range(len(keys))])


def _block(position: str, width: int) -> Column:
    """Block of a position; missing positions have a block of their own, before all others."""
    return F.coalesce(F.floor(F.col(position) / width), F.lit(-(1 << 62))).cast("bigint")


def attach_group_values(
    df: DataFrame, keys: Sequence[str], position: str, values: Mapping[str, Column], width: int = BLOCK_POSITIONS
) -> DataFrame:
    """Add per-group aggregates to every row. `position` is a row or line number, dense or not.

    The aggregates meet the rows by group and block, for the blocks that occur.
    """
    blocked = df.withColumn("__block", _block(position, width))
    per_group = blocked.groupBy(*keys).agg(*[value.alias(name) for name, value in values.items()])
    per_block = null_safe_join(blocked.select(*keys, "__block").distinct(), per_group, keys)
    return null_safe_join(blocked, per_block, [*keys, "__block"], "left").drop("__block")


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    ties: Sequence[str] = (),
    rank: str = "rank",
    size: str | None = None,
    width: int = BLOCK_POSITIONS,
) -> DataFrame:
    """1-based rank by `position` (then `ties`) inside each group, and the group size if asked.

    Rank = rank inside the block + rows in the blocks before it. Rows without a position come first. They may be any number, so
    they are dealt out to blocks of their own: by the first tie where it is a number, else, without ties, by a hash of
    the row, since any order of them will do.
    """
    missing = F.col(position).isNull()
    if not ties:
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(MISSING_PARTS))
    elif isinstance(df.schema[ties[0]].dataType, T.NumericType):
        part = F.floor(F.col(f"`{ties[0]}`") / width)
    else:
        part = F.lit(0)
    blocked = df.withColumn("__block", _block(position, width)).withColumn("__part", F.when(missing, part).cast("bigint"))
    block = [*keys, "__block", "__part"]
    inside = W.partitionBy(*block).orderBy(F.col(position).asc_nulls_first(), *ties)
    counts = blocked.groupBy(*block).agg(F.count(F.lit(1)).alias("__n"))
    over_blocks = W.partitionBy(*keys).orderBy("__block", F.col("__part").asc_nulls_first())
    offsets = counts.select(
        *block,
        F.coalesce(F.sum("__n").over(over_blocks.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__n").over(W.partitionBy(*keys)).alias("__size"),
    )
    ranked = null_safe_join(blocked.withColumn("__inside", F.row_number().over(inside)), offsets, block).withColumn(
        rank, (F.col("__inside") + F.col("__before")).cast("bigint"))
    if size:
        ranked = ranked.withColumn(size, F.col("__size"))
    return ranked.drop("__block", "__part", "__inside", "__before", "__size")


def join_group_table(
    rows: DataFrame,
    per_group: DataFrame,
    keys: Sequence[str],
    size: str,
    salt_on: Sequence[str],
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Inner-join rows to a one-row-per-group table that carries each group's row count in `size`.

    Groups above `HOT_SHARE` of all rows are split over several salts. There are fewer than
    1 / HOT_SHARE of them, so the list of hot groups is broadcast with a proven bound.
    `salt_on` must tell the rows of a group apart (pre-aggregate copies first).
    """
    total = per_group.agg(F.sum(size)).scalar()
    part = F.greatest(total * HOT_SHARE, F.lit(float(min_rows)))
    hot = (
        per_group.where(F.col(size) > part)
        .select(*keys, F.ceil(F.col(size) / part).cast("int").alias("__salts"))
    )
    tagged = null_safe_join(rows, F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.coalesce(F.pmod(F.xxhash64(*salt_on), F.col("__salts")), F.lit(0)).cast("int")
    ).drop("__salts")
    fanned = null_safe_join(per_group, F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))
    ).drop("__salts", size)
    return null_safe_join(tagged, fanned, [*keys, "__salt"]).drop("__salt")


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median", share: float = 0.0005, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Exact median per group: copies are counted first, then only the values next to the middle are ordered.

    Approximate quantiles a `share` of the rows below and above the middle bound those, however the values
    are spread. Groups without any value get no row.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    copies = rows.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__w"))
    near = F.percentile_approx("__v", F.array(F.lit(0.5 - share), F.lit(0.5 + share)), F.lit(int(4 / share)))
    bounds = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), near.alias("__near"))
    sizes = copies.groupBy(*keys).agg(F.count(F.lit(1)).alias("__distinct"))
    placed = join_group_table(copies, null_safe_join(sizes, bounds, keys), keys, "__distinct", ["__v"], min_rows).withColumn(
        "__bucket", F.when(F.col("__v") < F.col("__near")[0], 0).when(F.col("__v") <= F.col("__near")[1], 1).otherwise(2)).drop("__near")
    filled = placed.groupBy(*keys, "__bucket").agg(F.sum("__w").alias("__bw"), F.first("__n").alias("__n"))
    order = W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    low, high = F.floor((F.col("__n") + 1) / 2), F.floor(F.col("__n") / 2) + 1
    middle = (
        filled.withColumn("__before", F.coalesce(F.sum("__bw").over(order), F.lit(0)))
        .withColumns({"__low": low, "__high": high})
        .where(
            ((F.col("__before") < F.col("__low")) & (F.col("__low") <= F.col("__before") + F.col("__bw")))
            | ((F.col("__before") < F.col("__high")) & (F.col("__high") <= F.col("__before") + F.col("__bw")))
        )
        .select(*keys, "__bucket", "__before", "__low", "__high")
    )
    running = W.partitionBy(*keys, "__bucket").orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = null_safe_join(
        placed.select(*keys, "__bucket", "__v", "__w"), middle, [*keys, "__bucket"]
    ).withColumn("__upto", F.col("__before") + F.sum("__w").over(running))
    start = F.col("__upto") - F.col("__w")

    def holds(rank: str) -> Column:
        return (start < F.col(rank)) & (F.col(rank) <= F.col("__upto"))

    return (
        ranked.where(holds("__low") | holds("__high"))
        .groupBy(*keys)
        .agg(
            ((F.max(F.when(holds("__low"), F.col("__v"))) + F.max(F.when(holds("__high"), F.col("__v")))) / 2)
            .alias(name)
        )
    )
