"""Mixing sources to target weights by budgets that run down a tree, in native expressions only.

The tree's levels are columns of the documents, by default domain, language and source; its leaves are the
combinations that occur. A node's capacity is what its leaves hold, times the epochs allowed. The root's budget is split
among its children by weight. A child that cannot take its part is filled, and its shortage goes to its
siblings by weight; only what all of them cannot take is left to the level above, whose nodes are split first, with
capacities that already say so. With children in the order of capacity over weight, the level of water

    w(i) = (budget - capacities before i) / weights from i on

rises as long as children are filled and falls after, so its maximum is the level, and a child's
budget is the smaller of its capacity and its weight times the level, in whole tokens.

A leaf then takes whole epochs while its budget lasts, and of one more epoch the documents that come first in that epoch's
seeded order, up to the budget. The order is by a hash, so the last key taken is found by sums over its leading digits:
no leaf is sorted as a whole, and the documents themselves are only filtered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from limnospark.llm.shared import stored, text_of

# A word of a text is a run of anything but ASCII blanks.
WORD = "[^ \\t\\n\\x0B\\f\\r]+"
#: Leading hex digits of the order looked at in one step, and steps before a leaf's rest is sorted.
DIGITS, STEPS = 2, 2


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], int], default: int) -> Column:
    """The weight of the node at a path; the mapping is part of the request, so it is written into the plan."""
    named = [(key, value) for key, value in weights.items() if len(key) == len(path)]
    result = F.lit(default)
    for key, value in reversed(named):
        same = F.lit(True)
        for column, part in zip(path, key):
            same = same & (F.lit(part == "*") | (F.col(column) == part))
        result = F.when(same, F.lit(value)).otherwise(result)
    return result.cast("long")


def budgets(leaves: DataFrame, levels: Sequence[str], budget: Column, weights: Mapping[tuple[str, ...], int],
            epochs: int = 1, default: int = 1) -> DataFrame:
    """Adds `budget` to the leaves (`levels` and `tokens`, one row each).

    `budget` is a column over the sum of all tokens, `total`. A weight is that of a path from the root, in
    which "*" stands for any name; the first one named counts, other nodes weigh `default`. Nodes of weight 0 take nothing.
    """
    nodes = {len(levels): leaves.withColumn("capacity", F.col("tokens") * epochs)}
    for depth in range(len(levels), 0, -1):
        path = list(levels[:depth])
        own = nodes[depth].withColumn("weight", _weight(path, weights, default))
        nodes[depth] = own.withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0))
        nodes[depth - 1] = nodes[depth].groupBy(*path[:-1]).agg(F.sum("capacity").alias("capacity"))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).select(budget.cast("long")).first()[0]
    root, given = min(total, nodes[0].first()["capacity"] or 0), None  # one row each
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        parent = path[:-1]
        children = nodes[depth].join(given, parent) if parent else nodes[depth].withColumn("budget", F.lit(root).cast("long"))
        by_fill = W.partitionBy(*parent).orderBy(F.try_divide(F.col("capacity"), F.col("weight")).asc_nulls_last(), path[-1])
        before = F.coalesce(F.sum("capacity").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        onward = F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
        level = F.try_divide((F.col("budget") - before).cast("double"), onward.cast("double"))
        children = children.withColumn("level", level).withColumn("level", F.max("level").over(W.partitionBy(*parent)))
        part = F.least("capacity", F.floor(F.col("level") * F.col("weight")))
        given = children.withColumn("budget", F.coalesce(part, F.lit(0)).cast("long")).select(*path, *(["tokens"] if depth == len(levels) else []), "budget")
    return given


def _order(seed: int, epoch: str) -> Column:
    """Place of a document in an epoch: hex digits that no other seed, epoch or id share."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(epoch), F.col("doc_id")))


def _last_keys(counted: DataFrame, plan: DataFrame, levels: Sequence[str], seed: int) -> DataFrame:
    """For each leaf with a started epoch the last key that is taken (null if none): key at most `last`.

    Each step sums the tokens by the next digits, keeps the digits at which the budget runs out, and looks
    only at those documents from then on.
    """
    open_ = plan.where("rest > 0").select(*levels, "whole", F.col("rest").alias("left")).withColumn("lead", F.lit(""))
    rows = counted.select(*levels, "doc_id", "tokens")
    for step in range(1, STEPS + 1):
        open_ = stored(open_, "open")
        digits = F.substring(_order(seed, "whole"), 1, DIGITS * step)
        inside = rows.join(open_, list(levels)).where(F.substring(_order(seed, "whole"), 1, DIGITS * (step - 1)) == F.col("lead"))
        sums = inside.groupBy(*levels, "whole", "left", digits.alias("next")).agg(F.sum("tokens").alias("tokens"))
        upto = F.sum("tokens").over(W.partitionBy(*levels).orderBy("next").rowsBetween(W.unboundedPreceding, W.currentRow))
        over = sums.withColumn("upto", upto).where("upto > left").groupBy(*levels, "whole", "left").agg(
            F.min(F.struct("next", (F.col("left") - F.col("upto") + F.col("tokens")).alias("left"))).alias("first"))
        open_ = over.select(*levels, "whole", F.col("first.left").alias("left"), F.col("first.next").alias("lead"))
    open_ = stored(open_, "open")
    inside = rows.join(open_, list(levels)).withColumn("key", _order(seed, "whole")).where(F.col("key").startswith(F.col("lead")))
    peers = W.partitionBy(*levels).orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    taken = inside.withColumn("upto", F.sum("tokens").over(peers)).where("upto <= left")
    found = taken.groupBy(*levels).agg(F.max("key").alias("key"))
    # nothing of the last digits taken: all keys below them are
    return open_.join(found, list(levels), "left").select(*levels, F.coalesce("key", "lead").alias("last"))


def plan_mix(docs: DataFrame, levels: Mapping[str, Column], budget: Column, weights: Mapping[tuple[str, ...], int],
             epochs: int = 1, default: int = 1, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Documents with their words counted (doc_id, levels, tokens), and each leaf's part of the mix.

    A leaf's part: tokens, budget, whole (epochs taken whole), rest (tokens of the next), last (its last key taken).
    """
    names = list(levels)
    counted = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()),
        words(text_of("text")).alias("tokens")), "counted")
    leaves = stored(counted.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "leaves")
    plan = budgets(leaves, names, budget, weights, epochs, default)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("int")
    plan = plan.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = stored(plan, "plan")
    last = _last_keys(counted, plan, names, seed)
    return counted, stored(plan.join(last, names, "left"), "mix")


def take(rows: DataFrame, plan: DataFrame, names: Sequence[str], seed: int, epoch: str = "epoch") -> DataFrame:
    """Each row once for each epoch that takes it, with the epoch in the column `epoch`.

    `rows` has doc_id and the levels; other columns may have any names but that of the epoch. The plan has a row for each leaf and is joined
    by Spark's own choice.
    """
    own = [F.col(n).alias(f"__mix_{n}") for n in ("whole", "rest", "last")]
    more = F.coalesce(_order(seed, "__mix_whole") <= F.col("__mix_last"), F.lit(False)) & (F.col("__mix_rest") > 0)
    kept = rows.join(plan.select(*names, *own), list(names))
    epochs = F.when(more, F.col("__mix_whole") + 1).otherwise(F.col("__mix_whole"))
    chosen = kept.withColumn("__mix_epochs", epochs).where("__mix_epochs > 0")
    return chosen.select(*rows.columns, F.explode(F.sequence(F.lit(0), F.col("__mix_epochs") - 1)).alias(epoch))


def mix(docs: DataFrame, levels: Mapping[str, Column], budget: Column, weights: Mapping[tuple[str, ...], int],
        epochs: int = 1, default: int = 1, seed: int = 0) -> DataFrame:
    """doc_id, the levels, tokens and epoch of every document that the mix takes, once for each epoch.

    Null levels count as empty names, null texts as empty; a document without words is taken with its leaf's whole epochs
    and where its place comes before a taken one. Rows that share a doc_id share its place: they are
    taken together or not at all. Whole tokens are given out, so up to a token for each node may stay unused. An empty
    table gives none.
    """
    counted, plan = plan_mix(docs, levels, budget, weights, epochs, default, seed)
    return take(counted, plan, list(levels), seed)
