"""How filters that are applied one after another interact, for all orders at once.

The sets of filters that have been applied are the states of a lattice: 2^k for k filters, with an edge from state S to
S + f for each filter f that S lacks. The edge's counts (rows that pass S and fail f) do not depend on the order that led
to S, so 5 filters need 80 edges and not 600 steps. Two passes over the lattice count the orders that reach a state
from the empty set and those that leave it for the full one; their product says how many orders go along an edge. A filter's
removals, summed over all orders, are those of its edges, weighted so; the steps of a single order are read from the same edges.

Rows are counted by part and by the set of filters that they fail, so all that follows is 2^k rows for each part at most.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from limnospark.llm.shared import stored

#: There are k! orders of k filters; each of them is a few rows of the result.
MOST_FILTERS = 7


def paths(k: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state of the lattice of k filters, and orders that go on from it to the full set."""
    states = 1 << k
    reach, leave = [1] + [0] * (states - 1), [0] * (states - 1) + [1]
    for state in range(states):
        for bit in range(k):
            if not state >> bit & 1:
                reach[state | 1 << bit] += reach[state]
    for state in reversed(range(states)):
        for bit in range(k):
            if not state >> bit & 1:
                leave[state] += leave[state | 1 << bit]
    return reach, leave


def failed_filters(filters: dict[str, Column]) -> Column:
    """Bits of the filters whose condition holds; a null condition is none."""
    if not 1 <= len(filters) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters are audited at a time, not {len(filters)}")
    bits = [F.when(condition, 1 << i).otherwise(0) for i, condition in enumerate(filters.values())]
    return sum(bits[1:], bits[0]).cast("int")


def lattice_edges(counts: DataFrame, k: int, losses: list[str]) -> DataFrame:
    """For each part and edge (state, bit): kept, removed, redundant, unique_fails and the losses removed.

    `counts` has part, failed, n and a count for each of `losses`, in any number of rows for each part and failed.
    """
    reach, leave = paths(k)
    mask, taken = F.col("state"), F.expr("shiftleft(1, bit)")
    ways = F.get(F.array(*map(F.lit, reach)), mask) * F.get(F.array(*map(F.lit, leave)), mask.bitwiseOR(taken))
    failed = F.col("failed")
    passes, fails = failed.bitwiseAND(mask) == 0, failed.bitwiseAND(taken) != 0

    def total(name: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(name)).otherwise(F.lit(0).cast("long")))

    return (
        counts.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1))))
        .withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        .where(mask.bitwiseAND(taken) == 0)
        .groupBy("part", "state", "bit")
        .agg(
            total("n", passes & ~fails).alias("kept"), total("n", passes & fails).alias("removed"),
            total("n", ~passes & fails).alias("redundant"), total("n", failed == taken).alias("unique_fails"),
            *(total(name, passes & fails).alias(name) for name in losses),
        )
        .withColumn("shapley", F.sum(F.col("removed") * ways).over(Window.partitionBy("part", "bit")))
    )


def audit(rows: DataFrame, filters: dict[str, Column], losses: dict[str, Column], part: Column | str = "part", n: Column | str | None = None) -> DataFrame:
    """One row for each part, order of the filters and step.

    `filters` gives each filter's name and the condition under which a row fails it; `losses` names further counts of removed
    rows, each with its condition; a null condition does not hold. `n` is how many rows a row stands for. Result: part,
    filter_order (the names, joined), step (from 1), filter (that of the step), kept (rows after the step), removed (in it), redundant (rows that fail
    the step's filter and are gone already), unique_fails (rows that fail no other filter), each of `losses` among those removed,
    and shapley, the filter's removals summed over all orders. A null part is the empty string; a table without rows gives none.
    """
    names = list(filters)
    weight = F.lit(1).cast("long") if n is None else (F.col(n) if isinstance(n, str) else n).cast("long")
    counts = (
        rows.select(
            F.coalesce(F.col(part) if isinstance(part, str) else part, F.lit("")).alias("part"), failed_filters(filters).alias("failed"),
            weight.alias("n"), *(F.when(condition, weight).otherwise(F.lit(0).cast("long")).alias(name) for name, condition in losses.items()),
        )
        .groupBy("part", "failed").agg(*(F.sum(name).alias(name) for name in ("n", *losses)))
    )
    edges = lattice_edges(counts, len(names), list(losses))
    steps = [
        (sum(1 << bit for bit in order[:at]), bit, "".join(names[b] for b in order), at + 1, names[bit])
        for order in permutations(range(len(names))) for at, bit in enumerate(order)
    ]
    orders = rows.sparkSession.createDataFrame(steps, "state int, bit int, filter_order string, step int, filter string")
    # k! * k rows, set by the number of filters
    return edges.join(F.broadcast(orders), ["state", "bit"]).select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", *losses, "shapley")


def copies_of_earlier(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The rows with `copy`: whether another row has the same `key` and a smaller `order`, which may be null (then it is the largest).

    `rows` should be grouped already, so that a key and order stand in few rows. A key may be that of any number of rows: it is
    reduced to its smallest order before the shuffle, and the rows meet it at (key, order), not at the key.
    """
    first = rows.groupBy(F.col(key).alias("__key")).agg(F.min(order).alias("__first"))
    known = rows.where(F.col(order).isNotNull()).join(
        first.where("__first IS NOT NULL"), (F.col(key) == F.col("__key")) & (F.col(order) == F.col("__first")), "left")
    unknown = rows.where(F.col(order).isNull()).join(first.where("__first IS NOT NULL"), F.col(key) == F.col("__key"), "left")
    return (
        known.withColumn("copy", F.col("__key").isNull()).select(*rows.columns, "copy")
        .unionByName(unknown.withColumn("copy", F.col("__key").isNotNull()).select(*rows.columns, "copy"))
    )


def document_filters(docs: DataFrame) -> DataFrame:
    """What the five filters of texts see, grouped: doc_id, part, short, repetitive, shouting, marked, copy, and n, the rows alike.

    Null texts are empty and have no words; the filters fail as their conditions say (an empty text is short and nothing
    else, but may be a copy). Rows of one id with one text are no copies of one another; a row without an id is a copy of every row of
    its text that has one. Very long texts are read whole; other columns do not matter.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"),
        F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)).alias("words"),
    )
    facts = words.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), (F.size("words") < 50).alias("short"),
        (100 * F.size(F.array_distinct("words")) < 65 * F.size("words")).alias("repetitive"),
        (100 * F.regexp_count("text", F.lit("[A-Z]")) > 5 * F.char_length("text")).alias("shouting"), F.col("text").rlike(r"[#$%&*|]").alias("marked"),
    )
    alike = stored(facts.groupBy(*facts.columns).agg(F.count(F.lit(1)).alias("n")), "filter-facts")  # read three times below
    found = copies_of_earlier(alike, "digest", "doc_id")
    # the digests have done their work: what is left of a document is its id, its part and its failures
    return found.groupBy("doc_id", "part", "short", "repetitive", "shouting", "marked", "copy").agg(F.sum("n").alias("n"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over documents: A short, B repetitive, C shouting, D marked, E copies; the parts are the sources.

    good_lost and toxic_lost count removed rows whose label says quality 1 and toxic 1. Of several labels of one id the largest
    holds; documents without an id or label count as neither.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("__good"), F.max((F.col("toxic") == 1).cast("int")).alias("__toxic"))
    facts = document_filters(docs)
    named = facts.where("doc_id IS NOT NULL").join(known, F.col("doc_id") == F.col("__id"), "left")
    rest = facts.where("doc_id IS NULL")
    rows = named.select(*facts.columns, "__good", "__toxic").unionByName(rest, allowMissingColumns=True)
    filters = {letter: F.col(name) for letter, name in zip("ABCDE", ("short", "repetitive", "shouting", "marked", "copy"))}
    return audit(rows, filters, {"good_lost": F.col("__good") == 1, "toxic_lost": F.col("__toxic") == 1}, n="n")
