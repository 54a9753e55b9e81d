"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests, in native expressions only.

A text's paragraphs are its runs between line breaks and sentence ends that hold more than blanks; each distinct one has a
64-bit digest. A sketch has three tables of cells. A digest is added to one cell of each table: the cell counts
it, and adds it and a check of it by exclusive or. Sketches of one size are subtracted cell by cell, which
leaves the digests in which two versions differ. A cell that holds one digest alone shows it by its check; taking that
digest out of its other cells lays open more. When no cell is left, the difference is known whole; when cells
are left that hold several digests each, the pair is tried again with twice the cells and other hashes.

Cells are rows here. Subtraction is a grouped sum over both versions' signed rows; a step of peeling lets each row of one
table that holds a single digest turn into the digest and what must be taken from the other tables, and sums again.
Rows stay where their document's key has put them, so no step moves data, and no row or group grows with the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from limnospark.llm.shared import NO_ID, partitions, stored, text_of

TABLES = 3
BASE_CELLS = 2  # of each table, in the printed fingerprint
ROUNDS = 6
# A cell's row: which table and cell of how large a table, packed into one long; found digests have their own mark.
FOUND = -1


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    parts = F.filter(F.split(text, "[.!?\n\r]+"), lambda part: F.length(F.trim(part)) > 0)
    return F.array_distinct(F.transform(parts, lambda part: F.xxhash64(part)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def _spot(digest: Column, number: int, size: Column, seed: int) -> Column:
    """Table, size and cell of a digest: two bits, thirty bits, thirty bits."""
    cell = F.pmod(F.xxhash64(digest, F.lit(number), F.lit(seed)), size)
    return F.lit(number << 60).bitwiseOR(F.shiftleft(size, 30)).bitwiseOR(cell)


def _size_of(spot: Column) -> Column:
    return F.shiftright(spot, 30).bitwiseAND(F.lit((1 << 30) - 1))


def printed(units: Column) -> Column:
    """The sketch of `BASE_CELLS` cells a table as text: of each cell the count, the digests and the checks, in hex."""
    empty = F.array(*[F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("keys"), F.lit(0).cast("long").alias("checks"))] * (TABLES * BASE_CELLS))

    def add(cells: Column, digest: Column) -> Column:
        def one(cell: Column, i: Column) -> Column:
            hit = F.pmod(F.xxhash64(digest, F.floor(i / BASE_CELLS)), F.lit(BASE_CELLS)) == i % BASE_CELLS
            more = F.struct((cell["n"] + 1).alias("n"), cell["keys"].bitwiseXOR(digest).alias("keys"), cell["checks"].bitwiseXOR(_check(digest)).alias("checks"))
            return F.when(hit, more).otherwise(cell)

        return F.transform(cells, one)

    cells = F.aggregate(units, empty, add)
    return F.array_join(F.transform(cells, lambda c: F.concat(
        F.lpad(F.hex(c["n"]), 4, "0"), F.lpad(F.hex(c["keys"]), 16, "0"), F.lpad(F.hex(F.shiftrightunsigned(c["checks"], 32)), 8, "0"))), "")


def cell_rows(pairs: DataFrame, seed: int) -> DataFrame:
    """Cells of the sketches' differences. `pairs` has key, pair, left, right (digests) and size (cells of a table)."""
    signed = F.concat(
        F.transform("left", lambda d: F.struct(F.lit(1).cast("long").alias("n"), d.alias("digest"))),
        F.transform("right", lambda d: F.struct(F.lit(-1).cast("long").alias("n"), d.alias("digest"))),
    )
    units = pairs.select("key", "pair", "size", F.explode(signed).alias("unit")).select("key", "pair", "size", "unit.*")
    digest = F.col("digest")
    spots = F.explode(F.array(*(_spot(digest, t, F.col("size"), seed) for t in range(TABLES))))
    rows = units.select("key", "pair", "n", digest.alias("keys"), _check(digest).alias("checks"), spots.alias("spot"))
    return _sum(rows.withColumn("found", F.lit(0).cast("long")))


def _sum(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy("key", "pair", "spot", "found").agg(
        F.sum("n").alias("n"), F.bit_xor("keys").alias("keys"), F.bit_xor("checks").alias("checks"))
    return summed.where("n <> 0 OR keys <> 0 OR checks <> 0")


def peel(cells: DataFrame, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """Found digests (spot = FOUND; n is 1 for the left version's, -1 for the right one's) and cells that stay closed."""
    for step in range(rounds * TABLES):
        number = step % TABLES
        size, keys = _size_of(F.col("spot")), F.col("keys")
        alone = (
            (F.shiftright("spot", 60) == number) & (F.abs("n") == 1) & (F.col("checks") == _check(keys))
            & (F.col("spot") == _spot(keys, number, size, seed))
        )

        def row(spot: Column, n: Column, found: Column, keys: Column, checks: Column) -> Column:
            return F.struct(spot.alias("spot"), n.alias("n"), found.alias("found"), keys.alias("keys"), checks.alias("checks"))

        zero = F.lit(0).cast("long")
        opened = [row(_spot(keys, t, size, seed), -F.col("n"), zero, keys, F.col("checks")) for t in range(TABLES) if t != number]
        opened.append(row(F.lit(FOUND).cast("long"), F.col("n"), keys, zero, zero))
        same = row(F.col("spot"), F.col("n"), F.col("found"), keys, F.col("checks"))
        turned = F.explode(F.when(alone, F.array(*opened)).otherwise(F.array(same)))
        cells = _sum(cells.select("key", "pair", turned.alias("row")).select("key", "pair", "row.*"))
    return cells


def differences(pairs: DataFrame, seed: int) -> DataFrame:
    """key, pair, differing (digests found), closed (cells left); pairs without a difference have no row."""
    rows = peel(cell_rows(pairs, seed), seed)
    is_found = F.col("spot") == FOUND
    return rows.groupBy("key", "pair").agg(F.count(F.when(is_found, 1)).alias("differing"), F.count(F.when(~is_found, 1)).alias("closed"))


def _enough(left: Column, right: Column, tries: int) -> Column:
    """Cells of each table: for two thirds of the paragraphs of both versions, at least 4; twice as many each time."""
    return ((4 + F.ceil((F.size(left) + F.size(right)) * 0.66)) * (1 << tries)).cast("long")


def following(ids: DataFrame) -> DataFrame:
    """(key, next) for distinct keys in `ids`: the next larger one, after the last the first.

    Keys are sorted in ranges; only the first key of each range is looked at together.
    """
    spark = ids.sparkSession
    ranges = ids.repartitionByRange(partitions(spark), "key").withColumn("part", F.spark_partition_id())
    ranges = stored(ranges.select("key", "part"), "ranges")
    inside = ranges.withColumn("next", F.lead("key").over(W.partitionBy("part").orderBy("key")))
    firsts = ranges.groupBy("part").agg(F.min("key").alias("first"))
    firsts = firsts.select("part", F.lead("first").over(W.orderBy("part")).alias("later"), F.min("first").over(W.partitionBy()).alias("lowest"))
    return inside.join(F.broadcast(firsts), "part").select("key", F.coalesce("next", "later", "lowest").alias("next"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document with its edited text: the last quarter of its characters replaced by the first as many (or all) of the
    document with the next larger doc_id, after the last the first. Columns key, text, edited, next_units.

    The key is the doc_id, with null as the smallest long. Where rows share an id, the next document is the row whose
    beginning is smallest. Texts are dealt out by key once and joined twice.
    """
    given = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), text_of("text").alias("text"))
    lengths = stored(given.groupBy("key").agg(F.max(F.floor(F.length("text") / 4)).alias("wanted")), "lengths")
    heads = lengths.join(following(lengths.select("key")), "key").select(F.col("next").alias("key"), F.col("key").alias("before"), "wanted")
    heads = stored(heads, "heads")
    head = F.struct(F.expr("substring(text, 1, int(wanted))").alias("head"), digests(F.col("text")).alias("units"))
    sent = given.join(heads, "key").groupBy(F.col("before").alias("key")).agg(F.min(head).alias("after"))
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - cut), F.substring(F.col("after.head"), F.lit(1), cut))
    return given.join(sent, "key").select("key", "text", edited.alias("edited"), F.col("after.units").alias("next_units"))


def _pairs_of(rows: DataFrame, tries: int) -> DataFrame:
    """Both comparisons of each document; the last bit of `pair` says which."""
    both = F.explode(F.array(*(
        F.struct((F.col("version") + i).alias("pair"), F.col("units").alias("left"), F.col(other).alias("right")) for i, other in enumerate(("edited_units", "next_units")))))
    pairs = rows.select("key", both.alias("both")).select("key", "both.*").where("left IS NOT NULL AND right IS NOT NULL")
    return pairs.withColumn("size", _enough(F.col("left"), F.col("right"), tries))


def _likeness(differing: str, left: str, right: str) -> Column:
    return F.coalesce(1 - F.try_divide(F.col(differing), F.col(left) + F.col(right)), F.lit(1.0))


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and its edited text, and their likeness as the sketches' differences show it.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Likeness of two versions is
    1 less the share of their distinct paragraphs that only one has; it is 1 where neither has any. Null
    texts count as empty, a null doc_id as the smallest long, which is given back as null. All rows are kept; rows alike in id and
    text are alike in the result. An empty table gives none.
    """
    rows = edited_pairs(docs).select(
        "*", F.shiftleft(F.shiftright(F.xxhash64("text"), 1), 1).alias("version"), digests(F.col("text")).alias("units"), digests(F.col("edited")).alias("edited_units"))
    # one row for each id and text takes part in the sums
    compared = rows.groupBy("key", "version").agg(*(F.first(c).alias(c) for c in ("units", "edited_units", "next_units")))
    found = differences(_pairs_of(compared, 0), 0)
    which = F.col("pair").bitwiseAND(F.lit(1).cast("long"))
    found = found.groupBy("key", F.shiftleft(F.shiftright("pair", 1), 1).alias("own")).agg(*(
        F.sum(F.when(which == i, F.col(c))).alias(f"{c}_{i}") for i in (0, 1) for c in ("differing", "closed")))
    columns = rows.select(
        F.col("key").alias("id"), "version", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("units")).alias("fingerprint"), printed(F.col("edited_units")).alias("edited_fingerprint"), "units", "edited_units", "next_units")
    # the join is on the key alone, by which both sides are already dealt; the version only picks among its few rows
    joined = columns.join(found, (F.col("id") == F.col("key")) & (F.col("version").bitwiseXOR(F.col("own")) == 0), "left")
    sizes = [F.size(c).alias(f"n_{c}") for c in ("units", "edited_units", "next_units")]
    closed = [F.coalesce(F.col(f"closed_{i}"), F.lit(0)) > 0 for i in (0, 1)]
    first = stored(joined.select(
        F.col("id").alias("key"), "version", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *sizes,
        *(F.when(~closed[i], F.coalesce(F.col(f"differing_{i}"), F.lit(0))).alias(f"differing_{i}") for i in (0, 1)),
        F.when(closed[0] | closed[1], F.col("units")).alias("units"), F.when(closed[0], F.col("edited_units")).alias("edited_units"),
        F.when(closed[1], F.col("next_units")).alias("next_units")), "sketches")
    later = _try_again(first)
    if later is not None:
        first = first.drop("units", "edited_units", "next_units").join(later, ["key", "version"], "left").withColumns(
            {f"differing_{i}": F.coalesce(f"differing_{i}", f"later_{i}") for i in (0, 1)})
    return first.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        _likeness("differing_0", "n_units", "n_edited_units").alias("near_edited"), _likeness("differing_1", "n_units", "n_next_units").alias("near_next"))


def _try_again(first: DataFrame) -> DataFrame | None:
    """Differences of the pairs that stayed closed (key, version, later_0, later_1), with sketches doubled until all are open."""
    failed = first.where("units IS NOT NULL").groupBy("key", "version").agg(*(F.first(c).alias(c) for c in ("units", "edited_units", "next_units")))
    pairs, done, tries = stored(_pairs_of(failed, 1), "closed"), None, 1
    while pairs.head(1):
        result = differences(pairs, tries)
        joined = stored(pairs.join(result, ["key", "pair"], "left"), "opened")
        opened = joined.where("coalesce(closed, 0) = 0").select("key", "pair", F.coalesce("differing", F.lit(0)).alias("differing"))
        done = opened if done is None else done.unionByName(opened)
        pairs = joined.where("closed > 0").select("key", "pair", "left", "right", (F.col("size") * 2).alias("size"))
        tries += 1
    if done is None:
        return None
    which = F.col("pair").bitwiseAND(F.lit(1).cast("long"))
    return stored(done.groupBy("key", F.shiftleft(F.shiftright("pair", 1), 1).alias("version")).agg(*(
        F.max(F.when(which == i, F.col("differing"))).alias(f"later_{i}") for i in (0, 1))), "later")
