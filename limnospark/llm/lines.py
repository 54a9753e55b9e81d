"""Removal of lines that repeat an earlier line: an exact set-similarity join with prefix, position and length filters.

A line is the set of its words; two lines match if the Jaccard similarity of their sets is at least the
threshold. A line goes if any line at an earlier place (doc_id, then a hash of the whole text for rows that share an
id or have none, then line number) matches it, whether that one stays or not, so the result does not depend on how the work is dealt.

Words are put in one order, the rarest first. Two sets of sizes x and y that match share at least
a = ceil(t / (1 + t) * (x + y)) words, so they share one among the first x - ceil(t x) + 1 of either: only these prefixes are
joined. A pair is dropped unless x and y are near enough in length, unless the words after the shared one can still make
a, and unless their bitmaps (the parity of words by hash) differ in no more places than x + y - 2 a. What is left is
verified on the words themselves.

Rarity comes from counts over all documents in a table of fixed size; two words that share a count's place only seem less rare.
Equal sets are merged first: the earliest line of each is kept or compared, the others go. A family of very many lines that differ a little would join with itself in the
square of its size, so lines are first compared with the first line of each of their rarest prefix words, and of their heavy ones; the
second comparison then asks only for lines still open: those of a light word meet in one task, those of a heavy one in a join. Every pair is
looked at until the line is decided.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from limnospark.llm.shared import NO_ID, release_memory, stored, text_of

COUNT_BITS = 20
CHUNK = 1 << 17
MERGED_AT_ONCE = 64
FILTER_BITS = 23
#: Occurrences above which a word is heavy, as so many times a count's mean and at least so many: a lighter word's lines
#: are few enough to be joined with each other.
HEAVY_TIMES, HEAVY_LEAST = 32, 512
#: How many of a line's rarest prefix words lead it to a line to be compared with first; sets with bitmaps of 64 bits.
LED_BY, SMALL_SET = 3, 64
BATCH_BYTES = 4 << 20  # text worked on together by a task
MET_AT_ONCE = 1 << 18  # entries, or their pairs, compared together by a task
_NONE = 1 << 40  # no word before
_ONE, _MIX = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)


_WIDEST = 256
# Random weights of a word's bytes by their position, for two hashes that do not depend on each other.
_WEIGHTS = np.random.default_rng(8).integers(0, 1 << 64, (2, _WIDEST), np.uint64) | _ONE


def _places(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), _tie(), text_of("text").alias("text"))


def _tie() -> Column:
    """Tells rows of one doc_id, or of none, apart by their texts."""
    return F.xxhash64(text_of("text")).alias("tie")


#: A line's place, and that of a line it may match.
PLACE, A_PLACE = ["doc", "tie", "line"], ["a_doc", "a_tie", "a_line"]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about `BATCH_BYTES` of text, one row at least."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch["text"]).to_numpy()), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
    release_memory()


def _lines(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row in the batch and number of each line, and the lines."""
    split = pc.split_pattern(batch["text"], "\n")
    counts = pc.list_value_length(split).to_numpy()
    rows = np.repeat(np.arange(batch.num_rows), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts), split.flatten()


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each word, in lower case (A-Z) and between ASCII blanks: which text it is of, and its place in the list of distinct words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = split.flatten().dictionary_encode()
    codes, distinct = words.indices.to_numpy(), words.dictionary
    empty = pc.index(distinct, "").as_py()  # a text of blanks alone, or blanks at its ends
    if empty >= 0:
        owner, codes = owner[codes != empty], codes[codes != empty]
        codes = codes - (codes > empty)
        distinct = distinct.filter(pc.not_equal(distinct, ""))
    return owner, codes, distinct


def _hashed(words: pa.Array) -> np.ndarray:
    """Two 64-bit hashes of each word: sums of its bytes by random weights, mixed; very wide words take the library's hash."""
    starts, ends = (np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1][i : i + len(words)] for i in (0, 1))
    sizes = (ends - starts).astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[starts[0] : ends[-1]].astype(np.uint64) + _ONE
    position = np.minimum(np.arange(len(data)) - np.repeat(starts - starts[0], sizes), _WIDEST - 1)
    result = np.stack([np.add.reduceat(data * weights[position], starts - starts[0]) for weights in _WEIGHTS])
    for i in np.flatnonzero(sizes >= _WIDEST).tolist():
        result[:, i] = [xxhash.xxh64_intdigest(words[i].as_py(), seed) for seed in (0, 1)]
    result = (result ^ result >> np.uint64(32)) * _MIX
    return result ^ result >> np.uint64(29)


def _counted_at(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of words by the low `COUNT_BITS` bits of their hashes, over all documents."""
    size = 1 << COUNT_BITS

    def own(batch: pa.RecordBatch) -> np.ndarray:
        _, codes, distinct = _words(batch["text"])
        if not len(codes):
            return np.zeros(size, np.int64)
        return np.bincount(_counted_at(_hashed(distinct)[0]), np.bincount(codes, minlength=len(distinct)), size).astype(np.int64)

    return counts_of(_places(docs), own)


def counts_of(docs: DataFrame, own: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of the tables of 2 ** `COUNT_BITS` counts that `own` makes of parts of the column text.

    Each task sends its table in a few chunks, which are added up `MERGED_AT_ONCE` at a time.
    """
    size = 1 << COUNT_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in _slices(batches):
            total += own(batch)
        part = TaskContext.get().partitionId()
        for chunk, at in enumerate(range(0, size, CHUNK)):
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "part": [part], "counts": [total[at : at + CHUNK].tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c.as_py(), np.int64) for c in table["counts"])
        return pa.table({"chunk": [table["chunk"][0].as_py()], "part": [table["part"][0].as_py() // MERGED_AT_ONCE], "counts": [counts.tobytes()]})

    kind = "chunk long, part long, counts binary"
    parts = stored(docs.select("text").mapInArrow(count, kind), "counts")
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:
        group = F.expr(f"part div {MERGED_AT_ONCE}").alias("group")
        parts = stored(parts.groupBy("chunk", group).applyInArrow(merge, kind), "counts")
    total = np.zeros(size, np.int64)
    for row in parts.collect():  # a table of fixed size
        total[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.int64)
    return total


def prefix_length(size, threshold: float):
    """Of sizes, how many words the prefixes have."""
    return size - np.ceil(threshold * np.asarray(size) - 1e-9).astype(np.int64) + 1


LINE_KIND = "doc long, tie long, line int, k1 long, k2 long, size int, bits1 long, bits2 long, light int, prefix array<int>"


def line_rows(docs: DataFrame, counts: np.ndarray, threshold: float, heavy: int) -> DataFrame:
    """Each line with words: its place, 128 bits that stand for its set, size, a bitmap of 128 bits, and its prefix.

    The prefix holds 32 bits of each word's hash, the rarest first; from position `light` on its words are heavy.
    """
    held = docs.sparkSession.sparkContext.broadcast(counts)  # as above, a fixed size
    names = [field.split()[0] for field in LINE_KIND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, numbers, lines = _lines(batch)
            owner, codes, distinct = _words(lines)
            if not len(codes):
                continue
            both = _hashed(distinct)
            hashes, seen = both[0], held.value[_counted_at(both[0])]
            rarest = np.lexsort((hashes, seen))  # distinct words, the rarest first
            rank = np.empty(len(rarest), np.int64)
            rank[rarest] = np.arange(len(rarest))
            pairs = np.sort(owner * len(rarest) + rank[codes])  # each line's words in this order
            pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
            owner, word = np.divmod(pairs, len(rarest))
            words, others, seen = hashes[rarest][word], both[1][rarest][word], seen[rarest][word]
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            own, sizes = owner[starts], np.diff(np.concatenate([starts, [len(owner)]]))
            lengths = prefix_length(sizes, threshold)
            position = np.arange(len(owner)) - np.repeat(starts, sizes)
            in_prefix = position < np.repeat(lengths, sizes)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            light = np.add.reduceat((in_prefix & (seen <= heavy)).astype(np.int32), starts)
            k1 = np.add.reduceat(words * _MIX, starts)
            k2 = np.add.reduceat((others ^ others >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9), starts)
            bit, half = _ONE << (words >> np.uint64(58)), (others >> np.uint64(63)).astype(bool)
            bits1, bits2 = (np.bitwise_xor.reduceat(np.where(half == h, bit, np.uint64(0)), starts) for h in (False, True))
            prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words[in_prefix].astype(np.uint32).view(np.int32)))
            yield pa.record_batch([
                batch["doc"].take(pa.array(rows[own])), batch["tie"].take(pa.array(rows[own])), pa.array(numbers[own], pa.int32()), k1.view(np.int64), k2.view(np.int64),
                pa.array(sizes, pa.int32()), bits1.view(np.int64), bits2.view(np.int64), pa.array(light, pa.int32()), prefix], names=names)

    return _places(docs).mapInArrow(run, LINE_KIND)


def _numbered(sets: DataFrame) -> DataFrame:
    """The sets with a number each, `id`, which stands for the place wherever entries are dealt out by words."""
    return sets if "id" in sets.columns else stored(sets.withColumn("id", F.monotonically_increasing_id()), "sets")


def _entries(sets: DataFrame, chosen: Column | None = None, *more: str) -> DataFrame:
    """A row for each word of a prefix: the word, its position, and of the set its number, document, size and bitmap.

    The bitmaps of sets of up to `SMALL_SET` words are folded into 64 bits, which tell such sets apart well enough.
    """
    small = F.col("size") <= SMALL_SET
    kept = sets.select(
        "id", "doc", "size", F.when(small, F.col("bits1").bitwiseXOR(F.col("bits2"))).otherwise(F.col("bits1")).alias("bits1"),
        F.when(small, 0).otherwise(F.col("bits2")).cast("long").alias("bits2"), "light", *more, F.posexplode("prefix").alias("at", "word"))
    return (kept if chosen is None else kept.where(chosen)).drop("light")


def _reaching(entries: DataFrame, threshold: float) -> DataFrame:
    """The entries with `reach` for their position: the largest size of a set that may match by this word.

    A larger set than that is too far in length, or the words after this one cannot make what must be shared with it.
    Two sets may match by a word if each is in the other's reach, which is both the length and the position filter. The margin
    only lets more through.
    """
    share = threshold / (1 + threshold)
    length, words = F.col("size") / F.lit(threshold), (F.col("size") - F.col("at")) / F.lit(share) - F.col("size")
    return entries.withColumn("reach", F.floor(F.least(length, words) + F.lit(1e-6)).cast("int")).drop("at")


def _may_match(a: str, b: str, threshold: float) -> Column:
    """Whether the sets of two entries with the same word may match, a's document not being later: length, position and bitmap.

    What leaves out most comes first: nearly all entries of a word are out of each other's reach.
    """
    ca, cb = (lambda name: F.col(f"{a}.{name}")), (lambda name: F.col(f"{b}.{name}"))
    both, share = ca("size") + cb("size"), threshold / (1 + threshold)
    ones, twos = ca("bits1").bitwiseXOR(cb("bits1")), ca("bits2").bitwiseXOR(cb("bits2"))
    apart = F.when((ca("size") <= SMALL_SET) | (cb("size") <= SMALL_SET), F.bit_count(ones.bitwiseXOR(twos))).otherwise(F.bit_count(ones) + F.bit_count(twos))
    return (
        (ca("size") <= cb("reach")) & (cb("size") <= ca("reach")) & (ca("doc") <= cb("doc")) & (ca("id") != cb("id"))
        & (apart <= both * F.lit(1 - 2 * share) + 1e-9)
    )


def _pairs(numbers: DataFrame, sets: DataFrame) -> DataFrame:
    """The places of the pairs of sets a_id and b_id whose first line is the earlier one, each once."""
    pairs = stored(numbers.distinct(), "numbers")
    asked = pairs.select(F.col("a_id").alias("id")).unionByName(pairs.select(F.col("b_id").alias("id"))).distinct()
    # the sets are dealt out once, and meet a table of the numbers at every size, so that the plan does not change with it
    places = stored(sets.select("id", F.struct(*PLACE).alias("place")).join(asked.hint("shuffle_hash"), "id"), "places")
    placed = pairs.join(places.select(F.col("id").alias("a_id"), F.col("place").alias("a")), "a_id").join(
        places.select(F.col("id").alias("b_id"), F.col("place").alias("b")), "b_id").where("a < b")
    return placed.select(*(F.col(f"b.{c}").alias(c) for c in PLACE), *(F.col(f"a.{c}").alias(f"a_{c}") for c in PLACE))


def leader_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """Lines against the first line of each of their rarest prefix words and of each of their heavy ones.

    Lines of one family share such words, so most of them are decided by one comparison for each word.
    """
    sets = _numbered(sets)
    rarest = F.when(F.col("light") >= F.size("prefix"), F.slice("prefix", 1, LED_BY)).otherwise(F.col("prefix"))
    entries = _reaching(_entries(sets.withColumn("prefix", rarest), (F.col("at") < LED_BY) | (F.col("at") >= F.col("light"))), threshold)
    first = entries.groupBy("word").agg(F.min(F.struct("doc", "id", "size", "bits1", "bits2", "reach")).alias("first"), F.count(F.lit(1)).alias("lines"))
    first = stored(first.where("lines > 1").select("word", "first.*"), "leaders")
    met = (F.col("a.word") == F.col("b.word")) & _may_match("a", "b", threshold)
    joined = first.hint("shuffle_hash").alias("a").join(entries.alias("b"), met)
    return _pairs(joined.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id")), sets)


def all_pairs(sets: DataFrame, threshold: float, closed: DataFrame | None = None) -> DataFrame:
    """Lines that are open, against all earlier lines with a common word in both prefixes.

    Open are the sets that are not among the places `closed`, or without such places those whose column `open` is 1.
    The lines of a light word are few: they stand together in a task, which compares only those in reach. Those of a heavy word are joined, so that
    Spark can split them. There both sides are one table dealt by word once: `open` stands in a condition on both, since a condition on one
    side would make two tables of it.
    """
    sets = _numbered(sets)

    def entries(sets: DataFrame, chosen: Column) -> DataFrame:
        if closed is not None:
            sets = sets.join(closed.select(*PLACE, F.lit(0).alias("open")).hint("shuffle_hash"), PLACE, "left").withColumn("open", F.coalesce("open", F.lit(1)))
        return _with_previous(_entries(sets, chosen, "open", "prefix"))

    light = _met(entries(sets, F.col("at") < F.col("light")), threshold)
    heavy = _joined(entries(sets.where(F.col("light") < F.size("prefix")), F.col("at") >= F.col("light")), threshold)
    numbers = heavy.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))
    return _pairs(light.unionByName(numbers), sets)


def _met(entries: DataFrame, threshold: float) -> DataFrame:
    """What `_joined` finds, as a_id and b_id, for words of few lines: a word's entries stand together by size, and each meets those in its reach.

    Word and size, and reach and `open`, are one number each, since a column costs more on its way to the task than the comparisons.
    """
    key = F.shiftleft(F.col("word").cast("long"), 32) + F.col("size")
    reach = F.shiftleft(F.col("reach").cast("long"), 1) + F.col("open")
    previous = F.coalesce(F.col("previous").cast("long"), F.lit(_NONE))
    rows = _reaching(entries, threshold).select(key.alias("key"), reach.alias("reach"), "id", "doc", "bits1", "bits2", previous.alias("previous"))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= MET_AT_ONCE:
                table = pa.Table.from_batches(held).combine_chunks()
                word = table["key"].to_numpy() >> 32
                upto = int(np.searchsorted(word, word[-1]))  # the last word may go on
                held, n = table.slice(upto).to_batches(), table.num_rows - upto
                yield from _in_reach(*(table[c].to_numpy()[:upto] for c in names), threshold)
        if held:
            yield from _in_reach(*(pa.Table.from_batches(held)[c].to_numpy() for c in names), threshold)
        release_memory()

    return rows.repartition(F.shiftright("key", 32)).sortWithinPartitions("key").mapInArrow(run, "a_id long, b_id long")


def _in_reach(key, reach, ids, docs, bits1, bits2, previous, threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of entries that `_joined` would make; they are in the order of their keys, a word's smallest set first."""
    size, word, share = key & 0xFFFFFFFF, key >> 32 << 32, threshold / (1 + threshold)
    open_, reach = reach & 1, reach >> 1
    first = np.searchsorted(key, word + np.ceil(threshold * size - 1e-6).astype(np.int64))
    last = np.minimum(np.searchsorted(key, word + np.minimum(size, reach), side="right"), np.arange(len(key)))
    counts = np.maximum(last - first, 0)
    ends = np.cumsum(counts)
    start = 0
    while start < len(key):
        before = ends[start - 1] if start else 0
        upto = max(start + 1, int(np.searchsorted(ends, before + MET_AT_ONCE, side="right")))
        own = counts[start:upto]
        large = np.repeat(np.arange(start, upto), own)
        small = np.arange(len(large)) - np.repeat(ends[start:upto] - own - before - first[start:upto], own)
        start = upto
        near = reach[small] >= size[large]
        small, large = small[near], large[near]
        ones, twos = bits1[small] ^ bits1[large], bits2[small] ^ bits2[large]
        apart = np.where(size[small] <= SMALL_SET, np.bitwise_count((ones ^ twos).view(np.uint64)), np.bitwise_count(ones.view(np.uint64)) + np.bitwise_count(twos.view(np.uint64)))
        starts = (previous[small] != previous[large]) | (previous[small] == _NONE)
        near = (apart <= (size[small] + size[large]) * (1 - 2 * share) + 1e-9) & starts & (ids[small] != ids[large])
        small, large = small[near], large[near]
        for a, b in ((small, large), (large, small)):
            kept = (docs[a] <= docs[b]) & (open_[b] > 0)
            if kept.any():
                yield pa.RecordBatch.from_pydict({"a_id": ids[a[kept]], "b_id": ids[b[kept]]})


def _with_previous(entries: DataFrame) -> DataFrame:
    """The entries with the word before theirs in the prefix, null for its first word."""
    return entries.withColumn("previous", F.get("prefix", F.col("at") - 1)).drop("prefix")


def _joined(entries: DataFrame, threshold: float) -> DataFrame:
    """Entries of lines that may match, the later one being open, by their common words.

    Near-copies share long runs of prefix words. A pair is made at the first word of a run alone: at a later one both entries have the same word
    before them, which makes the pair too, since it leaves more words after it and no other condition depends on the word.
    The entries are rows of a prefix each, which Spark does not count when it sizes them, so they are dealt out at every size.
    """
    starts = F.coalesce(F.col("a.previous") != F.col("b.previous"), F.lit(True))
    met = (F.col("a.word") == F.col("b.word")) & _may_match("a", "b", threshold) & (F.col("b.open") * 2 + F.col("a.open") >= 2) & starts
    entries = _reaching(entries, threshold).hint("merge")
    return entries.alias("a").join(entries.alias("b"), met)


def _marks(docs: np.ndarray, lines: np.ndarray, ties: np.ndarray | None = None) -> np.ndarray:
    """A line's place in the filter."""
    docs = docs.astype(np.uint64) if ties is None else docs.astype(np.uint64) ^ (ties.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    mixed = docs * _MIX + lines.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - FILTER_BITS)


def _filter_of(places: DataFrame) -> np.ndarray:
    """Bits of the places, in a table of fixed size: what is not in it is no such place."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            ties = batch["tie"].to_numpy() if "tie" in batch.schema.names else None
            bits[_marks(batch["doc"].to_numpy(), batch["line"].to_numpy(), ties)] = True
        at = np.flatnonzero(bits)
        words = np.zeros(1 << FILTER_BITS - 6, np.uint64)
        np.bitwise_or.at(words, at >> 6, _ONE << (at & 63).astype(np.uint64))
        own = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"at": own, "bits": words[own].view(np.int64)})

    marked = places.mapInArrow(mark, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(1 << FILTER_BITS - 6, np.int64)
    words[marked["at"].to_numpy()] = marked["bits"].to_numpy()
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def _distinct_words(lines: pa.Array) -> pa.ListArray:
    """Each line's words, once each."""
    owner, codes, distinct = _words(lines)
    owner, code = np.divmod(np.unique(owner * max(1, len(distinct)) + codes), max(1, len(distinct)))
    ends = np.searchsorted(owner, np.arange(len(lines) + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), distinct.take(pa.array(code)))


def _lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Different words of the lines at the places and their number, read from the documents again.

    A filter of fixed size leaves out nearly all other lines before anything is moved; the few that pass it
    are left out by the joins that follow.
    """
    held = docs.sparkSession.sparkContext.broadcast(_filter_of(places))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, numbers, lines = _lines(batch)
            kept = np.flatnonzero(held.value[_marks(batch["doc"].to_numpy()[rows], numbers, batch["tie"].to_numpy()[rows])])
            if len(kept):
                words = _distinct_words(lines.take(pa.array(kept)))
                yield pa.record_batch([*(batch[c].take(pa.array(rows[kept])) for c in ("doc", "tie")), pa.array(numbers[kept], pa.int32()), pc.list_value_length(words), pc.binary_join(words, " ")], names=[*PLACE, "n", "words"])

    return stored(_places(docs).mapInArrow(read, "doc long, tie long, line int, n int, words string"), "texts")


def _matching(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose words match.

    The common words stand once in the condition, since a filter works out a repeated expression again.
    """
    joined = pairs.join(texts, PLACE).join(texts.select(*(F.col(c).alias(f"a_{c}") for c in (*PLACE, "n", "words"))), A_PLACE)
    shared = F.size(F.array_intersect(F.split("words", " "), F.split("a_words", " ")))
    return joined.where(shared * F.lit(1 + threshold) >= (F.col("n") + F.col("a_n")) * F.lit(threshold) - 1e-9).select(*PLACE, *A_PLACE)


def verified(docs: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """`PLACE` and `A_PLACE`: each line that matches the other line of one of its pairs, with one such line.

    A line's earliest partner is tried first, which mostly decides it, and the others only if that one does not match.
    """
    pairs = stored(pairs, "pairs")
    places = pairs.select(*PLACE).unionByName(pairs.select(*(F.col(f"a_{c}").alias(c) for c in PLACE))).distinct()
    texts = _lines_at(docs, places)
    first = pairs.groupBy(*PLACE).agg(F.min(F.struct(*A_PLACE)).alias("a")).select(*PLACE, "a.*")
    first = stored(_matching(first, texts, threshold), "first")
    others = stored(pairs.join(first.select(*PLACE), PLACE, "left_anti"), "others")
    later = _matching(others, texts, threshold).groupBy(*PLACE).agg(F.min(F.struct(*A_PLACE)).alias("a"))
    return first.unionByName(later.select(*PLACE, "a.*"))


def _kept_places(docs: DataFrame, threshold: float, heavy: int | None) -> DataFrame:
    """Places of the lines with words that stay."""
    first = F.min(F.struct(*PLACE, "size", "bits1", "bits2", "light", "prefix")).alias("first")
    counts = word_counts(docs)
    if heavy is None:
        heavy = max(HEAVY_LEAST, HEAVY_TIMES * int(counts.mean()))
    rows = line_rows(docs, counts, threshold, heavy)
    sets = _numbered(rows.groupBy("k1", "k2").agg(first).select("first.*"))
    led = stored(verified(docs, leader_pairs(sets, threshold), threshold), "led")
    found = led.unionByName(verified(docs, all_pairs(sets, threshold, led), threshold))
    return sets.select(*PLACE).join(stored(found.select(*PLACE).distinct(), "found").hint("shuffle_hash"), PLACE, "left_anti")


def _named(place: str) -> Column:
    return F.when(F.col(place) != NO_ID, F.col(place))


def _kept_lines(docs: DataFrame, threshold: float, heavy: int | None) -> DataFrame:
    """doc, tie and the numbers of its lines with words that stay, for documents that keep one."""
    return stored(_kept_places(docs, threshold, heavy).groupBy("doc", "tie").agg(F.collect_set("line").alias("kept")), "kept")


def removed_lines(docs: DataFrame, threshold: float = 0.8, heavy: int | None = None) -> DataFrame:
    """doc_id, n_lines (its lines with words) and removed_lines (their numbers from 0, rising) of each document.

    Null texts count as empty, and lines without words do not count and never go. A null doc_id comes before all others.
    Rows that share a doc_id and have different texts are documents of their own, in the order of a hash of the text; with the same
    text they are one document repeated, and each gets its result. Rows of one text without an id are documents of
    their own too: all but one lose all their lines. An empty table gives no rows.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, numbers, lines = _lines(batch)
            worded = np.flatnonzero(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False))
            ends = np.searchsorted(rows[worded], np.arange(batch.num_rows + 1))
            yield pa.record_batch([batch["doc"], batch["tie"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers[worded], pa.int32()))], names=["doc", "tie", "lines"])

    numbered = _places(docs).mapInArrow(number, "doc long, tie long, lines array<int>")
    texts = numbered.groupBy("doc", "tie").agg(F.first("lines").alias("lines"), F.count("*").alias("rows"))
    rows = texts.join(_kept_lines(docs, threshold, heavy), ["doc", "tie"], "left").withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    stays = F.col("kept").isNotNull() & ((F.col("doc") != NO_ID) | (F.col("row") == 1))
    removed = F.when(stays, F.array_except("lines", "kept")).otherwise(F.col("lines"))
    return rows.select(_named("doc").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"), removed.alias("removed_lines"))


def without_repeated_lines(docs: DataFrame, threshold: float = 0.8, heavy: int | None = None) -> DataFrame:
    """The documents without the lines that match an earlier one; other columns as they are.

    Lines without words stay. Documents that had words and lose all of them go; those that never had any stay as they are.
    Rows that share a doc_id, or have none, are told apart as in `removed_lines`.
    """
    places = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    copies = F.col("doc_id").isNull() & text_of("text").rlike("[^ \\t\\n\\x0B\\f\\r]")  # each after the first loses all its words
    own = docs.where(~copies).unionByName(docs.where(copies).dropDuplicates(["text"]))
    kept = _kept_lines(docs, threshold, heavy).withColumnsRenamed({"doc": "__doc", "tie": "__tie", "kept": "__kept"})
    given = own.withColumn("__doc", places).withColumn("__tie", _tie()).join(kept, ["__doc", "__tie"], "left")
    given = given.select(*docs.columns, "__kept")
    schema, at = docs.schema, docs.columns.index("text")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stays = [], []
            for text, kept in zip(batch["text"].to_pylist(), batch["__kept"].to_pylist()):
                kept, lines = set(kept or ()), (text or "").encode().split(b"\n")
                left = [line for i, line in enumerate(lines) if i in kept or not line.split()]
                texts.append(text if len(left) == len(lines) else b"\n".join(left).decode())
                stays.append(bool(kept) or len(left) == len(lines))
            rows = batch.drop_columns(["__kept"])
            yield rows.set_column(at, "text", pa.array(texts, rows.schema.field("text").type)).filter(pa.array(stays, pa.bool_()))

    return given.mapInArrow(rewrite, schema)
