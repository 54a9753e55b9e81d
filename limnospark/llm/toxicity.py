"""Toxicity scores by two Kneser-Ney models of the letters of words, one of toxic and one of ordinary documents.

A word is read with a blank on either side, and each of its letters is predicted from the `order` - 1 before it in the word. A
gram of `order` letters, or a shorter one at the beginning of a word, is counted once for each document of the class
and distinct word of it; any other shorter gram counts the different letters seen before it, as Kneser and Ney have it. With
the discount D = n1 / (n1 + 2 n2) of each length and class,

    P(letter | context) = max(n(context letter) - D, 0) / n(context) + D types(context) / n(context) P(letter | shorter context).

Down to `shared` + 1 letters the classes have counts of their own; shorter contexts are counted over all documents, labelled or
not, and are the same for both. So an expression that is too rare to be known in a class is judged by shorter parts
of it, and in the end by what the classes share, which favours neither.

A document's likeness is log P(text | toxic) - log P(text | ordinary), divided by its length in letters. The logarithms depend on the word
alone, so a task works each word out once: the longest gram known decides, each unknown one adds the ratio of the classes' backoff weights.
A logistic curve over the likeness, fitted to labelled documents that the models have not seen, makes it a score.

The counts cover all documents. What goes to every task is bounded: the `most` most frequent grams and contexts at most. If there are more, the
documents' grams that are not among those are looked up in the whole table by a join, so that every gram counts as it is.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from limnospark.llm.shared import documents, release_memory, stored, text_of

_COUNTS = ("n_all", "n_toxic", "n_ordinary")
#: Words that a task remembers, and as many older ones, and the length from which it remembers none.
_REMEMBER, _LONG = 200_000, 64


@dataclass
class Models:
    """What scoring needs: the ratio of the classes for known grams, the ratio of their backoff weights for known contexts."""

    order: int = 4
    shared: int = 2
    grams: dict[str, float] = field(default_factory=dict)
    contexts: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    middle: float = 0.0
    #: All grams and contexts (key, value, is_gram), if there are more than are held here.
    table: DataFrame | None = None

    def held(self) -> Models:
        """What goes to the tasks."""
        return replace(self, table=None)

    def word(self, word: str) -> float:
        """log P(word | toxic) - log P(word | ordinary)."""
        grams = grams_of(word, self.order, self.shared + 1)  # shorter ones are what the classes share
        try:
            return sum(map(self.grams.__getitem__, grams))
        except KeyError:
            return sum(self.unknown(gram) if value is None else value for gram, value in zip(grams, map(self.grams.get, grams)))

    def unknown(self, gram: str) -> float:
        """The ratio for the last letter of a gram that is not known: that of the longest known part, and the weights on the way to it."""
        total = 0.0
        while len(gram) > self.shared:
            known = self.grams.get(gram)
            if known is not None:
                return total + known
            total += self.contexts.get(gram[:-1], 0.0)
            gram = gram[1:]
        return total

    def score(self, likeness: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * (likeness - self.middle), -35, 35))))


class _Words(dict):
    """Values of the words met of late: those not asked for again until `_REMEMBER` others were met are forgotten."""

    def __init__(self, models: Models):
        super().__init__()
        self.models, self.older = models, {}

    def __missing__(self, word: str) -> float:
        value = self.older.get(word)
        if value is None:
            value = self.models.word(word)
            if len(word) >= _LONG:
                return value
        if len(self) >= _REMEMBER:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


def words_of(text: str) -> list[str]:
    return text.lower().split()


def grams_of(word: str, order: int, least: int = 2) -> list[str]:
    """For each letter of a word and the blank after it, the letter and up to `order` - 1 before it, if that makes `least` letters; the word has
    a blank before it, too."""
    marked = f" {word} "
    return [marked[:end] for end in range(least, min(order, len(marked) + 1))] + [marked[i:i + order] for i in range(len(marked) - order + 1)]


def likeness(text: str, values: _Words) -> float:
    """Per letter, the blank after a word being one; a text without words is like the average document, 0."""
    words = words_of(text)
    return sum(map(values.__getitem__, words)) / (sum(map(len, words)) + len(words)) if words else 0.0


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """gram and, for each class, how often it is met in the distinct words of its documents: n_all, n_toxic, n_ordinary.

    `docs` has text and label (1, 0 or null). Words are counted within a task first, and only then cut into grams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = {label: Counter() for label in (None, 0, 1)}

        def grams() -> pa.RecordBatch:
            found = {label: defaultdict(int) for label in words}
            for label, counted in words.items():
                into, alike = found[label], defaultdict(list)
                for word, n in counted.items():
                    alike[n].append(word)
                for n, some in alike.items():  # most words are rare, so few counts differ
                    for gram, times in Counter(chain.from_iterable(grams_of(word, order) for word in some)).items():
                        into[gram] += n * times
                counted.clear()
            keys = list(set().union(*found.values()))
            toxic, ordinary = ([found[label].get(key, 0) for key in keys] for label in (1, 0))
            every = [found[None].get(key, 0) + t + o for key, t, o in zip(keys, toxic, ordinary)]
            return pa.record_batch([pa.array(keys, pa.string()), *(pa.array(c, pa.int64()) for c in (every, toxic, ordinary))], names=["gram", *_COUNTS])

        size = 0
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"].to_pylist()):
                text = text.as_py()
                words[label].update(set(words_of(text)))
                size += len(text)
                if size > 256 << 20 or sum(map(len, words.values())) > 2 * _REMEMBER:
                    yield grams()
                    size = 0
        yield grams()
        release_memory()

    parts = docs.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "gram string, n_all long, n_toxic long, n_ordinary long")
    return parts.groupBy("gram").agg(*(F.sum(name).alias(name) for name in _COUNTS))


def _shorter(longer: DataFrame, short: DataFrame) -> DataFrame:
    """Counts of grams one letter shorter: those at the beginning of words as they are, others by the letters seen before them."""
    before = longer.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*(F.count_if(F.col(n) > 0).alias(n) for n in _COUNTS))
    return short.unionByName(before)


def _level(counts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """For each of `names`: d_ the discounted share of a gram in its context, w_ the context's backoff weight."""
    rare = counts.agg(*(F.count_if(F.col(n) == c).alias(f"{n}_{c}") for n in names for c in (1, 2))).first()  # two numbers for each class
    discounts = {n: min(rare[f"{n}_1"] / (rare[f"{n}_1"] + 2 * rare[f"{n}_2"]), 0.95) if rare[f"{n}_1"] else 0.5 for n in names}
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    totals = counts.groupBy(context.alias("context")).agg(
        *(F.sum(n).alias(f"sum_{n}") for n in names), *(F.count_if(F.col(n) > 0).alias(f"types_{n}") for n in names))
    joined = counts.withColumn("context", context).join(totals, "context")
    for n in names:
        known = F.col(f"sum_{n}") > 0
        joined = joined.withColumn(f"d_{n}", F.when(known, F.greatest(F.col(n) - discounts[n], F.lit(0.0)) / F.col(f"sum_{n}")).otherwise(0.0))
        joined = joined.withColumn(f"w_{n}", F.when(known, discounts[n] * F.col(f"types_{n}") / F.col(f"sum_{n}")).otherwise(1.0))
    return joined.select("gram", "context", *names, *(f"{k}_{n}" for n in names for k in "dw"))


def ratios(counts: DataFrame, order: int, shared: int) -> DataFrame:
    """key, value, n and whether it is a gram: the log ratio of the classes at each gram of more than `shared` letters, and the log ratio
    of their backoff weights at each context of `shared` letters or more."""
    if not 1 <= shared < order:
        raise ValueError("the shared order lies between 1 and the order")
    by_length = {order: counts.where(F.length("gram") == order)}
    for k in range(order - 1, 0, -1):
        by_length[k] = stored(_shorter(by_length[k + 1], counts.where(F.length("gram") == k)), "toxicity-counts")
    lower = by_length[1].select(F.col("gram").alias("rest"), F.lit(1 / max(by_length[1].count(), 1)).alias("p"))
    for k in range(1, shared + 1):
        level = _level(by_length[k], ("n_all",))
        # single letters rest on the same chance for each
        rest = F.expr("substring(gram, 2)") if k > 1 else F.col("gram")
        level = level.withColumn("rest", rest).join(lower, "rest")
        lower = level.select(F.col("gram").alias("rest"), (F.col("d_n_all") + F.col("w_n_all") * F.col("p")).alias("p"))
    lower = stored(lower.select("rest", F.col("p").alias("p_toxic"), F.col("p").alias("p_ordinary")), "toxicity-shared")
    found = None
    for k in range(shared + 1, order + 1):
        level = _level(by_length[k].where("n_toxic > 0 OR n_ordinary > 0"), ("n_toxic", "n_ordinary"))
        level = level.withColumn("rest", F.expr("substring(gram, 2)")).join(lower, "rest")
        level = stored(level.select(
            "gram", "context", (F.col("n_toxic") + F.col("n_ordinary")).alias("n"), "w_n_toxic", "w_n_ordinary",
            *((F.col(f"d_n_{c}") + F.col(f"w_n_{c}") * F.col(f"p_{c}")).alias(f"p_{c}") for c in ("toxic", "ordinary"))), "toxicity-level")
        grams = level.select(F.col("gram").alias("key"), F.log(F.col("p_toxic") / F.col("p_ordinary")).alias("value"), "n", F.lit(True).alias("is_gram"))
        weights = level.groupBy(F.col("context").alias("key")).agg(
            F.log(F.first("w_n_toxic") / F.first("w_n_ordinary")).alias("value"), F.sum("n").alias("n"), F.lit(False).alias("is_gram"))
        both = grams.unionByName(weights)
        found = both if found is None else found.unionByName(both)
        lower = level.select(F.col("gram").alias("rest"), "p_toxic", "p_ordinary")
    return found


def _most_frequent(found: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The rows above a count at which no more than `most` remain, and whether they are all; counts are told apart by an eighth of an octave."""
    size = F.floor(8 * F.log2(F.col("n"))).cast("int")
    held = sorted(((r.size, r.rows) for r in found.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)  # 512 rows at most
    total, least = 0, 0
    for level, rows in held:
        total += rows
        if total > most:
            least = level + 1
            break
    return found.where(size >= least), least == 0


def _curve(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve of least loss, with a weak pull to a slope of 0; values are limited to where the curve can turn.

    The rarer class counts more, by the root of how much rarer it is."""
    if not len(values) or labels.min() == labels.max():
        return 1.0, 0.0
    x, more = np.clip(values, -1, 1), np.where(labels == 1, np.sqrt((labels == 0).sum() / (labels == 1).sum()), 1.0)
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        w, error = more * p * (1 - p) + 1e-9, more * (p - labels)
        gradient = np.array([np.dot(error, x) + 1e-4 * a, error.sum()])
        bend = np.array([[np.dot(w, x * x) + 1e-4, np.dot(w, x)], [np.dot(w, x), w.sum()]])
        step = np.linalg.solve(bend, gradient)
        step *= min(1.0, 30 / max(abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return (float(a), float(-b / a)) if a > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", use: Column | None = None, order: int = 4, shared: int = 2,
        most: int = 1 << 20, curve: int = 8_192) -> Models:
    """Models learnt from all labelled documents, and a curve fitted to at most `curve` of them that are kept out of the models.

    `use` chooses label rows by their columns. Rows without an id or label are left out; of several labels of one id the largest holds. The
    curve takes a fifth of the ids, those whose hash says so. Without labelled documents of both classes every score is 0.5. The shared counts take in
    every document, repeated rows as often as they occur.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = (known if use is None else known.where(use)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col(label).cast("int")).alias("label"))
    known = stored(known.withColumn("for_curve", F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(5)) == 0), "toxicity-labels")
    texts = documents(docs)
    # merged whatever the labels' size, so that the plan is the same on small and large tables
    marked = texts.where("doc_id IS NOT NULL").join(known.hint("merge"), "doc_id", "left").select(
        "text", F.when(~F.col("for_curve"), F.col("label")).alias("label"))
    nameless = texts.where("doc_id IS NULL").select("text", F.lit(None).cast("int").alias("label"))
    counts = stored(count_grams(marked.unionByName(nameless), order), "toxicity-grams")
    models = Models(order, shared)
    seen = counts.agg(F.max("n_toxic"), F.max("n_ordinary")).first()
    if not seen[0] or not seen[1]:
        return models
    found = stored(ratios(counts, order, shared), "toxicity-ratios")
    frequent, whole = _most_frequent(found, most)
    models.table = None if whole else found
    rows = frequent.select("key", "value", "is_gram").toArrow()  # `most` rows
    for key, value, is_gram in zip(*(rows[c].to_pylist() for c in ("key", "value", "is_gram"))):
        (models.grams if is_gram else models.contexts)[key] = value
    chosen = known.where("for_curve").withColumn("order", F.xxhash64(F.lit("curve"), "doc_id")).orderBy("order", "doc_id").limit(curve)
    sample = texts.join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")  # `curve` small rows at most
    points = score_documents(sample, models, "label").select("likeness", "label").toPandas()
    models.slope, models.middle = _curve(points.likeness.to_numpy(), points.label.to_numpy())
    return models


def score_documents(docs: DataFrame, models: Models, *keep: str, threshold: float = 0.5) -> DataFrame:
    """The columns `keep` of each row with `likeness`, `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Null and empty texts have no words and a likeness of 0. Rows are scored one by one: repeated rows score alike, all rows are kept, and an
    empty table gives an empty one. Columns named as the new ones cannot be kept.
    """
    taken = {"likeness", "score", "predicted"} & set(keep)
    if taken:
        raise ValueError(f"{sorted(taken)} are names of the result")
    if models.table is not None:
        return _scored_by_table(docs, models, keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    held = docs.sparkSession.sparkContext.broadcast(models)
    given = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    fields = docs.select(*keep).schema.fields
    schema = StructType([*fields, StructField("likeness", DoubleType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _Words(held.value)
        for batch in batches:
            found = [likeness(text.as_py() or "", values) for text in batch["__text"]]
            scores = [held.value.score(x) for x in found]
            columns = [*(batch[f.name] for f in fields), pa.array(found, pa.float64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        values.clear()
        values.older.clear()
        release_memory()

    return given.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _open_grams(text: str, models: Models) -> tuple[float, int, Counter]:
    """The sum over the grams that the models hold, the number of letters, and the other grams with their counts."""
    total, letters, other = 0.0, 0, Counter()
    for word, n in Counter(words_of(text)).items():
        letters += n * (len(word) + 1)
        for gram in grams_of(word, models.order, models.shared + 1):
            value = models.grams.get(gram)
            if value is None:
                other[gram] += n
            else:
                total += n * value
    return total, letters, other


def _values(grams: DataFrame, models: Models) -> DataFrame:
    """gram and value of distinct grams, as `Models.unknown` has them, by joins with the whole table."""
    known, weights = models.table.where("is_gram"), models.table.where("NOT is_gram")
    lengths = range(models.order, models.shared, -1)
    asked = {models.order: grams}  # any lengths; a shorter gram is its own shorter part
    for k in lengths[1:]:
        asked[k] = asked[k + 1].select(F.expr(f"right(gram, least({k}, length(gram)))").alias("gram")).distinct()
    value = None
    for k in reversed(lengths):
        rows = asked[k].join(known.select(F.col("key").alias("gram"), F.col("value").alias("own")), "gram", "left")
        context = F.expr("substring(gram, 1, length(gram) - 1)")
        rows = rows.withColumn("context", F.when(F.length("gram") == k, context))
        rows = rows.join(weights.select(F.col("key").alias("context"), F.col("value").alias("weight")), "context", "left")
        shorter = F.lit(0.0)
        if value is not None:
            rows = rows.withColumn("rest", F.expr(f"right(gram, least({k - 1}, length(gram)))"))
            rows, shorter = rows.join(value.select(F.col("gram").alias("rest"), F.col("value").alias("below")), "rest", "left"), F.col("below")
        value = rows.select("gram", F.coalesce("own", F.coalesce("weight", F.lit(0.0)) + shorter).alias("value"))
    return value


def _scored_by_table(docs: DataFrame, models: Models, keep: tuple[str, ...]) -> DataFrame:
    """The columns `keep` with likeness and score, for more grams than a task can hold."""
    spark, names = docs.sparkSession, [f"__{i}" for i in range(len(keep))]
    held = spark.sparkContext.broadcast(models.held())
    given = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), text_of("text").alias("__text"))
    fields = [*given.schema.fields[:-1], *StructType.fromDDL("__sum double, __letters long, __open array<struct<gram: string, n: long>>").fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_open_grams(text.as_py(), held.value) for text in batch["__text"]]
            other = [[{"gram": g, "n": n} for g, n in o.items()] for _, _, o in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array([s for s, _, _ in found], pa.float64()), pa.array([n for _, n, _ in found], pa.int64()),
                 pa.array(other, pa.list_(pa.struct([("gram", pa.string()), ("n", pa.int64())])))], names=[f.name for f in fields])
        release_memory()

    rows = stored(given.mapInArrow(run, StructType(fields)).withColumn("__row", F.monotonically_increasing_id()), "toxicity-rows")
    grams = rows.select("__row", F.inline("__open").alias("gram", "n"))
    values = _values(grams.select("gram").distinct(), models)
    sums = grams.join(values, "gram").groupBy("__row").agg(F.sum(F.col("n") * F.col("value")).alias("__more"))
    total = F.col("__sum") + F.coalesce("__more", F.lit(0.0))
    likeness = F.when(F.col("__letters") > 0, total / F.col("__letters")).otherwise(0.0)
    power = F.greatest(F.least(F.lit(models.slope) * (F.col("likeness") - models.middle), F.lit(35.0)), F.lit(-35.0))
    return rows.join(sums, "__row", "left").select(*(F.col(n).alias(c) for n, c in zip(names, keep)), likeness.alias("likeness")).withColumn(
        "score", 1 / (1 + F.exp(-power)))
