"""The training-data operators on the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from limnospark.llm import filter_audit, fingerprints, licenses, lines, mixing, packing, quality, runs, simhash, token_files, top_k, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), top_k.scaled(F.col("embedding")).alias("vector"))
    found = top_k.nearest(rows, 20, F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLES["op2_top_k"] = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op3_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with words of every document, how many stay, and the numbers of those that go."""
    found = lines.removed_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", (F.col("n_lines") - F.size("removed_lines")).alias("n_kept"), "removed_lines")


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_versions(table(spark, folder, "documents"))


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), VOCABULARY)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def held_out(name: str = "doc_id"):
    """Rows whose labels are kept for checking."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    weights = quality.fit(docs, table(spark, folder, "labels"), use=~held_out())
    return quality.score_documents(docs, weights, "doc_id").withColumn("held_out", held_out())


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write_tokens(table(spark, folder, "documents"), VOCABULARY)
    return token_files.read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read_records(warc.write_archives(table(spark, folder, "pages")))
    return records.select(
        warc.page_of("urn").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


@query
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents")).withColumn("n_spans", F.size("spans")).drop("spans")


def mix_levels() -> dict[str, Column]:
    """Domain, language and source: web text is one source, the others are books or news by their number."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int")
    domain = F.when(F.col("source") == "src0", "web").when(number % 2 == 0, "books").otherwise("news")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


MIX_WEIGHTS = {("web",): 2, ("books",): 5, ("news",): 3, ("*", "en"): 4, ("*", "de"): 3, ("*", "fr"): 2}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.75, 3, 7


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    budget = F.floor(F.col("total") * MIX_SHARE)
    return mixing.mix(table(spark, folder, "documents"), mix_levels(), budget, MIX_WEIGHTS, MIX_EPOCHS, seed=MIX_SEED)


def _split_sql(child: str, parent: str, path: list[str]) -> str:
    """Budgets of the nodes at `path` from those of their parents, as `mixing.budgets` has them."""
    over = f"PARTITION BY {', '.join(path[:-1])}" if path[:-1] else ""
    on = " AND ".join(f"c.{n} = p.{n}" for n in path[:-1]) or "TRUE"
    return f"""{child}_level AS (
  SELECT c.*, p.budget, (p.budget - coalesce(sum(c.capacity) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(c.weight) OVER (b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS fill
  FROM {child} c JOIN {parent} p ON {on}
  WINDOW b AS ({over.replace("PARTITION BY ", "PARTITION BY c.").replace(", ", ", c.")} ORDER BY c.capacity::DOUBLE / c.weight, c.{path[-1]})
), {child}_budget AS (
  SELECT {', '.join(path)}, tokens, least(capacity, floor(max(fill) OVER ({over}) * weight))::BIGINT AS budget FROM {child}_level
)"""


ORACLES["op10_mixing"] = f"""
WITH counted AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'web' WHEN try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 2 = 0 THEN 'books' ELSE 'news' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS tokens
  FROM documents
), third AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * {MIX_EPOCHS} AS capacity, 1 AS weight FROM counted GROUP BY ALL
), second AS (
  SELECT domain, lang, 0 AS tokens, sum(capacity)::BIGINT AS capacity, CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END AS weight
  FROM third GROUP BY ALL
), first AS (
  SELECT domain, 0 AS tokens, sum(capacity)::BIGINT AS capacity, CASE domain WHEN 'web' THEN 2 WHEN 'books' THEN 5 ELSE 3 END AS weight
  FROM second GROUP BY ALL
), root AS (
  SELECT least((SELECT sum(capacity) FROM first), floor(sum(tokens) * {MIX_SHARE}))::BIGINT AS budget FROM counted
), {_split_sql("first", "root", ["domain"])}, {_split_sql("second", "first_budget", ["domain", "lang"])},
{_split_sql("third", "second_budget", ["domain", "lang", "source"])}, plan AS (
  SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole FROM third_budget
), keyed AS (
  SELECT c.*, whole, budget - whole * p.tokens AS rest, md5(concat_ws(':', {MIX_SEED}, whole, doc_id)) AS key
  FROM counted c JOIN plan p USING (domain, lang, source)
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed
)
SELECT doc_id, domain, lang, source, tokens, unnest(range(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END))::INTEGER AS epoch
FROM placed
"""


def planted_runs(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text`; every tenth text by the hash of its id repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all(
        "text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("words")).withColumn("n", F.size("words").cast("long"))
    placed = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.greatest("n", F.lit(1)))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    changed = F.concat_ws(" ", F.transform("words", lambda word, i: F.when(i < F.col("a"), word).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.greatest("p", F.lit(1))).cast("int")))))
    return placed.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


@query
def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The longest run of every text, and digests of all its runs and of the text without their repeats."""
    found = runs.find_runs(planted_runs(table(spark, folder, "documents")), "doc_id")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    rows = found.withColumn("longest", longest)
    length, start, period = F.col("longest.length"), -F.col("longest.col2"), -F.col("longest.col3")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def toxicity_held_out(name: str = "doc_id") -> Column:
    """Rows whose toxicity labels are kept for checking."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    models = toxicity.fit(docs, table(spark, folder, "labels"), use=~toxicity_held_out())
    return toxicity.score_documents(docs, models, "doc_id").withColumn("held_out", toxicity_held_out())


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    found = filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.drop("filter")


ORACLES["op13_filter_audit"] = r"""
WITH known AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
facts AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(doc_id > first, first IS NOT NULL)} AS fails
  FROM words LEFT JOIN known USING (doc_id)
),
counts AS (
  SELECT part, fails.A::INTEGER + 2 * fails.B::INTEGER + 4 * fails.C::INTEGER + 8 * fails.D::INTEGER + 16 * fails.E::INTEGER AS failed,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM facts GROUP BY ALL
),
bits AS (SELECT unnest([1, 2, 4, 8, 16]) AS bit, unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM bits a, bits b, bits c, bits d, bits e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (SELECT filter_order, s.step::INTEGER AS step, bits[s.step] AS bit, coalesce(list_sum(bits[:s.step - 1]), 0)::INTEGER AS done FROM orders, range(1, 6) s(step)),
rows AS (
  SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (failed & (done | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (failed & done = 0 AND failed & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failed & done <> 0 AND failed & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (failed & done = 0 AND failed & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (failed & done = 0 AND failed & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM rows
"""
