"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    ann,
    filter_audit,
    langid,
    linededup,
    packing,
    phrases,
    quotes,
    runs,
    sentencepiece_codec,
    sharding,
    simhash,
    toxicity,
    warc,
)
from ledgerline.llm.common import table
from ledgerline.session import work_path

#: Where the public tokenizer files are; a cluster names its own folder here.
TOKENIZERS_CONF = "spark.ledgerline.tokenizers"
TOKENIZERS = "file:///opt/tokenizers"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_conversations(table(spark, sf_dir, "conversations"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        sharding.row_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprints(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = spark.conf.get(TOKENIZERS_CONF, TOKENIZERS)
    model = sentencepiece_codec.load(spark, f"{folder}/piece_bpe_32k.model")
    return sentencepiece_codec.encode_digest(table(spark, sf_dir, "documents"), model)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "lines_before", "lines_deleted", "runs_deleted", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives and index of the whole table, then every capture looked up and read back."""
    pages, folder = table(spark, sf_dir, "pages"), work_path(spark, "warc")
    warc.archive(pages, folder)
    return warc.resolve(warc.open_archive(spark, folder, pages))


def with_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``; where crc32 of the id as text is divisible by ten, the words
    from a place on repeat with a period, both given by that number."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    solid = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.when(h % 10 == 0, solid).alias("words"), F.expr("crc32(binary(string(doc_id))) div 10").alias("g"))
    placed = cut.withColumn("at", F.expr("try_mod(g, size(words))"))
    placed = placed.withColumn("period", F.expr("1 + (size(words) - at) div (3 + g % 8)"))
    tailed = F.expr("transform(words, (w, i) -> if(i < at, w, words[int(at + (i - at) % period)]))")
    repeated = F.when(F.size("words") > 0, F.array_join(tailed, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", repeated.alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_tails(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", runs.foremost(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000L * best.length) div best.period").alias("exponent_milli"),
        F.sha2(runs.runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_quotes": op3_quotes,
    "op4_sharding": op4_sharding,
    "op5_phrases": op5_phrases,
    "op6_neighbours": op6_neighbours,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_line_dedup": op8_line_dedup,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_warc": op12_warc,
    "op13_runs": op13_runs,
}

_WORDS = r"[^\x20\x09-\x0D]+"


def _line_dedup(words: int, docs: int) -> str:
    """Windows of non-blank lines that have ``words`` words and would not have them
    without their first or without their last line; all but a window's first copy
    lose their lines. So do windows that ``docs`` documents hold: a line with a letter,
    and what lines without letters lie between it and the line in question."""
    return rf"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS line
  FROM documents WHERE text IS NOT NULL
),
s AS (
  SELECT doc_id, line, x, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos,
         len(regexp_extract_all(x, '{_WORDS}')) AS words, regexp_matches(x, '\p{{L}}') AS letter
  FROM l WHERE regexp_matches(x, '{_WORDS}')
),
a AS (
  SELECT doc_id, pos, list(x) OVER w AS xs, list(words) OVER w AS ws, list({{'line': line, 'pos': pos}}) OVER w AS spots
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {words - 1} FOLLOWING)
),
n AS (SELECT *, unnest(range(1, len(xs) + 1)) AS n FROM a),
w AS (
  SELECT doc_id, pos, xs[1:n] AS run, spots[1:n] AS spots FROM n
  WHERE list_sum(ws[1:n]) >= {words}
    AND (COALESCE(list_sum(ws[1:n - 1]), 0) < {words} OR COALESCE(list_sum(ws[2:n]), 0) < {words})
),
copies AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS copy FROM w),
g AS (
  SELECT *, count(*) FILTER (WHERE letter) OVER (PARTITION BY doc_id ORDER BY pos) AS opened,
         count(*) FILTER (WHERE letter) OVER (PARTITION BY doc_id ORDER BY pos DESC) AS closed
  FROM s
),
near AS (
  SELECT doc_id, pos, line, list(x) OVER (PARTITION BY doc_id, opened ORDER BY pos) AS run, opened > 0 AS ok FROM g
  UNION ALL
  SELECT doc_id, pos, line, list(x) OVER (PARTITION BY doc_id, closed ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         closed > 0 AND NOT letter FROM g
),
held AS (SELECT run, count(DISTINCT doc_id) AS docs FROM near WHERE ok GROUP BY run HAVING count(DISTINCT doc_id) >= {docs}),
common AS (SELECT near.*, row_number() OVER (PARTITION BY near.run ORDER BY doc_id, pos) AS copy FROM near JOIN held ON near.run = held.run WHERE ok),
gone AS (
  SELECT DISTINCT doc_id, unnest(spots, recursive := true) FROM copies WHERE copy > 1
  UNION SELECT doc_id, line, pos FROM common WHERE copy > 1
),
runs AS (
  SELECT doc_id, count(*) AS deleted, count(*) FILTER (WHERE before IS NULL OR before + 1 < pos) AS runs
  FROM (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY doc_id
),
kept AS (
  SELECT l.doc_id, count(*) AS lines, string_agg(l.x, chr(10) ORDER BY l.line) FILTER (WHERE gone.line IS NULL) AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.line = gone.line GROUP BY l.doc_id
)
SELECT d.doc_id, COALESCE(kept.lines, 0) AS lines_before, COALESCE(runs.deleted, 0) AS lines_deleted,
       COALESCE(runs.runs, 0) AS runs_deleted, CASE WHEN d.text IS NOT NULL THEN sha256(COALESCE(kept.text, '')) END AS text_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN runs ON d.doc_id = runs.doc_id"""


_FILTER_AUDIT = rf"""WITH d AS (
  SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS x FROM documents
),
w AS (
  SELECT *, regexp_extract_all(x, '{_WORDS}') AS ws, length(regexp_replace(x, '[^A-Z]', '', 'g')) AS capitals,
         min(doc_id) OVER (PARTITION BY x) AS first_id
  FROM d
),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic,
         concat(CASE WHEN len(ws) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
                CASE WHEN 100 * capitals > 2 * length(x) THEN 'C' END, CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' END,
                CASE WHEN w.doc_id > first_id THEN 'E' END) AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
m AS (SELECT part, failed, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(string_split('A B C D E', ' ')) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
       JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
s AS (
  SELECT *, substr(filter_order, step, 1) AS x,
         translate(substr(filter_order, 1, step - 1), failed, '') <> substr(filter_order, 1, step - 1) AS gone,
         contains(failed, substr(filter_order, step, 1)) AS fails
  FROM m CROSS JOIN steps
),
c AS (
  SELECT part, filter_order, step, x,
         COALESCE(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept, COALESCE(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed,
         COALESCE(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant, COALESCE(sum(n) FILTER (WHERE failed = x), 0) AS unique_fails,
         COALESCE(sum(n) FILTER (WHERE NOT gone AND fails AND good), 0) AS good_lost,
         COALESCE(sum(n) FILTER (WHERE NOT gone AND fails AND toxic), 0) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM c"""

_WARC = """WITH p AS (
  SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes, sha256(COALESCE(html, '')) AS payload_digest FROM pages
),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f"""

#: Where SQL can express the operator. The others hash, shuffle, pack or learn in
#: ways that SQL has no functions for; tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op8_line_dedup": _line_dedup(linededup.MIN_WORDS, linededup.COMMON_DOCS),
    "op11_filter_audit": _FILTER_AUDIT,
    "op12_warc": _WARC,
}
