"""One query per operator, over whole tables; SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, divergence, html_text, language, line_dedup, mixing, pii, quality, sentencepiece_bpe, simhash, suffix_dedup, toxicity,
               whitening)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(_documents(spark, sf_dir))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 5 == 0, F.lit(False))
    return found.select("row.doc_id", held.alias("held_out"), "score", "predicted")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_documents(spark, sf_dir)).withColumn("base", F.filter("spans", lambda s: s["base"]))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, pii.BASE), F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("row.page_id", "text")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_documents(spark, sf_dir)).drop("kept")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", *quality.SLACK)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedupe_lines(_documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return sentencepiece_bpe.encode(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")).select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_language, op3_toxicity, op4_simhash, op5_pii, op6_html, op7_suffix_dedup, op8_quality,
                                   op9_line_dedup, op10_decontamination, op11_whitening, op12_divergence, op13_sentencepiece)}

_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op8_quality": rf"""
WITH t AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
    unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
  FROM t WHERE len(w) > 3),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1)
  GROUP BY doc_id),
c AS (
  SELECT t.doc_id, lang, source, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS wc,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT * EXCLUDE (wc), coalesce(wc, 0) AS word_chars, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    CASE WHEN n_words > 0 THEN 100 * wc // n_words ELSE 0 END AS word_length,
    CASE WHEN wc > 0 THEN 1000 * n_symbols // wc ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats
  FROM c),
v AS (UNPIVOT (SELECT doc_id, lang, source, word_length, symbols, dup_lines, repeats FROM f)
      ON word_length, symbols, dup_lines, repeats INTO NAME feature VALUE x),
cells AS (
  SELECT lang, source, feature, n, CASE WHEN x < {quality.EXACT} THEN x ELSE (x >> s) << s END AS cell
  FROM (SELECT lang, source, feature, x, greatest(length(bin(x)) - {quality.BITS}, 0)::INT AS s, 1 AS n FROM v)),
q AS (
  SELECT g, lang, source, feature, max(docs) AS docs, min(cell) FILTER (100 * upto >= {quality.MID} * docs) AS mid,
    min(cell) FILTER (100 * upto >= {quality.HIGH} * docs) AS high
  FROM (SELECT *, sum(n) OVER (PARTITION BY g, lang, source, feature ORDER BY cell) AS upto,
               sum(n) OVER (PARTITION BY g, lang, source, feature) AS docs
        FROM (SELECT grouping(lang, source) AS g, lang, source, feature, cell, sum(n) AS n FROM cells
              GROUP BY GROUPING SETS ((lang, source, feature, cell), (lang, feature, cell), (feature, cell))))
  GROUP BY ALL),
lim AS (
  SELECT o.lang, o.source, o.feature, p.high + {quality.SPREAD} * (p.high - p.mid) + CASE o.feature
    {" ".join(f"WHEN '{k}' THEN {v}" for k, v in quality.SLACK.items())} END AS x
  FROM q o JOIN q l ON l.g = 1 AND o.lang IS NOT DISTINCT FROM l.lang AND o.feature = l.feature
  JOIN q e ON e.g = 3 AND o.feature = e.feature
  JOIN q p ON p.feature = o.feature AND p.g = CASE WHEN o.docs >= {quality.MIN_DOCS} THEN 0 WHEN l.docs >= {quality.MIN_DOCS} THEN 1 ELSE 3 END
    AND (p.g = 3 OR p.lang IS NOT DISTINCT FROM o.lang) AND (p.g > 0 OR p.source IS NOT DISTINCT FROM o.source)
  WHERE o.g = 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, word_length, symbols, dup_lines, repeats,
  NOT base_failed
    {" ".join(f"AND {k} <= (SELECT max(x) FROM lim WHERE feature = '{k}' AND lim.lang IS NOT DISTINCT FROM f.lang AND lim.source IS NOT DISTINCT FROM f.source)" for k in quality.SLACK)} AS kept
FROM f""",
    "op9_line_dedup": rf"""
WITH l AS (
  SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, {_KEY} AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key),
d AS (SELECT k.*, coalesce(owner <> doc_id, false) AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id""",
    "op12_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, count(*)::HUGEINT AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
counted AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.lang_n FROM g JOIN kept k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT *, 1 + {divergence.UNIT}::HUGEINT * (n + 2) // (sum(n) OVER s + 2 * count(*) OVER s) AS p,
    1 + {divergence.UNIT}::HUGEINT * (lang_n + 2) // (sum(lang_n) OVER s + 2 * count(*) OVER s) AS q
  FROM counted WINDOW s AS (PARTITION BY lang, source)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {divergence.TOP}""",
}
