"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidemark.llm import bpe, exact_dedup, jaccard, licenses, lm, main_text, mixing, negatives, pii, prefix_trie, quality, secrets, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and signatures of every document."""
    found = licenses.scan_licenses(documents(spark, sf_dir))
    first = F.transform("base", lambda b: b["first"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    more = F.transform("found", lambda f: f["label"])
    sure = F.coalesce(F.array_max(F.transform("found", lambda f: f["weight"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(sure, F.when(F.size("base") > 0, licenses.PHRASE).otherwise(0.0)).alias("score"),
    )


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_lm_score(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Log probability of every document, learnt from nine tenths of the ids."""
    tokens = bpe.Vocabulary(vocabulary or public_tokenizers.path("word_bpe_49k.json"))
    return lm.score_documents(documents(spark, sf_dir), tokens, held_out=remainder("doc_id", 10) == 0)


def op4_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Every document encoded with a public vocabulary and decoded again."""
    coder = bpe.Vocabulary(vocabulary or public_tokenizers.path("word_bpe_49k.json"))
    return bpe.encode_documents(documents(spark, sf_dir), coder).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts; the largest id stays."""
    found = exact_dedup.duplicate_groups(documents(spark, sf_dir), keep="max", carry={"text_sha256": lambda t: F.sha2(t, 256)})
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long"), "kept", "text_sha256")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secrets.find_secrets(documents(spark, sf_dir)).select(
        "doc_id", *[count(r.kind) for r in secrets.BASE_RULES], F.sha2(secrets.spelled(base), 256).alias("base_sha256"), secrets.spelled(F.col("spans")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.quality_report(documents(spark, sf_dir)).select(
        "doc_id", F.col("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base kinds, and all spans."""
    base = F.filter("spans", lambda s: s["kind"] < 4)

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")

    return pii.find_personal_data(documents(spark, sf_dir)).select(
        "doc_id", *[count(k) for k in range(4)], F.sha2(pii.spelled(base), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"),
    )


def remainder(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model that has seen labels of two thirds of the ids only."""
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), may_learn=remainder("doc_id", 3) != 1)
    return toxicity.score_documents(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id that links of similar shingle sets reach."""
    return jaccard.similar_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some of whose labels are moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), is_anchor=F.col("id") % 100 == 0, label=label)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, each of which borrows its first turns from the first of its five."""
    return prefix_trie.prefix_trie(
        spark.read.parquet(f"{sf_dir}/conversations.parquet"), base=lambda c: c - c % 5, borrowed=lambda c: F.crc32(c.cast("string").cast("binary")) % 9, most=8
    )


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_mix, op3_lm_score, op4_bpe, op5_exact_dedup, op6_secret_scan, op7_quality_rules, op8_personal_data, op9_toxicity,
        op10_jaccard_join, op11_hard_negatives, op12_prefix_trie, op13_html_extraction,
    )
}

ORACLE = {
    "op2_mix": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws(':', 'mix', CAST(doc_id AS VARCHAR))) AS h, md5(coalesce(text, '')) AS text_hash
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS fully FROM s),
r AS (SELECT *, fully / weight AS ratio FROM w),
p AS (
  SELECT *, coalesce(sum(fully) OVER lower, 0) AS fully_before, coalesce(sum(weight) OVER lower, 0) AS weight_before,
         sum(source_size) OVER () AS words, sum(weight) OVER () AS all_weight
  FROM r WINDOW lower AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (1.5::DOUBLE * words - fully_before) / (all_weight - weight_before) AS level FROM p),
f AS (SELECT level AS free_level, ratio AS free_ratio, rank AS free_rank FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN free_level IS NULL OR ratio < free_ratio OR (ratio = free_ratio AND rank < free_rank) THEN fully ELSE free_level * weight END AS target
  FROM l LEFT JOIN f ON true),
c AS (
  SELECT doc_id, size, source_size, target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, text_hash, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS begins
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       greatest(least(CAST(round(target) AS BIGINT) - begins, size), 0) + greatest(least(CAST(round(target) AS BIGINT) - begins - source_size, size), 0) AS taken
FROM c
""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
""",
    "op12_prefix_trie": """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 9 AS h
  FROM t),
r AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d, strlen(text) AS bytes, md5(len(role) || ':' || role || text) AS turn FROM r),
p AS (
  SELECT a.conv_id, a.d, any_value(a.bytes) AS bytes, string_agg(b.turn, '' ORDER BY b.d) AS path
  FROM q a JOIN q b ON a.conv_id = b.conv_id AND b.d <= a.d GROUP BY a.conv_id, a.d
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id),
n AS (
  SELECT path, p.d AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saves,
         sha256(coalesce(string_agg(CASE WHEN l.d = p.d THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id), '')) AS ends_sha256
  FROM p JOIN l USING (conv_id) GROUP BY path, p.d),
k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
s AS (
  SELECT a.path, CAST(sum(b.saves) AS BIGINT) AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves
  FROM m a JOIN m b ON b.depth >= a.depth AND left(b.path, 32 * a.depth) = a.path GROUP BY a.path)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, m.ends_sha256
FROM m JOIN s USING (path) LEFT JOIN m u ON u.depth = m.depth - 1 AND u.path = left(m.path, 32 * (m.depth - 1))
""",
}
