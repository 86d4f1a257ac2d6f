"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, hamming, html_text, line_dedup, lm, ngram_join, packing, quality, secrets_scan, spelling, spotsigs, token_counts, whitening
from .common import held_out, read

TOKEN_LIMIT = 1024
TOP_K = 10


def op1_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every document's whole text, decodes the ids, and digests both."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprint of every document and of its edited text, and how alike they are."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return spotsigs.edited_likeness(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("sigs")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        spotsigs.length_band(F.col("sigs")).alias("length_band"),
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate on its site (its source), by the one share of its SQL."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return line_dedup.drop_lines(docs, ratio=line_dedup.RATIO, min_pages=line_dedup.MIN_PAGES)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates and number of links of every document."""
    return ngram_join.similarity_classes(read(spark, sf_dir, "documents", "doc_id", "text"))


QUALITY_THRESHOLD = 0.7


def quality_machine(docs: DataFrame, labels: DataFrame) -> quality.Machine:
    """Fitted on labelled documents that are not held out."""
    return quality.fit(docs, labels, ~held_out(F.col("doc_id"), 4, 2))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    machine = quality_machine(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = quality.score(docs, machine, QUALITY_THRESHOLD)
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every document."""
    return lm.score_texts(read(spark, sf_dir, "documents", "doc_id", "text"), held_out(F.col("doc_id"), 5, 1))


def word_count(text: str = "text") -> Column:
    """Words between white space, and one for the end of the text: the length that packing uses here."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")) + 1


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length bucket and batch of every document, in words."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", word_count().alias("words"))
    return packing.pack(docs, "doc_id", F.col("words"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows by Hamming distance of sign codes, for every row whose id 100 divides."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return hamming.search(vectors, F.col("vec_id") % 100 == 0, TOP_K)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document's whole text, and the longest prefix within the limit."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    counted = token_counts.count_tokens(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, TOKEN_LIMIT
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: by patterns, and by the battery of randomness tests."""
    scanned = secrets_scan.scan(read(spark, sf_dir, "documents", "doc_id", "text"))

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets_scan.KINDS]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(secrets_scan.listing(of(*secrets_scan.PATTERNS)), 256).alias("base_sha256"),
        secrets_scan.listing(F.col("found")).alias("spans"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form, its root and the number of words one edit away."""
    found = spelling.spelling_variants(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening.whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=16)


QUERIES = {
    "op1_byte_level_bpe": op1_byte_level_bpe,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_html_extraction": op3_html_extraction,
    "op4_line_dedup": op4_line_dedup,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_packing": op8_packing,
    "op9_exact_topk": op9_exact_topk,
    "op10_token_counts": op10_token_counts,
    "op11_secret_scans": op11_secret_scans,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

#: DuckDB equivalents, where SQL can express the operator.
_TRIM = "trim({}, ' ' || chr(9) || chr(13))"
ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": f"""
WITH pages AS (SELECT DISTINCT source, coalesce(text, '') AS text FROM documents WHERE source IS NOT NULL),
totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
lines AS (
  SELECT DISTINCT source, text, {_TRIM.format("line")} AS line
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
common AS (
  SELECT source, line FROM lines JOIN totals USING (source) WHERE line <> ''
  GROUP BY source, line, pages HAVING count(*) >= {line_dedup.MIN_PAGES} AND count(*) > {line_dedup.RATIO} * pages),
split AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
marked AS (
  SELECT s.doc_id, s.line, s.i, c.line IS NOT NULL AS gone
  FROM split s LEFT JOIN common c ON c.source = s.source AND c.line = {_TRIM.format("s.line")}),
cleaned AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS text, count(*) FILTER (WHERE gone) AS n_dropped
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text,
  CAST(coalesce(c.n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN cleaned c USING (doc_id)
""",
    "op9_exact_topk": f"""
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings WHERE vec_id IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: abs(z[1] - z[2]))) AS INTEGER) AS distance
  FROM (SELECT * FROM codes WHERE vec_id % 100 = 0) q, codes r),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {TOP_K}
""",
}
