"""The stages of the corpus pipeline; each calls one operator and works on what its predecessor kept.

All but the last keep the columns of ``documents`` (doc_id, text, lang, source, n_chars).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, ngram_join, packing, quality
from .common import read
from .queries import QUALITY_THRESHOLD, quality_machine, word_count


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; all of them if it has no labels of both kinds to learn from."""
    machine = quality_machine(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    if not machine.fitted:
        return docs
    scored = quality.score(docs, machine, QUALITY_THRESHOLD, keep_text=True)
    return scored.filter("predicted = 1").select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_lines(docs)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (that of the least id, none last) of each class of near duplicates; rows alike in
    id and text stay once.  Rows that share an id but not a text are documents of their own."""
    later = ngram_join.later_members(docs)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & F.md5("text").eqNullSafe(F.col("_row"))
    return docs.join(later, same, "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket and batch of every document."""
    return packing.pack(docs.select("doc_id", word_count().alias("words")), "doc_id", F.col("words"))
