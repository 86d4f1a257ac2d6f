"""Corpus pipeline: stages from raw documents to packed training batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollstate import session
from rollstate.llm import pipeline_stages as stages

#: (name, function); each function takes (spark, docs, sf_dir) and returns the next one's docs.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", stages.keep_quality),
    ("line_dedup", stages.drop_boilerplate),
    ("near_duplicates", stages.keep_one_of_each_group),
    ("packing", stages.pack_batches),
]

#: A classifier and a similarity join have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = session.scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
