"""Relational dimension source and sink over JDBC.

Reads are lazy, so every action re-reads the table: a live link.  Filters on the result are pushed
into the database's WHERE clause by Spark's JDBC source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, url: str, table: str, **properties: str) -> DataFrame:
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties).load()


def write(df: DataFrame, url: str, table: str, mode: str = "append", one_transaction: bool = False, **properties: str) -> None:
    """Append rows, one transaction per partition; with ``one_transaction`` all rows go through one
    partition and commit together (only for small dimension batches)."""
    out = df.coalesce(1) if one_transaction else df
    out.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).mode(mode).save()
