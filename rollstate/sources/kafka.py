"""Kafka topic source and keyed JSON sink (Structured Streaming and batch).

These are option-to-reader adapters only; everything behind them (decode, rejects, ingest) is
source-agnostic and tested with file streams.  They need the ``spark-sql-kafka`` connector on the
classpath.  Consumer-group offsets of the reference map to the streaming query's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollstate.sources.codec import encode
from rollstate.spec import Table


def read_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A streaming DataFrame of ``key, value, …`` records; one task per topic partition."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def write(df: DataFrame, table: Table, bootstrap_servers: str, topic: str) -> None:
    """Batch-publish rows as keyed JSON messages (key = id as text)."""
    (
        encode(df, table)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def write_stream(df: DataFrame, table: Table, bootstrap_servers: str, topic: str, checkpoint: str):
    """Continuously publish a streaming DataFrame as keyed JSON messages."""
    return (
        encode(df, table)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
