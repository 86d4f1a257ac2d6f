"""Continuous ingestion: message stream → decoded facts → fact table and rollup states.

One ``foreachBatch`` per micro-batch decodes the messages, enforces ``max_bad``, and calls
``Engine.ingest`` with the stream's stable ``source_id`` and the micro-batch id, so a retried batch
replaces exactly its own facts and states (exactly-once end to end).  Late or out-of-order
rows need no watermark: each batch is one more state to merge, and an old row never displaces a
newer last value because states merge by maximum.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollstate.functions.timefn import bucket
from rollstate.operators import aggs, rollups
from rollstate.plans import files
from rollstate.plans.engine import Engine
from rollstate.sources import codec, kafka, store
from rollstate.spec import IntervalAggregator, Table


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """A stream of JSON-lines files as ``value`` strings (the file stand-in for a topic)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stable_source_id(spark: SparkSession, path: str) -> str:
    """An id created once and kept at ``path`` (next to a stream's checkpoint); read back afterwards."""
    schema = "source_id string"
    try:
        row = spark.read.schema(schema).json(path).first()
        if row is not None and row.source_id:
            return row.source_id
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    new = uuid.uuid4().hex
    try:
        spark.createDataFrame([(new,)], schema).coalesce(1).write.mode("errorifexists").json(path)
    except AnalysisException:
        pass  # created concurrently: the stored one wins
    return spark.read.schema(schema).json(path).first().source_id


def ingest_batch_fn(
    engine: Engine,
    table: str,
    source_id: str,
    max_bad: int | None,
    rejects_path: str | None,
    compact_every: int | None = None,
    keep_versions: int = 2,
):
    """The per-micro-batch function: decode, check rejects, store facts and states, and every
    ``compact_every`` batches merge the table's small fact and state parts and vacuum all but the
    newest ``keep_versions``.

    ``source_id`` is created once per stream (and stored beside its checkpoint) because Structured
    Streaming restarts ``batch_id`` at 0 with a fresh checkpoint: the pair, not the batch id alone, is
    the idempotency key.  A retried batch is safe after a compaction too."""
    t = engine.spec.table(table)

    def run(batch: DataFrame, batch_id: int) -> None:
        decoded = codec.decode(batch, t).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            codec.check_rejects(decoded, max_bad)
            engine.ingest(codec.good(decoded, t), table, source_id, batch_id, cache=False)
            if compact_every and (batch_id + 1) % compact_every == 0:
                engine.compact_facts(table)
                for at in engine.spec.rollups_of(table):
                    engine.compact(at.name)
                engine.table(table).vacuum(keep_versions)
            if rejects_path:
                (
                    codec.rejects(decoded)
                    .withColumn(store.SOURCE, F.lit(source_id))
                    .withColumn(store.BATCH, F.lit(int(batch_id)).cast("long"))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(store.SOURCE, store.BATCH)
                    .parquet(rejects_path)
                )
        finally:
            decoded.unpersist()

    return run


def start(
    engine: Engine,
    table: str,
    messages: DataFrame,
    checkpoint: str,
    max_bad: int | None = None,
    rejects_path: str | None = None,
    trigger: dict | None = None,
    source_id: str | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Start continuous ingestion of ``messages`` (a streaming frame with a ``value`` column).

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "5 seconds"}``).  The ``source_id`` defaults to one stored next to the
    checkpoint, created on first start.  ``compact_every`` compacts facts and rollup states every that
    many micro-batches.
    """
    sid = source_id or stable_source_id(engine.spark, checkpoint.rstrip("/") + "_source_id")
    w = (
        messages.select("value")
        .writeStream.foreachBatch(ingest_batch_fn(engine, table, sid, max_bad, rejects_path, compact_every))
        .option("checkpointLocation", checkpoint)
        .queryName(f"ingest_{table}_{sid[:8]}")
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_kafka(
    engine: Engine,
    bootstrap_servers: str,
    checkpoint_root: str,
    max_bad: int | None = None,
    trigger: dict | None = None,
    compact_every: int | None = None,
    **kafka_options: str,
) -> dict[str, StreamingQuery]:
    """One ingest stream per table that names a topic, from the table's own brokers or else
    ``bootstrap_servers``; tables without a topic are batch-only and get no stream.  Each stream keeps its own checkpoint (and source id) below ``checkpoint_root``."""
    queries = {}
    for t in engine.spec.tables:
        if not t.streamed:
            continue
        brokers = t.kafka_bootstrap_host or bootstrap_servers
        messages = kafka.read_stream(engine.spark, brokers, t.kafka_topic, **kafka_options)
        queries[t.name] = start(
            engine,
            t.name,
            messages,
            f"{checkpoint_root.rstrip('/')}/{t.name}",
            max_bad=max_bad,
            rejects_path=f"{engine.root}/rejects/{t.name}",
            trigger=trigger,
            compact_every=compact_every,
        )
    return queries


def windowed_rollup(decoded: DataFrame, table: Table, agg: IntervalAggregator, watermark: str | None = None) -> DataFrame:
    """The native Structured Streaming form of an interval rollup: one group per id and bucket.

    The bucket is the spec's ``group_functions`` chain, so any interval works.  State is kept in
    Spark's streaming state store; with a ``watermark``, buckets that start longer than that before the
    newest one are dropped and later rows for them are ignored (unlike ``start``, which never drops
    late rows), so it should be longer than a bucket.
    Quantiles are KLL sketches here because exact percentiles are not supported as streaming state.
    """
    df = decoded
    of_row = bucket(table.ts, agg.group_functions)
    keys = [F.col(f"`{table.id}`"), of_row.alias(agg.name)]
    if watermark:
        # Watermarks need a zoned TIMESTAMP; the session time zone is pinned to UTC, so the cast from
        # the zone-less column keeps the wall-clock value.  The event time is the bucket's own start,
        # which is the same for all its rows, so it splits no group.
        start = rollups.bucket_start(of_row, agg).cast("timestamp")
        df = df.withColumn("_event_time", start).withWatermark("_event_time", watermark)
        keys.append(F.col("_event_time"))
    exprs = []
    for c in _inputs(table):
        for a in agg.aggregations:
            if c not in aggs.targets([c], table.measures, a):
                continue
            fn = aggs.get(a.type)
            if fn.takes_probs:
                x = F.col(f"`{c}`").cast("double")
                levels = F.array(*[F.lit(p) for p in aggs.probs_of(a)])
                e = F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x, a.k or aggs.DEFAULT_K), levels))
                e = F.get(e, F.lit(0)) if fn.scalar else e
            else:
                e = aggs.one_pass(a, F.col(f"`{c}`"))
            exprs.append(e.alias(f"{c}_{a.slug()}"))
    return df.groupBy(*keys).agg(*exprs).select(f"`{table.id}`", f"`{agg.name}`", *[f"`{n}`" for n in _names(table, agg)])


def start_windowed(
    decoded: DataFrame,
    table: Table,
    agg: IntervalAggregator,
    path: str,
    checkpoint: str,
    watermark: str | None = None,
    trigger: dict | None = None,
    source_id: str | None = None,
    fold_every: int = 16,
) -> StreamingQuery:
    """Run ``windowed_rollup`` in update mode; every micro-batch's updated groups are written to
    ``path`` under the stream's source id and the batch id (a retried batch replaces its own folder).
    ``latest_windows`` reads the result back.  Every ``fold_every`` batches the newest row of each
    group is written as a new base beside ``path`` and older updates are deleted, so what a reader
    opens grows with the groups, not with the batches.  Only one stream's groups may be merged: a
    second stream (another checkpoint) counts its own rows and needs a path of its own."""
    sid = source_id or stable_source_id(decoded.sparkSession, checkpoint.rstrip("/") + "_source_id")
    keys, path = [table.id, agg.name], path.rstrip("/")

    def sink(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn(store.SOURCE, F.lit(sid))
            .withColumn(store.BATCH, F.lit(int(batch_id)).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(store.SOURCE, store.BATCH)
            .parquet(path)
        )
        if (batch_id + 1) % fold_every == 0:
            _fold_windows(batch.sparkSession, path, sid, keys, int(batch_id))

    w = (
        windowed_rollup(decoded, table, agg, watermark)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _bases(spark: SparkSession, path: str, source: str) -> list[int]:
    """Batches up to which the updates of a stream were folded, ascending."""
    mark = f"_done-{source}-"
    return sorted(int(n[len(mark) : -5]) for n in files.names(spark, f"{path}_base") if n.startswith(mark))


def _fold_windows(spark: SparkSession, path: str, source: str, keys: list[str], batch_id: int) -> None:
    """Writes the newest row of every group up to a batch as a base; what the base before it had
    folded, and the bases before that one, are deleted (readers may still hold that one open)."""
    done = _bases(spark, path, source)
    if not done or done[-1] < batch_id:
        newest = _newest(_updates(spark, path, source, batch_id), keys)
        newest.write.mode("overwrite").parquet(f"{path}_base/{source}-{batch_id}")
        files.create_json(spark, f"{path}_base/_done-{source}-{batch_id}.json", {})
    for old in done[:-1]:
        files.delete(spark, f"{path}_base/_done-{source}-{old}.json")
        files.delete(spark, f"{path}_base/{source}-{old}")
    if done:
        folder = f"{path}/{store.SOURCE}={source}"
        for name in files.names(spark, folder):
            if name.startswith(f"{store.BATCH}=") and int(name.split("=")[1]) <= done[-1]:
                files.delete(spark, f"{folder}/{name}")


def _updates(spark: SparkSession, path: str, source: str, up_to: int | None = None) -> DataFrame:
    """The newest base of a stream and its updates after it, with the batch of each row."""
    base = max((b for b in _bases(spark, path, source) if up_to is None or b <= up_to), default=None)
    folder = f"{path}/{store.SOURCE}={source}"
    later = [int(n.split("=")[1]) for n in files.names(spark, folder) if n.startswith(f"{store.BATCH}=")]
    later = [b for b in later if (base is None or b > base) and (up_to is None or b <= up_to)]
    parts = []
    if later:
        parts.append(spark.read.option("basePath", folder).parquet(*[f"{folder}/{store.BATCH}={b}" for b in sorted(later)]))
    if base is not None:
        parts.append(spark.read.parquet(f"{path}_base/{source}-{base}").withColumn(store.BATCH, F.lit(base)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the latest batch for every group (one aggregation)."""
    cols = [c for c in updates.columns if c not in (*keys, store.BATCH)]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), F.col(store.BATCH)).alias("_r")
    return updates.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in cols])


def latest_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest emitted row per group from ``start_windowed``'s output; raises if several streams
    wrote there, whose groups count different rows."""
    sources = [n.split("=", 1)[1] for n in files.names(spark, path) if n.startswith(f"{store.SOURCE}=")]
    if len(sources) != 1:
        raise ValueError(f"{path} holds windows of {'several streams' if sources else 'no stream'} ({', '.join(sources[:3])})")
    return _newest(_updates(spark, path.rstrip("/"), sources[0]), keys)


def _inputs(table: Table) -> list[str]:
    return [*table.measures, table.ts, table.id]


def _names(table: Table, agg: IntervalAggregator) -> list[str]:
    return [f"{c}_{a.slug()}" for c in _inputs(table) for a in agg.aggregations if c in aggs.targets([c], table.measures, a)]
