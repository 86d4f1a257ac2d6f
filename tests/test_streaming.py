"""Structured Streaming ingest: file stream, restart without double counting, rejects, native window."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shared import SF_SMALL, as_set
from rollstate import Engine, catalog
from rollstate.operators import rollups
from rollstate.plans import files
from rollstate.sources import codec
from rollstate.spec import load_spec
from rollstate.streaming import ingest

SPEC = load_spec(catalog.EVENTS_SPEC)


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _expected(spark):
    return as_set(rollups.one_pass(_events(spark), SPEC.rollup("events_day")).collect(), 9)


def _messages(df, path, files):
    codec.encode(df, SPEC.table("events")).select("value").repartition(files).write.mode("overwrite").text(path)


def test_stream_then_restart_counts_once(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    a, b = catalog.split_batches(_events(spark), ["event_id"], 2)
    _messages(a, f"{tmp_root}/inbox/a", 2)
    ck = f"{tmp_root}/ckpt"
    q = ingest.start(e, "events", ingest.file_messages(spark, f"{tmp_root}/inbox/*", 1), ck, max_bad=0, trigger={"availableNow": True})
    q.awaitTermination()
    # restart from the same checkpoint: old files are not read again; new files are
    _messages(b, f"{tmp_root}/inbox/b", 2)
    q = ingest.start(e, "events", ingest.file_messages(spark, f"{tmp_root}/inbox/*", 1), ck, max_bad=0, trigger={"availableNow": True})
    q.awaitTermination()
    assert as_set(e.view("events_day").collect(), 9) == _expected(spark)
    assert e.facts("events").count() == _events(spark).count()
    assert sum(hi - lo + 1 for r in e.table("events").covered("events_day").values() for lo, hi in r) == 4  # one batch per file


def test_replaying_a_micro_batch_is_idempotent(spark, tmp_root):
    """Calling the batch function twice for one epoch (a retried micro-batch) counts once."""
    e = Engine(spark, SPEC, tmp_root)
    msgs = codec.encode(_events(spark), SPEC.table("events"))
    run = ingest.ingest_batch_fn(e, "events", "src", max_bad=0, rejects_path=None)
    run(msgs, 0)
    run(msgs, 0)
    assert as_set(e.view("events_day").collect(), 9) == _expected(spark)


def test_rejects_above_max_bad_fail_the_batch(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    good = codec.encode(_events(spark), SPEC.table("events")).select("value")
    bad = spark.createDataFrame([("garbage",), ("{",)], "value string")
    run = ingest.ingest_batch_fn(e, "events", "src", max_bad=1, rejects_path=f"{tmp_root}/rejects")
    with pytest.raises(codec.TooManyRejects):
        run(good.unionByName(bad), 0)
    assert e.view("events_day").count() == 0  # nothing written for the failed batch
    run = ingest.ingest_batch_fn(e, "events", "src", max_bad=5, rejects_path=f"{tmp_root}/rejects")
    run(good.unionByName(bad), 0)
    assert spark.read.parquet(f"{tmp_root}/rejects").count() == 2
    assert as_set(e.view("events_day").collect(), 9) == _expected(spark)


def test_native_windowed_rollup(spark, tmp_root):
    t = SPEC.table("events")
    agg = SPEC.rollup("events_day").aggregator
    _messages(_events(spark), f"{tmp_root}/inbox", 2)
    decoded = codec.good(codec.decode(ingest.file_messages(spark, f"{tmp_root}/inbox", 1), t), t)
    out = ingest.windowed_rollup(decoded, t, agg, watermark="1000 days")
    q = out.writeStream.outputMode("update").format("memory").queryName("native_day").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.sql("SELECT * FROM native_day")
    # update mode may emit a group more than once; the latest row per group is complete
    latest = got.groupBy("user_id", "day").agg(F.max("value_count").alias("n"))
    want = _events(spark).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("value").alias("n"))
    assert as_set(latest.collect()) == as_set(want.collect())


def test_failure_after_writes_then_restart_counts_once(spark, tmp_root):
    """A micro-batch fails after writing facts and states; the restarted query replays it in place."""
    e = Engine(spark, SPEC, tmp_root)
    _messages(_events(spark), f"{tmp_root}/inbox", 3)
    ck = f"{tmp_root}/ckpt"
    sid = "stream-a"
    run = ingest.ingest_batch_fn(e, "events", sid, max_bad=0, rejects_path=None)
    failed = []

    def flaky(batch, batch_id):
        run(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("injected failure after writes")

    def start():
        return (
            ingest.file_messages(spark, f"{tmp_root}/inbox", 1)
            .writeStream.foreachBatch(flaky)
            .option("checkpointLocation", ck)
            .trigger(availableNow=True)
            .start()
        )

    q = start()
    with pytest.raises(Exception):
        q.awaitTermination()
    assert failed == [1]
    start().awaitTermination()
    assert as_set(e.view("events_day").collect(), 9) == _expected(spark)
    assert e.facts("events").count() == _events(spark).count()


def test_stream_with_periodic_compaction(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    _messages(_events(spark), f"{tmp_root}/inbox", 5)
    q = ingest.start(
        e, "events", ingest.file_messages(spark, f"{tmp_root}/inbox", 1), f"{tmp_root}/ckpt",
        max_bad=0, trigger={"availableNow": True}, compact_every=2,
    )
    q.awaitTermination()
    t = e.table("events")
    assert t.versions("events_day") == t.versions("facts") == 2 and list(t.covered("events_day").values()) == [[[0, 4]]]
    assert len(t.parts("facts").parts_on_disk()) == 5  # of 7: the first compaction's inputs are gone
    assert as_set(e.view("events_day").collect(), 9) == _expected(spark)
    last = e.view("events_last").collect()
    assert as_set(last) == as_set(rollups.one_pass(_events(spark), SPEC.rollup("events_last")).collect())


def test_batch_only_tables_get_no_stream(spark, tmp_root):
    spec = {"tables": [catalog.LINEITEM_TABLE], "analytical_tables": []}  # kafka_topic: null
    e = Engine(spark, spec, tmp_root)
    assert ingest.start_kafka(e, "broker:9092", f"{tmp_root}/ckpt") == {}


def test_hourly_native_windows_and_time_counts(spark, tmp_root):
    """Buckets follow the spec, a count of the time column is kept, and streams do not overwrite each other."""
    hourly = {"type": "interval", "name": "hour", "group_functions": ["toStartOfHour"]}
    aggregations = [{"type": "sum"}, {"type": "count", "columns": ["ts"]}]
    spec = load_spec({"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": {**hourly, "aggregations": aggregations}}]})
    t, agg = spec.table("events"), spec.rollup("events_hour").aggregator
    _messages(_events(spark), f"{tmp_root}/inbox", 2)
    decoded = codec.good(codec.decode(ingest.file_messages(spark, f"{tmp_root}/inbox", 1), t), t)
    ingest.start_windowed(decoded, t, agg, f"{tmp_root}/out", f"{tmp_root}/ckpt", trigger={"availableNow": True}).awaitTermination()
    got = ingest.latest_windows(spark, f"{tmp_root}/out", ["user_id", "hour"]).select("user_id", "hour", "ts_count", "value_sum").collect()
    want = _events(spark).groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    want = want.agg(F.count("ts").alias("n"), F.sum("value").alias("v")).collect()
    assert as_set(got) == as_set(want)
    ingest.start_windowed(decoded, t, agg, f"{tmp_root}/out", f"{tmp_root}/ckpt2", trigger={"availableNow": True}).awaitTermination()
    with pytest.raises(ValueError, match="several streams"):
        ingest.latest_windows(spark, f"{tmp_root}/out", ["user_id", "hour"])


def test_folded_windows_keep_the_newest_rows_and_few_files(spark, tmp_root):
    t, agg = SPEC.table("events"), SPEC.rollup("events_day").aggregator
    _messages(_events(spark), f"{tmp_root}/inbox", 7)
    decoded = codec.good(codec.decode(ingest.file_messages(spark, f"{tmp_root}/inbox", 1), t), t)
    ingest.start_windowed(decoded, t, agg, f"{tmp_root}/out", f"{tmp_root}/ckpt", trigger={"availableNow": True}, fold_every=2).awaitTermination()
    got = ingest.latest_windows(spark, f"{tmp_root}/out", ["user_id", "day"])
    want = _events(spark).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("value"), F.avg("value"), F.stddev_samp("value")).collect()
    assert as_set(got.select("user_id", "day", "value_count", "value_avg", "value_stddevSamp").collect()) == as_set(want)
    source = [n for n in files.names(spark, f"{tmp_root}/out") if n.startswith("source_id=")][0]
    kept = [n for n in files.names(spark, f"{tmp_root}/out/{source}") if n.startswith("batch_id=")]
    assert kept == ["batch_id=4", "batch_id=5", "batch_id=6"]  # after the last base but one
    assert len([n for n in files.names(spark, f"{tmp_root}/out_base") if n.startswith("_done")]) == 2
    with pytest.raises(ValueError, match="no stream"):
        ingest.latest_windows(spark, f"{tmp_root}/elsewhere", ["user_id", "day"])


def test_native_windows_of_months_are_not_split_by_day(spark, tmp_root):
    monthly = {"type": "interval", "name": "month", "group_functions": ["toYYYYMM"], "aggregations": [{"type": "count"}]}
    spec = load_spec({"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": monthly}]})
    t, agg = spec.table("events"), spec.rollup("events_month").aggregator
    _messages(_events(spark), f"{tmp_root}/inbox", 2)
    decoded = codec.good(codec.decode(ingest.file_messages(spark, f"{tmp_root}/inbox", 1), t), t)
    ingest.start_windowed(decoded, t, agg, f"{tmp_root}/out", f"{tmp_root}/ckpt", watermark="400 days", trigger={"availableNow": True}).awaitTermination()
    got = ingest.latest_windows(spark, f"{tmp_root}/out", ["user_id", "month"]).collect()
    want = _events(spark).groupBy("user_id", (F.year("ts") * 100 + F.month("ts")).alias("m")).agg(F.count("value")).collect()
    assert as_set(got) == as_set(want)
