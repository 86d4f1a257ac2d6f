"""Persisted states: exactly-once batch writes, compaction, backfill, distinct sources."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shared import SF_SMALL, as_set
from rollstate import Engine, catalog
from rollstate.operators import rollups
from rollstate.plans import commit_log as log
from rollstate.plans import part_store
from rollstate.plans.part_store import tier
from rollstate.plans.table_store import FACTS, ReplayError
from rollstate.spec import load_spec
from rollstate.streaming.ingest import stable_source_id

SPEC = load_spec(catalog.EVENTS_SPEC)


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _one_pass(spark):
    return rollups.one_pass(_events(spark), SPEC.rollup("events_day")).collect()


def _state(e, table="events"):
    return e.table(table).log.read()[1]


def test_replayed_batch_counts_once(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 3)
    for i, p in enumerate(parts):
        e.ingest(p, "events", "src", i)
    e.ingest(parts[1], "events", "src", 1)  # retry of batch 1
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)
    assert e.facts("events").count() == _events(spark).count()


def test_fresh_source_does_not_overwrite_old_batches(spark, tmp_root):
    """A second stream restarts batch ids at 0; its source id keeps both."""
    e = Engine(spark, SPEC, tmp_root)
    a, b = catalog.split_batches(_events(spark), ["event_id"], 2)
    e.ingest(a, "events", "stream-1", 0)
    e.ingest(b, "events", "stream-2", 0)
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_compaction_keeps_results_and_later_batches(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 5)
    for i, p in enumerate(parts[:3]):
        e.ingest(p, "events", "s", i)
    before = as_set(e.view("events_day").collect(), 9)
    assert e.compact("events_day") == 1
    assert as_set(e.view("events_day").collect(), 9) == before
    t = e.table("events")
    assert t.covered("events_day") == {"s": [[0, 2]]} and log.relation(_state(e), "events_day")["own"] == {"s": {}}
    # a replay of an already compacted batch must not count twice
    e.ingest(parts[0], "events", "s", 0)
    assert as_set(e.view("events_day").collect(), 9) == before
    e.ingest(parts[3], "events", "s", 3)
    e.ingest(parts[4], "events", "other", 0)
    assert e.compact("events_day", full=True) == 2
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)
    assert t.covered("events_day") == {"s": [[0, 3]], "other": [[0, 0]]}
    # compacted states hold one row per key
    assert t.states("events_day").count() == t.states("events_day").select("user_id", "day").distinct().count()
    # nothing new: compaction is a no-op
    assert e.compact("events_day", full=True) == 2


def test_backfill_covers_facts_stored_before_rollup(spark, tmp_root):
    early, late = catalog.time_cuts(_events(spark), "ts", 2)
    Engine(spark, {"tables": [catalog.EVENTS_TABLE]}, tmp_root).ingest(early, "events", "history", 0)
    e = Engine(spark, SPEC, tmp_root)
    assert len(e.backfill("events_day")) == 4
    assert e.backfill("events_day") == []  # nothing left to cover
    e.ingest(late, "events", "live", 0)
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)
    assert e.table("events").covered("events_day") == {"history": [[0, 0]], "live": [[0, 0]]}


def test_setup_registers_views(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    e.ingest(_events(spark), "events", "s", 0)
    names = e.setup()
    assert names == ["events", "events_last", "events_day"]
    n = spark.sql("SELECT count(*) FROM events_last").first()[0]
    assert n == _events(spark).select("user_id").distinct().count()
    e.setup()  # create-or-replace: idempotent


def test_empty_rollup_view_has_schema(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    v = e.view("events_day")
    assert v.count() == 0
    assert v.columns == ["user_id", "day", "value_count", "value_avg", "value_quantiles_01_05_09", "value_stddevSamp"]


def test_stable_source_id(spark, tmp_root):
    a = stable_source_id(spark, f"{tmp_root}/ckpt_source_id")
    b = stable_source_id(spark, f"{tmp_root}/ckpt_source_id")
    c = stable_source_id(spark, f"{tmp_root}/other_source_id")
    assert a == b and a != c


def test_time_range_prunes_months(spark, tmp_root):
    from rollstate.sources import store

    spec = load_spec(catalog.LINEITEM_SPEC)
    t = spec.table("lineitem")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    e = Engine(spark, {"tables": [catalog.LINEITEM_TABLE]}, tmp_root)
    e.ingest(li, "lineitem", "load", 0)
    facts = e.facts("lineitem")
    r = store.time_range(facts, t, "1996-03-15 00:00:00", "1996-07-01 00:00:00")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = r._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "yyyymm" in partition_filters and ">= 199603" in partition_filters and "<= 199606" in partition_filters
    assert "GreaterThanOrEqual(l_shipdate" in plan.split("PushedFilters: [")[1]
    want = li.where((F.col("l_shipdate") >= "1996-03-15") & (F.col("l_shipdate") < "1996-07-01")).count()
    assert r.count() == want
    # id filter reaches the scan
    idp = store.for_id(facts, t, 5)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,5)" in idp


def test_literal_rows_and_enriched_view(spark, tmp_root):
    import datetime as dt

    from rollstate.sources import store

    t = SPEC.table("events")
    rows = store.literal_rows(spark, t, [(1, dt.datetime(2024, 1, 1, 5), 2.5), (2, dt.datetime(2024, 1, 1, 6), 3.5)])
    assert rows.schema == t.schema
    e = Engine(spark, SPEC, tmp_root)
    e.ingest(rows, "events", "lit", 0)
    dim = spark.createDataFrame([(1, "Tønsberg", 59.27, 10.41)], "id long, label string, lat double, lon double")
    got = e.enriched_view("events_last", dim, "id").collect()
    assert [(r.user_id, r.value, r.label) for r in got] == [(1, 2.5, "Tønsberg")]


def test_vacuum_keeps_results_and_drops_merged_files(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 6)
    for i, p in enumerate(parts):
        e.ingest(p, "events", "s", i, write_facts=False)
        if i % 2 == 1:
            e.compact("events_day", full=True)
    t = e.table("events")
    assert t.versions("events_day") == 3
    before = as_set(e.view("events_day").collect(), 9)
    on_disk = len(t.parts("events_day").parts_on_disk())
    assert t.vacuum(keep_versions=2)["parts"] == 5  # batches 0-3 and the first compaction's part
    assert len(t.parts("events_day").parts_on_disk()) == on_disk - 5
    assert as_set(e.view("events_day").collect(), 9) == before == as_set(_one_pass(spark), 9)
    assert t.vacuum(keep_versions=2) == {"parts": 0, "orphans": 0}
    assert t.vacuum(keep_versions=1)["parts"] == 3
    assert len(t.parts("events_day").parts_on_disk()) == 1 and as_set(e.view("events_day").collect(), 9) == before


def test_vacuum_deletes_what_failed_writers_left(spark, tmp_root):
    e = Engine(spark, catalog.EVENTS_DAY_SPEC, tmp_root)
    e.ingest(_events(spark), "events", "s", 0)
    t = e.table("events")
    t.parts("events_day").write(rollups.with_month(t.states("events_day"), t.rollups["events_day"]), "abandoned")
    assert t.vacuum() == {"parts": 0, "orphans": 0}  # young: its writer may still be at work
    assert t.vacuum(orphan_hours=-1) == {"parts": 0, "orphans": 1}
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_ingest_dedup_is_opt_in(spark, tmp_root):
    ev = _events(spark)
    doubled = ev.unionByName(ev)
    e = Engine(spark, catalog.EVENTS_DAY_SPEC, tmp_root)
    e.ingest(doubled, "events", "twice", 0, dedup=True)
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)
    e2 = Engine(spark, catalog.EVENTS_DAY_SPEC, f"{tmp_root}/raw")
    e2.ingest(doubled, "events", "twice", 0)
    assert e2.view("events_day").agg(F.sum("value_count")).first()[0] == 2 * ev.count()


def test_replay_of_merged_batches(spark, tmp_root):
    """After compactions a replay with fewer rows, or none, is seen by facts and rollups alike."""
    e = Engine(spark, SPEC, tmp_root)
    ev = _events(spark)
    parts = [ev.where(F.col("event_id") % 3 == i) for i in range(3)]
    for i, p in enumerate(parts):
        e.ingest(p, "events", "s", i)

    def same_as(rows):
        cols = ["user_id", "ts", "value"]
        assert as_set(e.facts("events").select(*cols).collect()) == as_set(rows.select(*cols).collect())
        for name in ("events_day", "events_last"):
            assert as_set(e.view(name).collect(), 9) == as_set(rollups.one_pass(rows, SPEC.rollup(name)).collect(), 9), name

    e.compact("events_day", keep_versions=1)
    half = ev.where(F.col("event_id") % 6 == 0)
    e.ingest(half, "events", "s", 0)  # states merged, facts not yet
    same_as(half.unionByName(parts[1]).unionByName(parts[2]))
    e.compact_facts("events", keep_versions=1, full=True)
    e.compact("events_last")
    e.ingest(parts[1].limit(0), "events", "s", 1)  # all merged
    same_as(half.unionByName(parts[2]))
    assert len(_state(e)["dropped"]) == 1
    e.ingest(parts[1], "events", "s", 1)  # and back again
    e.ingest(parts[0], "events", "s", 0)
    same_as(ev)
    e.compact_facts("events", keep_versions=1, full=True)
    assert _state(e)["dropped"] == []
    same_as(ev)
    for i in range(3):
        e.ingest(ev.limit(0), "events", "s", i)
    assert e.facts("events").count() == 0 and e.view("events_day").count() == 0 and e.view("events_last").count() == 0


def test_replay_of_a_merged_batch_needs_its_facts(spark, tmp_root):
    e = Engine(spark, catalog.EVENTS_DAY_SPEC, tmp_root)
    a, b = catalog.split_batches(_events(spark), ["event_id"], 2)
    e.ingest(a, "events", "s", 0, write_facts=False)
    e.ingest(b, "events", "s", 1, write_facts=False)
    e.ingest(b.limit(0), "events", "s", 1, write_facts=False)  # not merged yet: replaced
    e.ingest(b, "events", "s", 1, write_facts=False)
    e.compact("events_day", keep_versions=1)
    with pytest.raises(ReplayError):
        e.ingest(a, "events", "s", 1, write_facts=False)
    with pytest.raises(ReplayError):
        e.ingest(a, "events", "s", 1)
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_replay_when_a_rollup_lacks_columns(spark, tmp_root):
    """The months of a replayed batch are aggregated from all facts, also for columns not yet filled."""
    ev = _events(spark)
    parts = catalog.split_batches(ev, ["event_id"], 3)
    day = {**catalog.DAY, "aggregations": catalog.FULL_AGGS[:1]}
    old = Engine(spark, {"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": day}]}, tmp_root)
    for i, p in enumerate(parts[:2]):
        old.ingest(p, "events", "s", i)
    old.compact("events_day")
    e = Engine(spark, catalog.EVENTS_DAY_SPEC, tmp_root)
    e.ingest(parts[2], "events", "s", 2)
    e.ingest(parts[0], "events", "s", 0)
    assert e.backfill("events_day") == []
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_new_columns_leave_old_state_files_alone(spark, tmp_root):
    parts = catalog.split_batches(_events(spark), ["event_id"], 2)
    day = {**catalog.DAY, "aggregations": catalog.FULL_AGGS[:2]}
    old = Engine(spark, {"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": day}]}, tmp_root)
    old.ingest(parts[0], "events", "s", 0)
    before = set(log.relation(_state(old), "events_day")["parts"])
    e = Engine(spark, catalog.EVENTS_DAY_SPEC, tmp_root)
    e.ingest(parts[1], "events", "s", 1)
    assert e.backfill("events_day") == ["value_quantiles_01_05_09_state", "value_stddevSamp_state"]
    assert before < set(log.relation(_state(e), "events_day")["parts"])
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_fact_compaction_rounds(spark, tmp_root):
    from rollstate.sources import store

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    spec = load_spec(catalog.LINEITEM_SPEC)
    t = spec.table("lineitem")
    e = Engine(spark, {"tables": [catalog.LINEITEM_TABLE]}, tmp_root)
    parts = catalog.split_batches(li, ["l_orderkey", "l_linenumber", "l_partkey"], 5)
    for i, p in enumerate(parts[:3]):
        e.ingest(p, "lineitem", "s", i)
    cols = [c.name for c in t.all_columns]
    first = parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*cols)
    assert e.compact_facts("lineitem", full=True) == 1
    assert as_set(e.facts("lineitem").select(*cols).collect()) == as_set(first.collect())
    e.table("lineitem").vacuum()
    assert len(e.table("lineitem").parts(FACTS).parts_on_disk()) == 1
    e.ingest(parts[0], "lineitem", "s", 0)  # replay of a merged batch
    e.ingest(parts[3], "lineitem", "s", 3)
    e.ingest(parts[4], "lineitem", "t", 0)
    assert e.compact_facts("lineitem", full=True) == 2
    assert as_set(e.facts("lineitem").select(*cols).collect()) == as_set(li.select(*cols).collect())
    r = store.time_range(e.facts("lineitem"), t, "1996-03-15 00:00:00", "1996-07-01 00:00:00")
    assert r.count() == li.where((F.col("l_shipdate") >= "1996-03-15") & (F.col("l_shipdate") < "1996-07-01")).count()
    # backfill after fact compaction still knows each row's batch
    e2 = Engine(spark, spec, tmp_root)
    e2.backfill("lineitem_month")
    assert e2.table("lineitem").covered("lineitem_month") == {"s": [[0, 3]], "t": [[0, 0]]}
    v = e2.view("lineitem_month").select("l_suppkey", "month", "l_quantity_count").collect()
    direct = rollups.one_pass(li, spec.rollup("lineitem_month")).select("l_suppkey", "month", "l_quantity_count").collect()
    assert as_set(v) == as_set(direct)


def _files(df):
    return {f.rsplit("/", 1)[1] for f in df.inputFiles()}


def test_compacted_files_are_sorted_and_left_out_by_id(spark, tmp_root):
    """The writer's own ordering by partition must not undo the (id, time) sort in files; files of a
    compacted part hold disjoint id ranges, so one id opens a fraction of them."""
    import pyarrow.parquet as pq

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_shipdate < '1996-01-01'")
    e = Engine(spark, {"tables": [catalog.LINEITEM_TABLE]}, tmp_root)
    for i, p in enumerate(catalog.split_batches(li, ["l_orderkey", "l_linenumber"], 2)):
        e.ingest(p, "lineitem", "s", i)
    e.compact_facts("lineitem", target_bytes=400)
    every, one = e.facts("lineitem"), e.facts("lineitem", ids=[3])
    assert len(_files(one)) < len(_files(every)) / 2
    assert one.count() == li.where("l_suppkey = 3").count() > 0 and every.count() == li.count()
    for f in list(every.inputFiles())[:30]:
        tab = pq.read_table(f.replace("file://", ""), columns=["l_suppkey", "l_shipdate"]).to_pandas()
        keys = list(zip(tab.l_suppkey, tab.l_shipdate))
        assert keys == sorted(keys), f
    ranged = e.facts("lineitem", ids=[3], lo="1995-03-01", hi="1995-05-01")
    assert {f.split("yyyymm=")[1][:6] for f in ranged.inputFiles()} <= {"199503", "199504"}


def test_compaction_is_cut_by_bytes_in_memory(spark, tmp_root, monkeypatch):
    """Files that compress well are merged by as many tasks as their rows need in memory."""
    from rollstate.plans import part_store

    monkeypatch.setattr(part_store, "TASK_BYTES", 100_000, raising=False)
    rows = spark.range(8000).select(
        (F.col("id") % 50).alias("l_suppkey"), F.lit("1996-03-01").cast("timestamp_ntz").alias("l_shipdate"),
        *[F.lit(1.0).alias(c) for c in catalog.LINEITEM_MEASURES],
    )
    e = Engine(spark, catalog.LINEITEM_DAY_SPEC, tmp_root)
    for i, p in enumerate(catalog.split_batches(rows.withColumn("l_quantity", F.monotonically_increasing_id() % 7), ["l_suppkey", "l_quantity"], 2)):
        e.ingest(p, "lineitem", "s", i)
    e.compact_facts("lineitem", full=True)
    e.compact("lineitem_day", full=True)
    facts, states = e.facts("lineitem"), e.table("lineitem").states("lineitem_day")
    assert len(facts.inputFiles()) >= 4 and len(states.inputFiles()) >= 4
    assert facts.count() == 8000 and states.count() == 50
    assert e.facts("lineitem", ids=[3]).count() == 160
    assert e.view("lineitem_day").agg(F.sum("l_tax_count")).first()[0] == 8000


@pytest.mark.parametrize(
    ("kind", "value", "size"),
    [("bigint", "null", 8), ("string", "'abc'", 11), ("string", "null", 8), ("struct<v:array<double>,s:binary>", "named_struct('v', array(1, 2), 's', null)", 56), ("struct<n:bigint>", "null", 8)],
)
def test_memory_bytes(spark, kind, value, size):
    from rollstate.plans.part_store import memory_bytes

    df = spark.sql(f"SELECT CAST({value} AS {kind}) AS x")
    assert df.select(memory_bytes(F.col("x"), df.schema["x"].dataType)).first()[0] == size


def test_text_ids(spark, tmp_root):
    table = {**catalog.LINEITEM_TABLE, "id_column": catalog._col("l_returnflag", "Nullable(String)")}
    spec = {"tables": [table], "analytical_tables": [{"table": "lineitem", "aggregator": {**catalog.DAY, "aggregations": [{"type": "count"}]}}]}
    e = Engine(spark, spec, tmp_root)
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_shipdate < '1995-07-01'")
    li = li.withColumn("l_returnflag", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")))
    for i, p in enumerate(catalog.split_batches(li, ["l_orderkey", "l_linenumber"], 2)):
        e.ingest(p, "lineitem", "s", i)
    e.compact_facts("lineitem", full=True)
    e.compact("lineitem_day", full=True)
    for ids, cond in ((["R"], "l_returnflag = 'R'"), ([None], "l_returnflag IS NULL"), (["R", None, "x"], "l_returnflag = 'R' OR l_returnflag IS NULL")):
        n = li.where(cond).count()
        assert e.facts("lineitem", ids=ids).count() == n > 0
        assert e.view("lineitem_day", ids=ids).agg(F.sum("l_quantity_count")).first()[0] == n


def test_view_range_prunes_months_and_ids(spark, tmp_root):
    import datetime as dt

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    e = Engine(spark, catalog.LINEITEM_DAY_SPEC, tmp_root)
    for i, p in enumerate(catalog.split_batches(li, ["l_orderkey", "l_linenumber"], 2)):
        e.ingest(p, "lineitem", "s", i, write_facts=False)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    v = e.view("lineitem_day", lo=dt.date(1996, 3, 15), hi="1996-07-01 00:00:00")
    plan = v._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert ">= 199603" in filters and "<= 199606" in filters
    assert {f.split("yyyymm=")[1][:6] for f in v.inputFiles()} == {"199603", "199604", "199605", "199606"}
    assert "Window" not in plan
    days = [r.day for r in v.select("day").distinct().collect()]
    assert min(days) >= dt.date(1996, 3, 15) and max(days) < dt.date(1996, 7, 1)
    one = e.view("lineitem_day", ids=[3])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,3)" in one or "In(l_suppkey" in one
    with pytest.raises(ValueError, match="no time bucket"):
        Engine(spark, SPEC, tmp_root).view("events_last", lo="1996-01-01")


def test_compaction_leaves_other_months_alone(spark, tmp_root):
    import datetime as dt

    e = Engine(spark, catalog.EVENTS_DAY_SPEC, tmp_root)
    schema = e.spec.table("events").schema
    rows = [(i % 7, dt.datetime(2024, 1 + i % 4, 1 + i % 20, 3), float(i)) for i in range(400)]
    e.ingest(spark.createDataFrame(rows[:200], schema), "events", "s", 0)
    e.ingest(spark.createDataFrame(rows[200:], schema), "events", "s", 1)
    e.compact("events_day", full=True)
    e.compact_facts("events", full=True)
    t = e.table("events")
    before = {n: t.months(n) for n in (FACTS, "events_day")}
    late = [(i % 7, dt.datetime(2024, 3, 30, i % 24), float(i)) for i in range(300)]
    e.ingest(spark.createDataFrame(late, schema), "events", "s", 2)
    e.compact("events_day")
    e.compact_facts("events")
    for n in (FACTS, "events_day"):
        now = t.months(n)
        assert {m for m in before[n] if now[m] == before[n][m]} == {"202401", "202402", "202404"} and len(now["202403"]) == 1
    want = rollups.one_pass(spark.createDataFrame(rows + late, schema), t.rollups["events_day"])
    assert as_set(e.view("events_day").collect(), 9) == as_set(want.collect(), 9)


def test_tiers_merge_small_parts_first():
    assert tier({"a": 100}, 4) == []
    assert tier({"big": 1000, "a": 1, "b": 2}, 4) == ["a", "b"]
    assert tier({"big": 10, "a": 1, "b": 2}, 4) == ["a", "b", "big"]
    assert tier({"a": 1, "b": 100}, 4) == []
    # every row is rewritten about as often as its month doubles
    sizes, written = {}, 0
    for i in range(500):
        sizes[f"p{i}"] = 1
        chosen = tier(sizes, 1.0)
        if chosen:
            total = sum(sizes.pop(p) for p in chosen)
            sizes[f"m{i}"] = total
            written += total
    assert written < 500 * 12 and len(sizes) < 12


def test_commit_log_commits_a_version_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "CHECKPOINT", 4)
    a, b = (log.CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert a.read() == (0, log.empty_state())

    def added(i):
        months = {"202401": 10, "202402": 20}
        return [{"do": "add", "in": "r", "part": f"p{i}", "months": months, "batches": {"s": [[i, i]]}}, {"do": "cover", "in": "r", "columns": ["c"], "batches": {"s": [[i, i]]}}]

    assert a.commit(0, added(0)) and not b.commit(0, added(1))  # another writer was first
    for i in range(1, 11):
        assert b.commit(i, added(i))
    assert a.commit(11, [{"do": "remove", "in": "r", "part": "p0", "months": ["202401"]}, {"do": "fold", "in": "r"}])
    version, state = log.CommitLog(spark, str(tmp_path / "log")).read()
    assert version == 12 and (version, state) == a.read() == b.read()
    assert log.covered(state, "r", ["c"]) == {"s": [[0, 10]]} and log.covered(state, "r", ["c", "d"]) == {}
    assert state["relations"]["r"]["parts"]["p0"]["months"] == {"202402": 20} and state["dead"] == [[12, "r", "p0", ["202401"]]]
    assert a.trim() > 0 and log.CommitLog(spark, str(tmp_path / "log")).read() == (version, state)
    assert b.commit(12, added(11)) and a.read()[0] == 13
    assert not [p.name for p in (tmp_path / "log").iterdir() if "draft" in p.name]


def test_batch_ranges():
    f = log.add_batches({}, "s", [5, 3, 4, 9])
    assert f == {"s": [[3, 5], [9, 9]]}
    f = log.add_batches(log.add_batches(f, "s", [6, 8]), "t", [0])
    assert f == {"s": [[3, 6], [8, 9]], "t": [[0, 0]]}
    assert log.add_batches(f, "s", [7])["s"] == [[3, 9]]
    assert log.has(f, "s", 6) and not log.has(f, "s", 7) and not log.has(f, "u", 0)
    assert log.minus(f, {"s": [[4, 4], [9, 12]]}) == {"s": [[3, 3], [5, 6], [8, 8]], "t": [[0, 0]]}
    assert log.minus(f, f) == {} and log.minus(f, {}) == f and log.minus({}, f) == {}
    assert log.union(f, {"s": [[7, 7]], "u": [[1, 2]]}) == {"s": [[3, 9]], "t": [[0, 0]], "u": [[1, 2]]}


def test_late_batch_after_compaction_is_not_lost(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 3)
    e.ingest(parts[1], "events", "s", 1)
    e.compact("events_day", keep_versions=1)
    e.compact_facts("events", keep_versions=1)
    e.ingest(parts[0], "events", "s", 0)
    e.ingest(parts[2], "events", "s", 2)
    e.compact("events_day", keep_versions=1)
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)
    assert e.facts("events").count() == _events(spark).count()


def test_two_compactions_at_once_count_once(spark, tmp_root, monkeypatch):
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 2)
    e.ingest(parts[0], "events", "s", 0)
    e.ingest(parts[0].limit(5), "events", "extra", 0)
    other = Engine(spark, SPEC, tmp_root)
    commit, raced = other.table("events").log.commit, []

    def late(*args):
        if not raced:  # the other compaction commits, and a batch arrives, before this one does
            raced.append(e.compact("events_day", full=True))
            e.ingest(parts[0].limit(0), "events", "extra", 0)
            e.ingest(parts[1], "events", "s", 1)
        return commit(*args)

    monkeypatch.setattr(other.table("events").log, "commit", late)
    assert other.compact("events_day", full=True) == 2 and raced == [1]
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_batch_that_arrives_during_a_compaction(spark, tmp_root, monkeypatch):
    """A compaction whose parts are all still there commits after a batch that came in between."""
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 3)
    for i in (0, 1):
        e.ingest(parts[i], "events", "s", i)
    other = Engine(spark, SPEC, tmp_root)
    commit, tried = other.table("events").log.commit, []

    def late(*args):
        if not tried:
            e.ingest(parts[2], "events", "s", 2)
        tried.append(args[0])
        return commit(*args)

    monkeypatch.setattr(other.table("events").log, "commit", late)
    assert other.compact("events_day", full=True) == 1 and len(tried) == 2
    assert as_set(e.view("events_day").collect(), 9) == as_set(_one_pass(spark), 9)


def test_reader_open_across_fact_compaction(spark, tmp_root):
    e = Engine(spark, SPEC, tmp_root)
    parts = catalog.split_batches(_events(spark), ["event_id"], 2)
    e.ingest(parts[0], "events", "s", 0)
    before = e.facts("events")
    e.compact_facts("events", full=True)
    n = parts[0].count()
    assert before.count() == n and e.facts("events").count() == n


def test_replay_replaces_months_it_no_longer_has(spark, tmp_root):
    import datetime as dt

    e = Engine(spark, SPEC, tmp_root)
    rows = [(1, dt.datetime(2024, 1, 5), 1.0), (1, dt.datetime(2024, 2, 5), 2.0)]
    frame = lambda r: spark.createDataFrame(r, e.spec.table("events").schema)
    e.ingest(frame(rows), "events", "a b/c", 0)
    e.ingest(frame(rows[1:]), "events", "a b/c", 0)
    assert [r.value for r in e.facts("events").collect()] == [2.0]
    e.ingest(frame([]), "events", "a b/c", 0)
    assert e.facts("events").count() == 0


def test_views_show_rows_ingested_after_setup(spark, tmp_root):
    table = {**catalog.EVENTS_TABLE, "name": "my events-1"}
    e = Engine(spark, {"tables": [table], "analytical_tables": [{"table": "my events-1", "aggregator": catalog.LAST}]}, tmp_root)
    assert e.setup() == ["my events-1", "my events-1_last"]
    assert e.sql("SELECT count(*) FROM `my events-1`").first()[0] == 0
    e.ingest(_events(spark), "my events-1", "s", 0)
    assert e.sql("SELECT count(*) FROM `my events-1`").first()[0] == _events(spark).count()
    users = _events(spark).select("user_id").distinct().count()
    assert e.sql("SELECT count(*) FROM `my events-1_last`").first()[0] == users


def test_time_range_takes_dates_and_stops_at_the_month(spark, tmp_root):
    import datetime as dt

    from rollstate.sources import store

    e = Engine(spark, {"tables": [catalog.LINEITEM_TABLE]}, tmp_root)
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    e.ingest(li, "lineitem", "s", 0)
    t = e.spec.table("lineitem")
    r = store.time_range(e.facts("lineitem"), t, dt.date(1996, 3, 15), dt.date(1996, 7, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "<= 199606" in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert r.count() == li.where((F.col("l_shipdate") >= "1996-03-15") & (F.col("l_shipdate") < "1996-07-01")).count()


def test_fact_compaction_noop_and_empty_table(spark, tmp_root):
    e = Engine(spark, {"tables": [catalog.EVENTS_TABLE]}, tmp_root)
    empty = e.facts("events")
    assert empty.count() == 0 and empty.columns == ["user_id", "ts", "value", "yyyymm"]
    assert e.compact_facts("events") == 0  # nothing written yet
    e.ingest(_events(spark), "events", "s", 0)
    assert e.compact_facts("events", full=True) == 0  # one part a month: nothing to merge
    assert e.facts("events").count() == _events(spark).count()


def _day_batches(spark, spec, root):
    """Suppliers 0 to 39 with one value a day or three, NULL measures and a NULL time, in two batches."""
    rows = [(i % 40, None if i % 17 == 0 else dt.datetime(1996, 3, 1 + i % 5, i % 24), None if i % 7 == 0 else i / 3, i / 7, i * 2.0, i / 9) for i in range(240)]
    df = spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    e = Engine(spark, spec, root)
    for i in range(2):
        e.ingest(df.where(F.col("l_discount") % 4 == 2 * i), "lineitem", "s", i, write_facts=False)
    return e, df


def test_a_compaction_moves_state_rows_once(spark, tmp_root, monkeypatch):
    """States that merge without sketches are dealt to their ranges before they are merged, not after."""
    seen, write = [], part_store.PartStore.write

    def spy(self, df, part, ranges=None, *args, **kw):
        if ranges:
            seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, part, ranges, *args, **kw)

    e, df = _day_batches(spark, catalog.LINEITEM_DAY_SPEC, tmp_root)
    assert "Union" not in e.view("lineitem_day")._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(part_store.PartStore, "write", spy)
    e.compact("lineitem_day", full=True)
    (plan,) = seen
    assert plan.count("Repartition") == 1 and "Union" not in plan and plan.index("Aggregate") < plan.index("Repartition")
    assert as_set(e.view("lineitem_day").collect()) == as_set(rollups.one_pass(df, e.spec.rollup("lineitem_day")).collect())


def test_values_beyond_the_bound_are_sketched_by_a_compaction(spark, tmp_root):
    """No part has a sketch, but together they have more values of a key than a state keeps."""
    day = {"type": "interval", "name": "year", "group_functions": ["toStartOfYear"], "aggregations": [{"type": "count"}, {"type": "quantiles", "args_agg": ["0.5"], "exact": 4}]}
    spec = {"tables": [catalog.LINEITEM_TABLE], "analytical_tables": [{"table": "lineitem", "aggregator": day}]}
    e, df = _day_batches(spark, spec, tmp_root)
    want = as_set(df.groupBy("l_suppkey", F.trunc("l_shipdate", "year").alias("year")).agg(F.count("l_tax").alias("n")).collect())
    for _ in range(2):
        assert as_set(e.view("lineitem_year").select("l_suppkey", "year", "l_tax_count").collect()) == want
        e.compact("lineitem_year", full=True)
    s = F.col("l_tax_quantiles_05_state")
    held = e.table("lineitem").states("lineitem_year").agg(F.max(F.size(s["values"])), F.count(s["sketch"])).first()
    assert held[0] <= 4 and held[1] > 0
    assert all("most" not in p for p in log.relation(_state(e, "lineitem"), "lineitem_year")["parts"].values())
