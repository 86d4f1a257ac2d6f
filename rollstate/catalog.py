"""Registered queries over the test tables (``<sf_dir>/<table>.parquet``).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame computed by the library over the
whole input tables.  The test tables play the telemetry roles as follows:

* ``events``   observation table, id ``user_id``, time ``ts``, one measure ``value``;
* ``lineitem`` observation table with four measures, id ``l_suppkey``, time ``l_shipdate`` (times tie);
* ``customer`` / ``supplier`` dimension tables (full / partial cover of the ids).

Queries that persist facts or states write below a fresh folder under the shared checkpoint folder.
Derived doubles are rounded to 6 places and quantile arrays are spread into scalar columns so the
results can be compared value by value with SQL.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollstate.functions import geo, timefn
from rollstate.operators import dims, rollups
from rollstate.plans.engine import Engine
from rollstate.session import scratch_dir
from rollstate.sources import codec, store
from rollstate.spec import load_spec
from rollstate.streaming import ingest

LAST = {"type": "last"}
DAY = {"type": "interval", "name": "day", "group_functions": ["toDate", "toStartOfDay"]}
FULL_AGGS = [
    {"type": "count"},
    {"type": "avg"},
    {"type": "quantiles", "args_agg": ["0.1", "0.5", "0.9"]},
    {"type": "stddevSamp"},
]
QUANTILE_NAMES = ("p10", "p50", "p90")
QUARTILE_NAMES = ("p25", "p50", "p75")


def _col(name: str, type_: str) -> dict:
    return {"name": name, "type": type_}


EVENTS_TABLE = {
    "name": "events",
    "id_column": _col("user_id", "Int64"),
    "ts_column": _col("ts", "DateTime64(6)"),
    "columns": [_col("value", "Float64")],
    "kafka_topic": "events",
}
LINEITEM_TABLE = {
    "name": "lineitem",
    "id_column": _col("l_suppkey", "Int64"),
    "ts_column": _col("l_shipdate", "DateTime64(6)"),
    "columns": [_col(c, "Float64") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
    "kafka_topic": None,
}
# The whole typed events row, for the message codec.
EVENTS_WIRE_TABLE = {
    "name": "events_wire",
    "id_column": _col("user_id", "Int64"),
    "ts_column": _col("ts", "DateTime64(6)"),
    "columns": [_col("event_id", "Int64"), _col("event_type", "String"), _col("value", "Float64"), _col("props", "String")],
}

EVENTS_SPEC = {
    "tables": [EVENTS_TABLE],
    "analytical_tables": [
        {"table": "events", "aggregator": {"type": "last"}},
        {"table": "events", "aggregator": {**DAY, "aggregations": FULL_AGGS}},
    ],
}
EVENTS_DAY_SPEC = {"tables": [EVENTS_TABLE], "analytical_tables": [EVENTS_SPEC["analytical_tables"][1]]}
EVENTS_LAST_SPEC = {"tables": [EVENTS_TABLE], "analytical_tables": [EVENTS_SPEC["analytical_tables"][0]]}
LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_DAY_SPEC = {"tables": [LINEITEM_TABLE], "analytical_tables": [{"table": "lineitem", "aggregator": {**DAY, "aggregations": FULL_AGGS}}]}
LINEITEM_SPEC = {
    "tables": [LINEITEM_TABLE],
    "analytical_tables": [
        {"table": "lineitem", "aggregator": {"type": "last", "tiebreak": []}},
        {"table": "lineitem", "aggregator": {**DAY, "aggregations": FULL_AGGS}},
        {
            "table": "lineitem",
            "aggregator": {
                "type": "interval",
                "name": "month",
                "group_functions": ["toYYYYMM"],
                "aggregations": [{"type": "count"}, {"type": "sum"}, {"type": "avg"}, {"type": "max"}],
            },
        },
    ],
}
# Average and quantiles per day, beside the last value.
LINEITEM_QUARTILE_SPEC = {
    "tables": [LINEITEM_TABLE],
    "analytical_tables": [
        {"table": "lineitem", "aggregator": {"type": "last"}},
        {
            "table": "lineitem",
            "aggregator": {**DAY, "aggregations": [{"type": "avg"}, {"type": "quantiles", "args_agg": ["0.25", "0.5", "0.75"]}]},
        },
    ],
}
EVENTS_BY_NAME_SPEC = {
    "tables": [EVENTS_TABLE],
    "analytical_tables": [
        {
            "table": "events",
            "aggregator": {
                **DAY,
                "aggregations": [
                    {"type": "min"},
                    {"type": "max"},
                    {"type": "sum"},
                    {"type": "argMax", "args_func": ["ts"]},
                    {"type": "argMin", "args_func": ["ts"]},
                ],
            },
        }
    ],
}


# ------------------------------------------------------------------------------------------ helpers


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def comparable(df: DataFrame, keys: list[str], levels: tuple[str, ...] = QUANTILE_NAMES) -> DataFrame:
    """Round doubles to 6 places and spread quantile arrays into ``<name>_p10`` … columns."""
    out = []
    for f in df.schema.fields:
        if f.name in keys:
            out.append(F.col(f.name))
        elif f.dataType.typeName() == "array":
            out += [r6(F.col(f.name)[i]).alias(f"{f.name}_{q}") for i, q in enumerate(levels)]
        elif f.dataType.typeName() == "double":
            out.append(r6(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def split_batches(df: DataFrame, cols: list[str], n: int) -> list[DataFrame]:
    """Split rows into ``n`` disjoint batches that together hold every row (hash of ``cols``)."""
    h = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n))
    return [df.where(h == i) for i in range(n)]


def time_cuts(df: DataFrame, ts: str, n: int) -> list[DataFrame]:
    """Split rows into ``n`` consecutive time slices (cut points from approximate quantiles)."""
    secs = F.unix_micros(F.col(ts).cast("timestamp"))
    cuts = df.select(secs.alias("_t")).approxQuantile("_t", [i / n for i in range(1, n)], 0.0001)
    bounds = [None, *cuts, None]
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (secs >= F.lit(int(lo)))
        if hi is not None:
            cond = cond & (secs < F.lit(int(hi)))
        out.append(df.where(cond))
    return out


def engine(spark: SparkSession, spec: dict, label: str) -> Engine:
    return Engine(spark, spec, scratch_dir(spark, label))


# ------------------------------------------------------------------------------- scans and filters


def scan_all(spark, sf_dir):
    """Whole-table scan with the declared schema, spec columns only."""
    t = load_spec(EVENTS_SPEC).table("events")
    return store.read_declared(spark, t, f"{sf_dir.rstrip('/')}/events.parquet")


def filter_id(spark, sf_dir):
    """Equality filter on the id, pushed into the Parquet scan."""
    t = load_spec(EVENTS_SPEC).table("events")
    return store.for_id(store.read_declared(spark, t, f"{sf_dir.rstrip('/')}/events.parquet"), t, 1)


def time_range_pruned(spark, sf_dir):
    """S5 + P4 + F4: write lineitem as a month-partitioned fact table, read a time range back."""
    e = engine(spark, {"tables": [LINEITEM_TABLE]}, "time-range")
    t = e.spec.table("lineitem")
    e.ingest(read(spark, sf_dir, "lineitem"), "lineitem", "load", 0)
    facts = e.facts("lineitem")
    return store.time_range(facts, t, "1996-03-15 00:00:00", "1996-07-01 00:00:00")


def compacted_facts(spark, sf_dir):
    """Fact compaction: lineitem ingested in four batches, merged by month in two rounds (with a replay
    of a merged batch in between), read back whole."""
    e = engine(spark, {"tables": [LINEITEM_TABLE]}, "fact-rounds")
    parts = split_batches(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 4)
    for i, p in enumerate(parts[:2]):
        e.ingest(p, "lineitem", "s", i)
    e.compact_facts("lineitem")
    e.ingest(parts[0], "lineitem", "s", 0)
    for i, p in enumerate(parts[2:], start=2):
        e.ingest(p, "lineitem", "s", i)
    e.compact_facts("lineitem")
    return e.facts("lineitem")


# ------------------------------------------------------------------------------------------- joins


def fact_dim_join(spark, sf_dir):
    """Facts × dimension (inner; ids without a dimension row drop out)."""
    t = load_spec(EVENTS_SPEC).table("events")
    facts = store.conform(read(spark, sf_dir, "events"), t)
    return dims.enrich(facts, read(spark, sf_dir, "supplier"), "user_id", "s_suppkey")


def last_value_enriched(spark, sf_dir):
    """The last-value view (persisted states, merged on read) × dimension."""
    e = engine(spark, EVENTS_LAST_SPEC, "last-enriched")
    e.ingest(read(spark, sf_dir, "events"), "events", "load", 0, write_facts=False)
    return e.enriched_view("events_last", read(spark, sf_dir, "customer"), "c_custkey")


# ------------------------------------------------------------------------------------ aggregations


def last_value(spark, sf_dir):
    """Newest time and value per id (one pass)."""
    at = load_spec(EVENTS_SPEC).rollup("events_last")
    return rollups.one_pass(read(spark, sf_dir, "events"), at)


def last_value_ties(spark, sf_dir):
    """A10 with tied times: one coherent row, ties broken by the measures."""
    at = load_spec(LINEITEM_SPEC).rollup("lineitem_last")
    return rollups.one_pass(read(spark, sf_dir, "lineitem"), at)


def daily_rollup(spark, sf_dir):
    """Per (id, day) count, avg, exact quantiles, sample stddev."""
    at = load_spec(EVENTS_SPEC).rollup("events_day")
    return comparable(rollups.one_pass(read(spark, sf_dir, "events"), at), at.keys)


def daily_rollup_multi(spark, sf_dir):
    """Four measures × four aggregations in one pass."""
    at = load_spec(LINEITEM_SPEC).rollup("lineitem_day")
    return comparable(rollups.one_pass(read(spark, sf_dir, "lineitem"), at), at.keys)


def agg_by_name(spark, sf_dir):
    """Aggregations chosen by name, argMax/argMin with an extra column argument."""
    at = load_spec(EVENTS_BY_NAME_SPEC).rollup("events_day")
    return comparable(rollups.one_pass(read(spark, sf_dir, "events"), at), at.keys)


def monthly_bucket(spark, sf_dir):
    """integer month bucket."""
    at = load_spec(LINEITEM_SPEC).rollup("lineitem_month")
    return comparable(rollups.one_pass(read(spark, sf_dir, "lineitem"), at), at.keys)


def spec_rollup(spark, sf_dir):
    """A spec dict drives the rollup; output columns are named by slug."""
    at = load_spec(LINEITEM_QUARTILE_SPEC).rollup("lineitem_day")
    return comparable(rollups.one_pass(read(spark, sf_dir, "lineitem"), at), at.keys, QUARTILE_NAMES)


# -------------------------------------------------------------------------------- persisted states


def _ingest_split(e: Engine, table: str, parts: list[DataFrame], source: str = "s") -> None:
    """Ingest each part as its own batch (states only)."""
    for i, p in enumerate(parts):
        e.ingest(p, table, source, i, write_facts=False)


def _only_quantiles(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if "_quantiles_" in c])


def incremental_rollup(spark, sf_dir):
    """A12/A13/ST2: four batches aggregated into states, merged on read."""
    e = engine(spark, EVENTS_DAY_SPEC, "incremental")
    ev = read(spark, sf_dir, "events")
    _ingest_split(e, "events", split_batches(ev, ["event_id"], 4))
    return comparable(e.view("events_day"), ["user_id", "day"])


def incremental_quantiles(spark, sf_dir):
    """A3 persisted: quantile states per batch, merged on read."""
    e = engine(spark, EVENTS_DAY_SPEC, "incremental-q")
    ev = read(spark, sf_dir, "events")
    _ingest_split(e, "events", split_batches(ev, ["event_id"], 4))
    return comparable(_only_quantiles(e.view("events_day"), ["user_id", "day"]), ["user_id", "day"])


def incremental_last(spark, sf_dir):
    """A12/A13/ST4: batches arrive newest first; older rows never displace the last value."""
    e = engine(spark, EVENTS_LAST_SPEC, "incremental-last")
    ev = read(spark, sf_dir, "events")
    _ingest_split(e, "events", list(reversed(time_cuts(ev, "ts", 4))))
    return e.view("events_last")


def compacted_rollup(spark, sf_dir):
    """States compacted twice with batches in between and after, older versions and folded
    batch files vacuumed after each compaction; equal to one pass."""
    e = engine(spark, EVENTS_DAY_SPEC, "compacted")
    ev = read(spark, sf_dir, "events")
    parts = split_batches(ev, ["event_id"], 7)
    for i, p in enumerate(parts):
        e.ingest(p, "events", "s", i, write_facts=False)
        if i in (3, 5):
            e.compact("events_day", keep_versions=1)
    return comparable(e.view("events_day"), ["user_id", "day"])


def day_view_for_id(spark, sf_dir):
    """P3 on a rollup view: the merged day view filtered to one id; the filter on the grouping key
    is applied below the merge, where the compacted part's files of other ids are not opened."""
    e = engine(spark, EVENTS_DAY_SPEC, "view-id")
    ev = read(spark, sf_dir, "events")
    parts = split_batches(ev, ["event_id"], 3)
    _ingest_split(e, "events", parts[:2])
    e.compact("events_day", full=True)
    e.ingest(parts[2], "events", "s", 2, write_facts=False)
    return comparable(e.view("events_day", ids=[1]), ["user_id", "day"])


def setup_views_sql(spark, sf_dir):
    """``Engine.setup`` registers the fact table and rollups as create-or-replace views,
    queried with SQL."""
    obs = {**EVENTS_TABLE, "name": "obs"}
    spec = {"tables": [obs], "analytical_tables": [{"table": "obs", "aggregator": {**DAY, "aggregations": FULL_AGGS}}]}
    e = engine(spark, spec, "setup-sql")
    e.setup()
    e.ingest(read(spark, sf_dir, "events"), "obs", "load", 0)
    e.setup()  # idempotent
    return e.sql(
        "SELECT d.user_id, d.day, d.value_count, round(d.value_avg, 6) AS value_avg, "
        "round(d.value_stddevSamp, 6) AS value_stddevSamp, f.n_facts "
        "FROM obs_day d JOIN (SELECT user_id, count(*) AS n_facts FROM obs GROUP BY user_id) f "
        "ON d.user_id = f.user_id"
    )


def spec_persisted_rollup(spark, sf_dir):
    """Average and quartiles of four measures per day kept as persisted states over two
    batches, merged on read (small groups keep their values, so their quartiles are exact)."""
    e = engine(spark, LINEITEM_QUARTILE_SPEC, "spec-persisted")
    li = read(spark, sf_dir, "lineitem")
    for i, part in enumerate(split_batches(li, ["l_orderkey", "l_linenumber", "l_partkey"], 2)):
        e.ingest(part, "lineitem", "s", i, write_facts=False)
    return comparable(e.view("lineitem_day"), ["l_suppkey", "day"], QUARTILE_NAMES)


def _write_messages(df: DataFrame, table_spec: dict, path: str, files: int) -> None:
    t = load_spec({"tables": [table_spec]}).tables[0]
    codec.encode(df, t).select("value").repartition(files).write.mode("overwrite").text(path)


def stream_ingest_rollup(spark, sf_dir):
    """ST1-ST3/S7: JSON messages streamed file by file into facts and rollup states."""
    e = engine(spark, EVENTS_SPEC, "stream")
    src = f"{e.root}/inbox"
    _write_messages(read(spark, sf_dir, "events"), EVENTS_TABLE, src, 4)
    q = ingest.start(
        e, "events", ingest.file_messages(spark, src, 1), f"{e.root}/checkpoint", max_bad=0, trigger={"availableNow": True}
    )
    q.awaitTermination()
    return _with_last(e)


def _with_last(e: Engine) -> DataFrame:
    """The day view with the id's last value beside it, so both rollups are read."""
    day = comparable(e.view("events_day"), ["user_id", "day"])
    newest = e.view("events_last").select("user_id", F.col("ts").alias("last_ts"), F.col("value").alias("last_value"))
    return dims.join_small(day, newest, "user_id", "left")


def stream_native_window(spark, sf_dir):
    """ST3 native form: JSON messages streamed into tumbling one-day windows per id held in Spark's
    streaming state (update mode, quantiles as KLL sketches); each micro-batch's updated groups are
    written out and the newest row per group is the result."""
    root = scratch_dir(spark, "native-window")
    spec = load_spec(EVENTS_SPEC)
    t, agg = spec.table("events"), spec.rollup("events_day").aggregator
    _write_messages(read(spark, sf_dir, "events"), EVENTS_TABLE, f"{root}/inbox", 4)
    decoded = codec.good(codec.decode(ingest.file_messages(spark, f"{root}/inbox", 1), t), t)
    q = ingest.start_windowed(
        decoded, t, agg, f"{root}/updates", f"{root}/checkpoint", trigger={"availableNow": True},
    )
    q.awaitTermination()
    return comparable(ingest.latest_windows(spark, f"{root}/updates", ["user_id", "day"]), ["user_id", "day"])


def backfill_then_stream(spark, sf_dir):
    """ST5: facts stored before the rollup exists are backfilled; the rest arrives by stream."""
    root = scratch_dir(spark, "backfill")
    ev = read(spark, sf_dir, "events")
    early, late = time_cuts(ev, "ts", 2)
    facts_only = Engine(spark, {"tables": [EVENTS_TABLE]}, root)
    facts_only.ingest(early, "events", "history", 0)
    e = Engine(spark, EVENTS_SPEC, root)
    e.backfill("events_day")
    e.backfill("events_last")
    src = f"{root}/inbox"
    _write_messages(late, EVENTS_TABLE, src, 3)
    q = ingest.start(
        e, "events", ingest.file_messages(spark, src, 1), f"{root}/checkpoint", max_bad=0, trigger={"availableNow": True}
    )
    q.awaitTermination()
    return _with_last(e)


# ------------------------------------------------------------------------------------- codec


def json_roundtrip(spark, sf_dir):
    """Every typed column → keyed JSON message → decoded back, µs kept."""
    t = load_spec({"tables": [EVENTS_WIRE_TABLE]}).tables[0]
    msgs = codec.encode(read(spark, sf_dir, "events"), t)
    return codec.good(codec.decode(msgs, t), t)


def _damaged_messages(spark, sf_dir) -> tuple[DataFrame, object]:
    """Events as messages, with every ``error`` event's message cut in half (stand-in for broken input)."""
    t = load_spec({"tables": [EVENTS_WIRE_TABLE]}).tables[0]
    ev = read(spark, sf_dir, "events")
    value = codec.value_column(t)
    damaged = F.when(F.col("event_type") == "error", F.substring(value, 1, F.length(value) / 2)).otherwise(value)
    msgs = ev.select(F.col("user_id").cast("string").alias("key"), damaged.alias("value"))
    return msgs, t


def json_rejects(spark, sf_dir):
    """S3: malformed messages are split off; the good rows decode intact."""
    msgs, t = _damaged_messages(spark, sf_dir)
    return codec.good(codec.decode(msgs, t), t)


def json_reject_counts(spark, sf_dir):
    """S3: messages per outcome (``ok`` or the reject reason)."""
    msgs, t = _damaged_messages(spark, sf_dir)
    d = codec.decode(msgs, t)
    return d.groupBy(F.coalesce(F.col(codec.REASON), F.lit("ok")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------------------------ dimension


def insert_if_absent(spark, sf_dir):
    """Incoming suppliers (every row twice) inserted unless their name exists; new rows get
    ids after the current maximum."""
    sup = read(spark, sf_dir, "supplier")
    target = sup.where(F.col("s_nationkey") < 10)
    incoming = sup.unionAll(sup)
    return dims.insert_if_absent(target, incoming, ["s_name"], id_column="s_suppkey")


def constraint_violations(spark, sf_dir):
    """Uniqueness of (l_orderkey, l_linenumber) checked on lineitem."""
    li = read(spark, sf_dir, "lineitem")
    return dims.violations(li, ["l_orderkey", "l_linenumber"], unique=[["l_orderkey", "l_linenumber"]])


def _stations(spark, sf_dir) -> DataFrame:
    """A station-shaped dimension from ``customer``: id, name, and coordinates computed from its
    columns (no test table carries coordinates)."""
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("label"),
        (F.lit(57.0) + F.col("c_acctbal") / 1000.0).alias("lat"),
        (F.lit(4.0) + F.col("c_nationkey") * 0.5).alias("lon"),
    )


def map_ready(spark, sf_dir):
    """last value × stations → point geometry, WKT, display time, colour category."""
    at = load_spec(EVENTS_SPEC).rollup("events_last")
    last = rollups.one_pass(read(spark, sf_dir, "events"), at)
    joined = dims.enrich(last, _stations(spark, sf_dir), "user_id", "id")
    m = geo.map_ready(joined, "ts", "lon", "lat", "label")
    return m.select(
        "user_id",
        "value",
        "ts",
        "label",
        r6("lat").alias("lat"),
        r6("lon").alias("lon"),
        r6(F.col("geometry.x")).alias("geom_x"),
        r6(F.col("geometry.y")).alias("geom_y"),
        F.col("geometry.srid").alias("srid"),
        "wkt",
        "category",
    )


def late_batch_after_compaction(spark, sf_dir):
    """A14/ST4: batches arrive out of order around compactions of states and facts; none is lost.
    One row per user and day from the rollup, with the number of fact rows beside it."""
    e = engine(spark, EVENTS_DAY_SPEC, "late-batch")
    parts = split_batches(read(spark, sf_dir, "events"), ["event_id"], 4)
    for i in (2, 1):
        e.ingest(parts[i], "events", "s", i)
    e.compact("events_day")
    e.compact_facts("events")
    e.ingest(parts[0], "events", "s", 0)  # an id below all folded ones
    e.ingest(parts[3], "events", "s", 3)
    e.compact_facts("events")
    facts = e.facts("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_facts"))
    counts = e.view("events_day").select("user_id", "day", "value_count", r6("value_avg").alias("value_avg"))
    return counts.join(facts, ["user_id", "day"])


def backfill_after_compaction(spark, sf_dir):
    """ST5: a rollup added while facts exist, compacted, and only then backfilled."""
    root = scratch_dir(spark, "late-backfill")
    first, second = split_batches(read(spark, sf_dir, "events"), ["event_id"], 2)
    Engine(spark, {"tables": [EVENTS_TABLE]}, root).ingest(first, "events", "s", 0)
    e = Engine(spark, EVENTS_DAY_SPEC, root)
    e.ingest(second, "events", "s", 1)
    e.compact("events_day")
    e.backfill("events_day")
    e.backfill("events_day")  # nothing left to do
    return e.view("events_day").select("user_id", "day", "value_count", r6("value_avg").alias("value_avg"))


def setup_first_sql_join(spark, sf_dir):
    """Relations named before any data exists (one with a name that is no identifier),
    two batches ingested later, then the flagship join of last values and a dimension in SQL."""
    spec = {"tables": [{**EVENTS_TABLE, "name": "user-events"}], "analytical_tables": [{"table": "user-events", "aggregator": LAST}]}
    e = engine(spark, spec, "setup-first")
    e.setup()
    e.register("people", read(spark, sf_dir, "customer"))
    for i, part in enumerate(split_batches(read(spark, sf_dir, "events"), ["event_id"], 2)):
        e.ingest(part, "user-events", "s", i)
    return e.sql(
        "SELECT l.user_id, l.ts, l.value, p.c_name, f.n_facts FROM `user-events_last` l "
        "JOIN people p ON p.c_custkey = l.user_id "
        "JOIN (SELECT user_id, count(*) AS n_facts FROM `user-events` GROUP BY user_id) f ON f.user_id = l.user_id"
    )


def json_several_objects(spark, sf_dir):
    """Messages that hold two objects (on two lines, or as an array) beside messages with
    text after the object; the key stays with every decoded row."""
    t = load_spec({"tables": [EVENTS_WIRE_TABLE]}).tables[0]
    value, late = codec.value_column(t), F.col("event_id") % 4
    pair = F.concat(value, F.lit("\n"), value)
    text = F.when(late == 0, pair).when(late == 1, F.concat(F.lit("["), value, F.lit(","), value, F.lit("]")))
    text = text.when(late == 2, F.concat(value, F.lit(" trailing"))).otherwise(value)
    msgs = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), text.alias("value"))
    d = codec.decode(msgs, t)
    status = F.coalesce(F.col(codec.REASON), F.lit("ok")).alias("status")
    return d.groupBy("key", status).agg(F.count(F.lit(1)).alias("n"), F.count("event_id").alias("n_ids"))


def bucket_functions(spark, sf_dir):
    """Events per value of every bucket function."""
    ev = read(spark, sf_dir, "events")
    names = sorted(timefn.BUCKET_FUNCTIONS)
    each = [ev.select(F.lit(n).alias("name"), timefn.bucket("ts", [n]).cast("string").alias("bucket")) for n in names]
    return reduce(DataFrame.unionAll, each).groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))


def facts_filtered(spark, sf_dir):
    """P3/P4 over the fact store: lineitem in two batches, one of them compacted into files of disjoint
    (month, supplier) ranges; one supplier and a range between two dates."""
    e = engine(spark, {"tables": [LINEITEM_TABLE]}, "facts-filtered")
    parts = split_batches(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 3)
    for i, part in enumerate(parts[:2]):
        e.ingest(part, "lineitem", "s", i)
    e.compact_facts("lineitem")
    e.ingest(parts[2], "lineitem", "s", 2)
    return e.facts("lineitem", ids=[1], lo=dt.date(1996, 3, 15), hi=dt.date(1996, 7, 1))


def view_time_range(spark, sf_dir):
    """P4 on A13: the day view of lineitem between two dates; states lie by the month of their bucket,
    so only those of four months are read."""
    e = engine(spark, LINEITEM_DAY_SPEC, "view-range")
    parts = split_batches(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 2)
    _ingest_split(e, "lineitem", parts)
    view = e.view("lineitem_day", lo=dt.date(1996, 3, 15), hi=dt.date(1996, 7, 1))
    return comparable(view, ["l_suppkey", "day"])


def tiered_compaction(spark, sf_dir):
    """A14 by month: everything but the newest days is loaded and compacted, then the newest days arrive
    as small batches; compacting again rewrites the months they touch and no other.  One row per
    supplier and day, and the number of months that kept their files."""
    e = engine(spark, LINEITEM_DAY_SPEC, "tiered")
    li = read(spark, sf_dir, "lineitem")
    cut = F.lit("1998-08-01").cast("timestamp_ntz")
    old, new = li.where(F.col("l_shipdate") < cut), li.where(~(F.col("l_shipdate") < cut) | F.col("l_shipdate").isNull())
    load = split_batches(old, ["l_orderkey", "l_linenumber"], 2)
    _ingest_split(e, "lineitem", load)
    e.compact("lineitem_day", full=True)
    before = e.table("lineitem").months("lineitem_day")
    for i, part in enumerate(split_batches(new, ["l_orderkey", "l_linenumber"], 3)):
        e.ingest(part, "lineitem", "daily", i, write_facts=False)
    e.compact("lineitem_day")
    after = e.table("lineitem").months("lineitem_day")
    untouched = sum(before[m] == after.get(m) for m in before)
    return comparable(e.view("lineitem_day"), ["l_suppkey", "day"]).withColumn("months_untouched", F.lit(untouched))


def replayed_batch(spark, sf_dir):
    """ST2/S7/S5: events in four batches; one is replayed with half of its rows, one with none, and
    after compactions of facts and rollups one more each way.  Facts and both rollups agree: one row
    per user with the counts and the newest time that each of them gives."""
    e = engine(spark, EVENTS_SPEC, "replayed")
    ev = read(spark, sf_dir, "events")
    parts = [ev.where(F.col("event_id") % 4 == i) for i in range(4)]
    for i, part in enumerate(parts):
        e.ingest(part, "events", "s", i)
    e.ingest(parts[0].where(F.col("event_id") % 8 == 0), "events", "s", 0)
    e.ingest(parts[1].limit(0), "events", "s", 1)
    e.compact_facts("events", full=True)
    for rollup in ("events_day", "events_last"):
        e.compact(rollup, full=True)
    e.ingest(parts[2].where(F.col("event_id") % 8 == 2), "events", "s", 2)
    e.ingest(parts[1].where(F.col("event_id") % 8 == 1), "events", "s", 1)
    e.ingest(parts[3].limit(0), "events", "s", 3)
    facts = e.facts("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_facts"), F.max("ts").alias("facts_newest"))
    days = e.view("events_day").groupBy("user_id").agg(F.sum("value_count").alias("n_days"), F.count(F.lit(1)).alias("days"))
    newest = e.view("events_last").select("user_id", F.col("ts").alias("newest"))
    return facts.join(days, "user_id", "full").join(newest, "user_id", "full")


def evolved_rollup(spark, sf_dir):
    """A measure and aggregations are added to a rollup between two batches; older states stay
    as they are and only the new columns are aggregated from the stored facts."""
    root = scratch_dir(spark, "evolved")
    parts = split_batches(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 3)

    def spec(columns: list[str], aggregations: list[dict]) -> dict:
        table = {**LINEITEM_TABLE, "columns": [_col(c, "Float64") for c in LINEITEM_MEASURES]}
        day = {**DAY, "aggregations": [{**a, "columns": columns} for a in aggregations]}
        return {"tables": [table], "analytical_tables": [{"table": "lineitem", "aggregator": day}]}

    first = Engine(spark, spec(["l_quantity"], FULL_AGGS[:2]), root)
    for i in (0, 1):
        first.ingest(parts[i], "lineitem", "s", i)
    first.compact("lineitem_day")
    e = Engine(spark, spec(["l_quantity", "l_tax"], FULL_AGGS), root)
    e.ingest(parts[2], "lineitem", "s", 2)
    e.backfill("lineitem_day")
    e.compact("lineitem_day", full=True)
    return comparable(e.view("lineitem_day"), ["l_suppkey", "day"])


def sketched_quantiles(spark, sf_dir):
    """A3/A12 beyond the exact bound: quantiles per year of lineitem from sketches of k 400, merged over
    three batches.  One row per year: how many values, and whether each answer's rank is within the
    sketch's error of its level (here 1.5 %) among all values."""
    table = {**LINEITEM_TABLE, "id_column": _col("l_returnflag", "String"), "columns": [_col("l_extendedprice", "Float64")]}
    aggregations = [{"type": "quantiles", "args_agg": ["0.1", "0.5", "0.9"], "k": 400, "exact": 100}, {"type": "count"}]
    year = {"type": "interval", "name": "year", "group_functions": ["toStartOfYear"], "aggregations": aggregations}
    e = engine(spark, {"tables": [table], "analytical_tables": [{"table": "lineitem", "aggregator": year}]}, "sketched")
    li = read(spark, sf_dir, "lineitem")
    _ingest_split(e, "lineitem", split_batches(li, ["l_orderkey", "l_linenumber"], 3))
    e.compact("lineitem_year", full=True)
    answers = e.view("lineitem_year").withColumnsRenamed({"l_returnflag": "_flag", "year": "_year"})
    rows = li.select("l_returnflag", timefn.bucket("l_shipdate", ["toStartOfYear"]).alias("year"), "l_extendedprice")
    same = F.col("l_returnflag").eqNullSafe(F.col("_flag")) & F.col("year").eqNullSafe(F.col("_year"))
    q, x = F.col("l_extendedprice_quantiles_01_05_09"), F.col("l_extendedprice")
    below = [F.sum((x < q[i]).cast("long")).alias(f"_lt{i}") for i in range(3)]
    upto = [F.sum((x <= q[i]).cast("long")).alias(f"_le{i}") for i in range(3)]
    n = F.max("l_extendedprice_count").alias("n")
    ranks = dims.join_small(rows, answers, same).groupBy("l_returnflag", "year").agg(n, *below, *upto)
    within = [
        ((F.col(f"_lt{i}") <= (p + 0.015) * F.col("n") + 1) & (F.col(f"_le{i}") >= (p - 0.015) * F.col("n") - 1)).alias(f"within_{name}")
        for i, (p, name) in enumerate(zip((0.1, 0.5, 0.9), QUANTILE_NAMES))
    ]
    return ranks.select("l_returnflag", "year", "n", *within)


def named_aggregates(spark, sf_dir):
    """Median, one quantile, any and the spread functions by name, from states of two batches."""
    names = [{"type": "median"}, {"type": "quantile", "args_agg": ["0.75"]}, {"type": "any"}, {"type": "varPop"}, {"type": "stddevPop"}]
    spec = {"tables": [EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": {**DAY, "aggregations": names}}]}
    e = engine(spark, spec, "named")
    _ingest_split(e, "events", split_batches(read(spark, sf_dir, "events"), ["event_id"], 2))
    return comparable(e.view("events_day"), ["user_id", "day"])


def native_windows(spark, sf_dir):
    """ST3 native form with a watermark and buckets above a day: events streamed into months and weeks
    per user, updates folded every other batch, the newest row per group."""
    root = scratch_dir(spark, "native-windows")
    t = load_spec(EVENTS_SPEC).table("events")
    _write_messages(read(spark, sf_dir, "events"), EVENTS_TABLE, f"{root}/inbox", 3)
    decoded = codec.good(codec.decode(ingest.file_messages(spark, f"{root}/inbox", 1), t), t)
    out = []
    for name, functions in (("month", ["toStartOfMonth"]), ("week", ["toStartOfWeek"])):
        aggregator = {"type": "interval", "name": name, "group_functions": functions, "aggregations": [{"type": "count"}, {"type": "sum"}]}
        agg = load_spec({"tables": [EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": aggregator}]}).rollup(f"events_{name}").aggregator
        q = ingest.start_windowed(decoded, t, agg, f"{root}/{name}", f"{root}/{name}-checkpoint", watermark="3650 days", trigger={"availableNow": True}, fold_every=2)
        q.awaitTermination()
        newest = ingest.latest_windows(spark, f"{root}/{name}", ["user_id", name])
        out.append(newest.select("user_id", F.lit(name).alias("kind"), F.col(name).alias("bucket"), "value_count", r6("value_sum").alias("value_sum")))
    return out[0].unionByName(out[1])


def all_constraints(spark, sf_dir):
    """NOT NULL, length and uniqueness of a dimension with every kind of offence, in one scan."""
    c = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    damaged = c.select(
        "c_custkey",
        F.when(key % 7 != 0, F.col("c_name")).alias("c_name"),
        F.when(key % 5 == 0, F.repeat("c_mktsegment", 3)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.floor(key / 2).alias("pair"),
    )
    return dims.violations(damaged, ["c_custkey"], not_null=["c_name"], unique=[["pair"], ["c_custkey"]], max_len={"c_mktsegment": 12})


QUERIES = {
    "scan_all": scan_all,
    "filter_id": filter_id,
    "time_range_pruned": time_range_pruned,
    "fact_dim_join": fact_dim_join,
    "last_value": last_value,
    "last_value_ties": last_value_ties,
    "last_value_enriched": last_value_enriched,
    "daily_rollup": daily_rollup,
    "daily_rollup_multi": daily_rollup_multi,
    "agg_by_name": agg_by_name,
    "monthly_bucket": monthly_bucket,
    "incremental_rollup": incremental_rollup,
    "incremental_quantiles": incremental_quantiles,
    "incremental_last": incremental_last,
    "compacted_rollup": compacted_rollup,
    "stream_ingest_rollup": stream_ingest_rollup,
    "json_roundtrip": json_roundtrip,
    "json_rejects": json_rejects,
    "json_reject_counts": json_reject_counts,
    "insert_if_absent": insert_if_absent,
    "constraint_violations": constraint_violations,
    "spec_rollup": spec_rollup,
    "backfill_then_stream": backfill_then_stream,
    "map_ready": map_ready,
    "day_view_for_id": day_view_for_id,
    "setup_views_sql": setup_views_sql,
    "spec_persisted_rollup": spec_persisted_rollup,
    "stream_native_window": stream_native_window,
    "compacted_facts": compacted_facts,
    "late_batch_after_compaction": late_batch_after_compaction,
    "backfill_after_compaction": backfill_after_compaction,
    "setup_first_sql_join": setup_first_sql_join,
    "json_several_objects": json_several_objects,
    "bucket_functions": bucket_functions,
    "facts_filtered": facts_filtered,
    "view_time_range": view_time_range,
    "tiered_compaction": tiered_compaction,
    "replayed_batch": replayed_batch,
    "evolved_rollup": evolved_rollup,
    "sketched_quantiles": sketched_quantiles,
    "named_aggregates": named_aggregates,
    "native_windows": native_windows,
    "all_constraints": all_constraints,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's flagship: last value per id from merged states, joined with the dimension."""
    return last_value_enriched(spark, sf_dir)


