"""One-pass rollups against DuckDB, merge laws for partial states, skewed groups, plan shape."""

from __future__ import annotations

import datetime as dt
import math
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shared import SF_SMALL, as_set
from rollstate import catalog
from rollstate.operators import quantiles, rollups
from rollstate.spec import SpecError, load_spec

EVENTS = load_spec(catalog.EVENTS_SPEC)
LINEITEM = load_spec(catalog.LINEITEM_SPEC)


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


def test_last_matches_arg_max(spark, duck):
    got = rollups.one_pass(events(spark), EVENTS.rollup("events_last")).collect()
    want = duck.sql("SELECT user_id, max(ts), arg_max(value, ts) FROM events GROUP BY 1").fetchall()
    assert as_set(got) == as_set(want)


def test_last_with_ties_is_one_coherent_row(spark, duck):
    got = rollups.one_pass(lineitem(spark), LINEITEM.rollup("lineitem_last")).collect()
    want = duck.sql(
        "SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax FROM ("
        " SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_quantity DESC,"
        " l_extendedprice DESC, l_discount DESC, l_tax DESC) rn FROM lineitem) WHERE rn = 1"
    ).fetchall()
    assert as_set(got) == as_set(want)
    # every returned row exists in the input (no mixing of rows)
    li = {tuple(r) for r in duck.sql(
        "SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem").fetchall()}
    assert all(tuple(r) in li for r in got)


def test_daily_rollup_matches_sql(spark, duck):
    got = rollups.one_pass(events(spark), EVENTS.rollup("events_day")).collect()
    want = duck.sql(
        "SELECT user_id, CAST(date_trunc('day', ts) AS DATE), count(value), avg(value),"
        " quantile_cont(value, [0.1, 0.5, 0.9]), stddev_samp(value) FROM events GROUP BY 1, 2"
    ).fetchall()
    assert as_set(got) == as_set(want)


@pytest.mark.parametrize("hot_rows", [3, 40])
def test_hot_groups_take_distributed_path_with_equal_results(spark, duck, hot_rows):
    """Groups above ``hot_rows`` go through range partitioning; results must not change."""
    spec = {
        "tables": [catalog.LINEITEM_TABLE],
        "analytical_tables": [
            {"table": "lineitem", "aggregator": {"type": "interval", "name": "yr", "group_functions": ["toStartOfYear"],
                                                  "aggregations": catalog.FULL_AGGS}}
        ],
    }
    at = load_spec(spec).rollup("lineitem_yr")
    li = lineitem(spark).where(F.col("l_suppkey") < 12)  # keep the test quick; every group is complete
    got = rollups.one_pass(li, at, hot_rows=hot_rows, partition_rows=25).select(
        "l_suppkey", "yr", "l_tax_count", "l_tax_quantiles_01_05_09", "l_extendedprice_quantiles_01_05_09",
        "l_quantity_stddevSamp").collect()
    want = duck.sql(
        "SELECT l_suppkey, CAST(date_trunc('year', l_shipdate) AS DATE), count(l_tax), quantile_cont(l_tax, [0.1, 0.5, 0.9]),"
        " quantile_cont(l_extendedprice, [0.1, 0.5, 0.9]), stddev_samp(l_quantity)"
        " FROM lineitem WHERE l_suppkey < 12 GROUP BY 1, 2"
    ).fetchall()
    assert as_set(got) == as_set(want)


def test_one_hot_key_holding_most_rows(spark):
    """A single id with most of the rows: exact quantiles equal a brute-force computation."""
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = [(7, base + dt.timedelta(minutes=i), rnd.uniform(-10, 30)) for i in range(3000)]
    rows += [(k, base + dt.timedelta(minutes=k), float(k)) for k in range(100, 140)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")
    spec = {"tables": [catalog.EVENTS_TABLE], "analytical_tables": [
        {"table": "events", "aggregator": {"type": "interval", "name": "mon", "group_functions": ["toYYYYMM"],
                                            "aggregations": [{"type": "quantiles", "args_agg": ["0", "0.25", "0.5", "0.999", "1"]}]}}]}
    at = load_spec(spec).rollup("events_mon")
    got = {r[0]: r[2] for r in rollups.one_pass(df, at, hot_rows=500, partition_rows=400).collect()}
    vals = sorted(v for k, _, v in rows if k == 7)

    def cont(p):
        h = p * (len(vals) - 1)
        lo, hi = math.floor(h), math.ceil(h)
        return vals[lo] + (h - lo) * (vals[hi] - vals[lo])

    assert got[7] == pytest.approx([cont(p) for p in (0, 0.25, 0.5, 0.999, 1)], rel=1e-12)
    assert got[120] == [120.0] * 5


def _random_batches(df: DataFrame, k: int, seed: int) -> list[DataFrame]:
    return df.randomSplit([1.0] * k, seed)


@pytest.mark.parametrize("k, seed", [(1, 1), (3, 2), (7, 3)])
def test_merge_law(spark, k, seed):
    """finish(merge(partial(b1..bk))) equals the one-pass aggregate for any split and order."""
    at = EVENTS.rollup("events_day")
    df = events(spark)
    parts = _random_batches(df, k, seed)
    random.Random(seed).shuffle(parts)
    states = reduce(DataFrame.unionByName, [rollups.partial(p, at) for p in parts])
    merged = rollups.view(states, at).collect()
    direct = rollups.one_pass(df, at).collect()
    assert as_set(merged, 9) == as_set(direct, 9)
    # compacting (merge without finish) and merging again changes nothing
    twice = rollups.view(rollups.merge(states, at), at).collect()
    assert as_set(twice, 9) == as_set(direct, 9)
    last = EVENTS.rollup("events_last")
    ls = reduce(DataFrame.unionByName, [rollups.partial(p, last) for p in parts])
    assert as_set(rollups.view(ls, last).collect()) == as_set(rollups.one_pass(df, last).collect())


def _quantile_rollup(**options):
    aggregations = [{"type": "quantiles", "args_agg": ["0.1", "0.5", "0.9"], **options}, {"type": "count"}]
    day = {"type": "interval", "name": "day", "group_functions": ["toDate"], "aggregations": aggregations}
    return load_spec({"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": day}]}).rollup("events_day")


def test_states_without_kept_values_equal_discrete_quantiles_on_small_groups(spark, duck):
    at = _quantile_rollup(exact=0)
    parts = _random_batches(events(spark), 4, 11)
    states = reduce(DataFrame.unionByName, [rollups.partial(p, at) for p in parts])
    got = rollups.view(states, at).select("user_id", "day", "value_quantiles_01_05_09").collect()
    want = duck.sql(
        "SELECT user_id, CAST(date_trunc('day', ts) AS DATE), quantile_disc(value, [0.1, 0.5, 0.9])"
        " FROM events GROUP BY 1, 2").fetchall()
    assert as_set(got) == as_set(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_values_and_sketches_merge_in_any_order(spark, seed):
    """Groups far below, around and far above the bound, in parts of uneven size, folded in several steps."""
    at, rnd = _quantile_rollup(exact=60, k=300), random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    groups = {1: 7, 2: 60, 3: 61, 4: 150, 5: 3000, 6: 0}
    rows = [(g, base + dt.timedelta(seconds=i), rnd.choice([rnd.gauss(0, 10), 4.0])) for g, n in groups.items() for i in range(n)]
    rows += [(6, base, None), (5, base, None)]
    schema = "user_id long, ts timestamp_ntz, value double"
    cuts = [[r for r in rows if hash((r, seed)) % 7 in own] for own in ((0, 1, 2, 3), (4,), (5, 6))]
    rnd.shuffle(cuts)
    a, b, c = [rollups.partial(spark.createDataFrame(part, schema), at) for part in cuts]
    for states in (a.unionByName(b).unionByName(c), rollups.merge(rollups.merge(c.unionByName(a), at).unionByName(b), at)):
        got = {r.user_id: r for r in rollups.view(states, at).collect()}
        assert {g: r.value_count for g, r in got.items()} == groups
        direct = {r.user_id: r[2] for r in rollups.one_pass(spark.createDataFrame(rows, schema), at).collect()}
        for g in (1, 2):
            assert got[g][2] == pytest.approx(direct[g], rel=1e-12)
        assert got[6][2] is None
        for g in (3, 4, 5):
            values = sorted(v for i, _, v in rows if i == g and v is not None)
            for p, q in zip((0.1, 0.5, 0.9), got[g][2]):
                below, upto = sum(v < q for v in values), sum(v <= q for v in values)
                assert q in values and below <= (p + 0.02) * len(values) + 1 and upto >= (p - 0.02) * len(values) - 1


def test_stddev_merge_is_stable_for_large_values(spark):
    """Values near 1e9 with spread 1e-3: the merged sample stddev keeps its precision."""
    base = dt.datetime(2024, 1, 1, 12)
    vals = [1e9 + (i % 7) * 1e-3 for i in range(1000)]
    rows = [(1, base + dt.timedelta(seconds=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")
    at = EVENTS.rollup("events_day")
    parts = _random_batches(df, 10, 3)
    states = reduce(DataFrame.unionByName, [rollups.partial(p, at) for p in parts])
    got = rollups.view(states, at).first().value_stddevSamp
    mean = sum(v - 1e9 for v in vals) / len(vals)
    truth = math.sqrt(sum((v - 1e9 - mean) ** 2 for v in vals) / (len(vals) - 1))
    assert got == pytest.approx(truth, rel=1e-5)


def test_single_row_group_stddev_is_null(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 5.0)], "user_id long, ts timestamp_ntz, value double")
    at = EVENTS.rollup("events_day")
    assert rollups.one_pass(df, at).first().value_stddevSamp is None
    assert rollups.view(rollups.partial(df, at), at).first().value_stddevSamp is None


def test_old_row_never_displaces_newer_last_value(spark):
    at = EVENTS.rollup("events_last")
    new = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), 2.0)], "user_id long, ts timestamp_ntz, value double")
    old = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0), (1, None, 9.0)], "user_id long, ts timestamp_ntz, value double")
    states = rollups.partial(new, at).unionByName(rollups.partial(old, at))
    r = rollups.view(states, at).first()
    assert (r.ts, r.value) == (dt.datetime(2024, 1, 2), 2.0)


def test_day_buckets_across_midnight_and_month_end(spark):
    rows = [
        (1, dt.datetime(2024, 1, 31, 23, 59, 59, 999999), 1.0),
        (1, dt.datetime(2024, 2, 1, 0, 0, 0), 2.0),
        (1, dt.datetime(2024, 2, 1, 23, 59, 59), 4.0),
    ]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")
    got = {r.day: r.value_count for r in rollups.one_pass(df, EVENTS.rollup("events_day")).collect()}
    assert got == {dt.date(2024, 1, 31): 1, dt.date(2024, 2, 1): 2}


def _plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fan_out_is_one_shuffle_without_python(spark):
    spec = {"tables": [catalog.LINEITEM_TABLE], "analytical_tables": [
        {"table": "lineitem", "aggregator": {"type": "interval", "name": "day", "group_functions": ["toDate"],
                                              "aggregations": [{"type": "count"}, {"type": "avg"}, {"type": "stddevSamp"}]}}]}
    at = load_spec(spec).rollup("lineitem_day")
    plan = _plan(rollups.one_pass(lineitem(spark), at))
    assert plan.count("Exchange") == 1
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    # with quantiles: still a single shuffle, and no sort of the rows for any measure
    qplan = _plan(rollups.one_pass(lineitem(spark), LINEITEM.rollup("lineitem_day")))
    assert qplan.count("Exchange hashpartitioning") == 1
    assert "Sort " not in qplan and "Window" not in qplan


def test_last_value_sorts_only_the_newest_rows(spark):
    """Rows that are not at their id's newest time are left out by a broadcast join before any sort."""
    plan = _plan(rollups.one_pass(lineitem(spark), LINEITEM.rollup("lineitem_last")))
    below_sort = plan[plan.rindex("Sort ["):]
    assert "BroadcastHashJoin" in below_sort and plan.count("Sort [") <= 2


def test_last_value_of_ids_without_time_and_beyond_broadcast(spark, monkeypatch):
    rows = [(None, dt.datetime(2024, 1, 1), 1.0), (None, dt.datetime(2024, 1, 1), 3.0), (2, None, 5.0), (3, dt.datetime(2024, 1, 3), None), (3, None, 7.0)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")
    at = EVENTS.rollup("events_last")
    want = {(None, dt.datetime(2024, 1, 1), 3.0), (2, None, None), (3, dt.datetime(2024, 1, 3), None)}
    assert {tuple(r) for r in rollups.one_pass(df, at).collect()} == want
    monkeypatch.setattr(rollups, "fits_broadcast", lambda *_: False)
    assert {tuple(r) for r in rollups.one_pass(df, at).collect()} == want


def test_middle_sized_groups_take_the_window(spark):
    at = _quantile_rollup()
    df = events(spark)
    want = as_set(rollups.one_pass(df, at).collect(), 9)
    keyed = df.withColumn("day", F.to_date("ts"))
    specs = [("q", "value", (0.1, 0.5, 0.9))]
    got = quantiles.exact(keyed, ["user_id", "day"], specs, [("n", F.count("value"))], hot_rows=10_000, list_rows=2)
    assert as_set(got.select("user_id", "day", "q", "n").collect(), 9) == want


def test_names_of_single_quantiles(spark, duck):
    names = [{"type": "median"}, {"type": "quantile", "args_agg": ["0.3"]}, {"type": "any"}]
    day = {"type": "interval", "name": "day", "group_functions": ["toDate"], "aggregations": names}
    at = load_spec({"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": day}]}).rollup("events_day")
    want = as_set(duck.sql("SELECT user_id, CAST(ts AS DATE), median(value), quantile_cont(value, 0.3), min(value) FROM events GROUP BY 1, 2").fetchall())
    cols = ["user_id", "day", "value_median", "value_quantile_03", "value_any"]
    assert as_set(rollups.one_pass(events(spark), at).select(*cols).collect()) == want
    assert as_set(rollups.view(rollups.partial(events(spark), at), at).select(*cols).collect()) == want
    for bad in ({"type": "quantile", "args_agg": ["0.3", "0.4"]}, {"type": "median", "k": 7}, {"type": "median", "exact": -1}, {"type": "avg", "k": 200},
                {"type": "quantiles", "args_agg": ["0.5"], "k": "200"}, {"type": "median", "args_agg": ["0.5"]}):
        with pytest.raises(SpecError):
            load_spec({"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": {**day, "aggregations": [bad]}}]})


def test_scan_reads_only_needed_columns(spark):
    df = rollups.one_pass(events(spark), EVENTS.rollup("events_last"))
    plan = _plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_hot_group_of_equal_values_spreads_and_stays_exact(spark):
    """A hot id whose rows mostly repeat one value (a stuck sensor)."""
    base = dt.datetime(2024, 1, 1)
    rows = [(3, base + dt.timedelta(seconds=i), 21.5) for i in range(2500)]
    rows += [(3, base + dt.timedelta(hours=1, seconds=i), float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double")
    spec = {"tables": [catalog.EVENTS_TABLE], "analytical_tables": [
        {"table": "events", "aggregator": {"type": "interval", "name": "mon", "group_functions": ["toYYYYMM"],
                                            "aggregations": [{"type": "count"}, {"type": "quantiles", "args_agg": ["0.05", "0.5", "0.95"]}]}}]}
    at = load_spec(spec).rollup("events_mon")
    r = rollups.one_pass(df, at, hot_rows=200, partition_rows=300).first()
    vals = sorted(v for _, _, v in rows)

    def cont(p):
        h = p * (len(vals) - 1)
        lo, hi = math.floor(h), math.ceil(h)
        return vals[lo] + (h - lo) * (vals[hi] - vals[lo])

    assert r.value_count == 3000
    assert r[3] == pytest.approx([cont(p) for p in (0.05, 0.5, 0.95)], rel=1e-12)


def test_notebook_day_fixture_counts_the_time_column(spark, duck):
    """count of the time column, avg, quantiles 0.1/0.9 and stddevSamp of the measure per day."""
    spec = {"tables": [catalog.EVENTS_TABLE], "analytical_tables": [
        {"table": "events", "aggregator": {"type": "interval", "name": "day", "group_functions": ["toDate", "toStartOfDay"],
                                            "aggregations": [{"type": "count", "columns": ["ts"]}, {"type": "avg"},
                                                             {"type": "quantiles", "args_agg": ["0.1", "0.9"]},
                                                             {"type": "stddevSamp"}]}}]}
    at = load_spec(spec).rollup("events_day")
    df = rollups.one_pass(events(spark), at)
    assert df.columns == ["user_id", "day", "value_avg", "value_quantiles_01_09", "value_stddevSamp", "ts_count"]
    want = duck.sql(
        "SELECT user_id, CAST(date_trunc('day', ts) AS DATE), avg(value), quantile_cont(value, [0.1, 0.9]),"
        " stddev_samp(value), count(ts) FROM events GROUP BY 1, 2").fetchall()
    assert as_set(df.collect()) == as_set(want)
    states = rollups.partial(events(spark), at)
    merged = rollups.view(states.unionByName(rollups.partial(events(spark).limit(0), at)), at)
    assert merged.select("ts_count").groupBy().sum().first()[0] == events(spark).count()


def test_spread_aggregations_in_one_pass_and_from_states(spark, duck, tmp_root):
    names = {"stddevSamp": "stddev_samp", "stddevPop": "stddev_pop", "varSamp": "var_samp", "varPop": "var_pop"}
    day = {"type": "interval", "name": "day", "group_functions": ["toDate"], "aggregations": [{"type": n} for n in names]}
    spec = load_spec({"tables": [catalog.EVENTS_TABLE], "analytical_tables": [{"table": "events", "aggregator": day}]})
    columns = [f"value_{n}" for n in names]
    want = duck.sql(f"SELECT user_id, CAST(ts AS DATE), {', '.join(f'{f}(value)' for f in names.values())} FROM events GROUP BY 1, 2").fetchall()
    at = spec.rollup("events_day")
    assert as_set(rollups.one_pass(events(spark), at).select("user_id", "day", *columns).collect()) == as_set(want)
    states = rollups.partial(events(spark), at)
    assert as_set(rollups.view(states, at).select("user_id", "day", *columns).collect()) == as_set(want)
