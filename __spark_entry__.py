"""

maps names to them and states the equivalent SQL.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollstate import catalog  # noqa: E402

LLM_LIBRARIES = {"duckdb", "numpy", "pyarrow", "public_tokenizers", "regex", "xxhash"}

try:  # the text operators are an optional part; without their folder the rest works alone
    import corpus_pipeline
    from rollstate.llm import queries as llm_queries
except ModuleNotFoundError as e:
    # Without the folder, or a library that only the text operators use, the other queries work.
    if e.name not in ("corpus_pipeline", "rollstate.llm") and e.name.split(".")[0] not in LLM_LIBRARIES:
        raise
    print(f"text operators are left out: {e}", file=sys.stderr)
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return catalog.flagship(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:

    def utc(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    registered = dict(catalog.QUERIES)
    if llm_queries:
        registered |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: utc(fn) for name, fn in registered.items()}


# ------------------------------------------------------------------------------------ oracle SQL

LI_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DAY_OF = "CAST(date_trunc('day', {ts}) AS DATE)"


def _r6(expr: str) -> str:
    return f"round({expr}, 6)"


def _quantiles(m: str, slug: str, levels, quantile: str = "quantile_cont") -> list[str]:
    return [f"{_r6(f'{quantile}({m}, {p})')} AS {m}_quantiles_{slug}_{name}" for p, name in levels]


def _full(m: str, quantile: str = "quantile_cont") -> list[str]:
    """count, avg, quantiles 0.1/0.5/0.9 (spread), stddevSamp of one measure."""
    return [
        f"count({m}) AS {m}_count",
        f"{_r6(f'avg({m})')} AS {m}_avg",
        *_quantiles(m, "01_05_09", ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")), quantile),
        f'{_r6(f"stddev_samp({m})")} AS "{m}_stddevSamp"',
    ]


def _rollup_sql(table: str, key: str, bucket: str, name: str, cols: list[str]) -> str:
    return f"SELECT {key}, {bucket} AS {name}, {', '.join(cols)} FROM {table} GROUP BY 1, 2"


EVENTS_DAY_ALL = _rollup_sql("events", "user_id", DAY_OF.format(ts="ts"), "day", _full("value"))
LAST_EVENTS = "SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY user_id"
EVENTS_DAY_AND_LAST = (
    f"SELECT d.*, n.ts AS last_ts, n.value AS last_value FROM ({EVENTS_DAY_ALL}) d LEFT JOIN ({LAST_EVENTS}) n USING (user_id)"
)


def oracle_sql() -> dict[str, str]:
    llm = llm_queries.ORACLE_SQL if llm_queries else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        llm = llm | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return _rollup_oracles() | llm


def _rollup_oracles() -> dict[str, str]:
    li_day = DAY_OF.format(ts="l_shipdate")
    month = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)"
    li_multi = [c for m in LI_MEASURES for c in _full(m)]
    li_quartiles = [c for m in LI_MEASURES for c in (_full(m)[1], *_quantiles(m, "025_05_075", ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))))]
    li_month = [
        c
        for m in LI_MEASURES
        for c in (
            f"count({m}) AS {m}_count",
            f"{_r6(f'sum({m})')} AS {m}_sum",
            f"{_r6(f'avg({m})')} AS {m}_avg",
            f"{_r6(f'max({m})')} AS {m}_max",
        )
    ]
    by_name = [
        f"{_r6('min(value)')} AS value_min",
        f"{_r6('max(value)')} AS value_max",
        f"{_r6('sum(value)')} AS value_sum",
        f'{_r6("arg_max(value, ts)")} AS "value_argMax_ts"',
        f'{_r6("arg_min(value, ts)")} AS "value_argMin_ts"',
    ]
    last_events = LAST_EVENTS
    incremental_q = [c for c in _full("value") if "_quantiles_" in c]
    return {
        "scan_all": "SELECT user_id, ts, value FROM events",
        "filter_id": "SELECT user_id, ts, value FROM events WHERE user_id = 1",
        "time_range_pruned": (
            "SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
            f"{month} AS yyyymm FROM lineitem "
            "WHERE l_shipdate >= TIMESTAMP '1996-03-15 00:00:00' AND l_shipdate < TIMESTAMP '1996-07-01 00:00:00'"
        ),
        "fact_dim_join": (
            "SELECT e.user_id, e.ts, e.value, s.s_suppkey, s.s_name, s.s_nationkey, s.s_acctbal "
            "FROM events e JOIN supplier s ON s.s_suppkey = e.user_id"
        ),
        "last_value": last_events,
        "last_value_ties": (
            "SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax FROM ("
            "SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC NULLS LAST, "
            "l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
            "l_tax DESC NULLS LAST) AS rn FROM lineitem WHERE l_shipdate IS NOT NULL) WHERE rn = 1"
        ),
        "last_value_enriched": (
            f"WITH last AS ({last_events}) "
            "SELECT last.user_id, last.ts, last.value, c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, "
            "c.c_mktsegment FROM last JOIN customer c ON c.c_custkey = last.user_id"
        ),
        "daily_rollup": _rollup_sql("events", "user_id", DAY_OF.format(ts="ts"), "day", _full("value")),
        "daily_rollup_multi": _rollup_sql("lineitem", "l_suppkey", li_day, "day", li_multi),
        "agg_by_name": _rollup_sql("events", "user_id", DAY_OF.format(ts="ts"), "day", by_name),
        "monthly_bucket": _rollup_sql("lineitem", "l_suppkey", month, "month", li_month),
        "incremental_rollup": EVENTS_DAY_ALL,
        "incremental_quantiles": _rollup_sql("events", "user_id", DAY_OF.format(ts="ts"), "day", incremental_q),
        "incremental_last": last_events,
        "compacted_rollup": EVENTS_DAY_ALL,
        "stream_ingest_rollup": EVENTS_DAY_AND_LAST,
        "json_roundtrip": "SELECT user_id, ts, event_id, event_type, value, props FROM events",
        "json_rejects": (
            "SELECT user_id, ts, event_id, event_type, value, props FROM events "
            "WHERE event_type IS DISTINCT FROM 'error'"
        ),
        "json_reject_counts": (
            "SELECT CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'ok' END AS status, count(*) AS n "
            "FROM events GROUP BY 1"
        ),
        "insert_if_absent": (
            "WITH target AS (SELECT * FROM supplier WHERE s_nationkey < 10), "
            "incoming AS (SELECT * FROM supplier UNION ALL SELECT * FROM supplier), "
            "firsts AS (SELECT s_name, s_nationkey, s_acctbal, row_number() OVER ("
            "PARTITION BY s_name ORDER BY s_nationkey ASC NULLS FIRST, s_acctbal ASC NULLS FIRST) AS rn FROM incoming), "
            "fresh AS (SELECT s_name, s_nationkey, s_acctbal FROM firsts "
            "WHERE rn = 1 AND s_name NOT IN (SELECT s_name FROM target)) "
            "SELECT s_name, s_nationkey, s_acctbal, "
            "(SELECT max(s_suppkey) FROM target) + row_number() OVER (ORDER BY s_name) AS s_suppkey FROM fresh"
        ),
        "constraint_violations": (
            "SELECT 'unique(l_orderkey,l_linenumber)' AS \"constraint\", "
            "CAST(to_json({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber}) AS VARCHAR) AS key, "
            "count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
        ),
        "spec_rollup": _rollup_sql("lineitem", "l_suppkey", li_day, "day", li_quartiles),
        "backfill_then_stream": EVENTS_DAY_AND_LAST,
        "day_view_for_id": _rollup_sql(
            "(SELECT * FROM events WHERE user_id = 1)", "user_id", DAY_OF.format(ts="ts"), "day", _full("value")
        ),
        "setup_views_sql": (
            f"WITH d AS ({EVENTS_DAY_ALL}), f AS (SELECT user_id, count(*) AS n_facts FROM events GROUP BY user_id) "
            'SELECT d.user_id, d.day, d.value_count, d.value_avg, d."value_stddevSamp", f.n_facts '
            "FROM d JOIN f ON d.user_id = f.user_id"
        ),
        "spec_persisted_rollup": _rollup_sql("lineitem", "l_suppkey", li_day, "day", li_quartiles),
        "stream_native_window": _rollup_sql(
            "events", "user_id", DAY_OF.format(ts="ts"), "day", _full("value", "quantile_disc")
        ),
        "compacted_facts": (
            "SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
            f"{month} AS yyyymm FROM lineitem"
        ),
        "late_batch_after_compaction": (
            f"WITH d AS ({EVENTS_DAY_ALL}), f AS (SELECT user_id, {DAY_OF.format(ts='ts')} AS day, count(*) AS n_facts "
            "FROM events GROUP BY 1, 2) SELECT d.user_id, d.day, d.value_count, d.value_avg, f.n_facts "
            "FROM d JOIN f ON f.user_id = d.user_id AND f.day = d.day"
        ),
        "backfill_after_compaction": f"SELECT user_id, day, value_count, value_avg FROM ({EVENTS_DAY_ALL})",
        "setup_first_sql_join": (
            f"WITH last AS ({last_events}), f AS (SELECT user_id, count(*) AS n_facts FROM events GROUP BY user_id) "
            "SELECT last.user_id, last.ts, last.value, c.c_name, f.n_facts FROM last "
            "JOIN customer c ON c.c_custkey = last.user_id JOIN f ON f.user_id = last.user_id"
        ),
        "json_several_objects": (
            "WITH d AS (SELECT CAST(user_id AS VARCHAR) AS key, "
            "CASE WHEN event_id % 4 = 2 THEN 'malformed' ELSE 'ok' END AS status, "
            "CASE WHEN event_id % 4 IN (0, 1) THEN 2 ELSE 1 END AS n, "
            "CASE WHEN event_id % 4 IN (0, 1) THEN 2 WHEN event_id % 4 = 3 THEN 1 ELSE 0 END AS ids FROM events) "
            "SELECT key, status, CAST(sum(n) AS BIGINT) AS n, CAST(sum(ids) AS BIGINT) AS n_ids FROM d GROUP BY 1, 2"
        ),
        "bucket_functions": " UNION ALL ".join(
            f"SELECT '{name}' AS name, CAST({expr} AS VARCHAR) AS bucket, count(*) AS n FROM events GROUP BY 2"
            for name, expr in {
                "toDate": "CAST(ts AS DATE)",
                "toStartOfMinute": "strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')",
                "toStartOfHour": "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S')",
                "toStartOfDay": "strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S')",
                "toStartOfWeek": "CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER)",
                "toStartOfMonth": "CAST(date_trunc('month', ts) AS DATE)",
                "toStartOfYear": "CAST(date_trunc('year', ts) AS DATE)",
                "toYYYYMM": "year(ts) * 100 + month(ts)",
            }.items()
        ),
        "facts_filtered": (
            "SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
            f"{month} AS yyyymm FROM lineitem WHERE l_suppkey = 1 "
            "AND l_shipdate >= TIMESTAMP '1996-03-15 00:00:00' AND l_shipdate < TIMESTAMP '1996-07-01 00:00:00'"
        ),
        "view_time_range": _rollup_sql(
            "(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-03-15 00:00:00' AND l_shipdate < TIMESTAMP '1996-07-01 00:00:00')",
            "l_suppkey", li_day, "day", li_multi,
        ),
        "tiered_compaction": (
            f"WITH r AS ({_rollup_sql('lineitem', 'l_suppkey', li_day, 'day', li_multi)}), "
            # Months of the load that no row of the newest days falls into.
            f"old AS (SELECT DISTINCT {month} AS m FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-08-01 00:00:00'), "
            f"new AS (SELECT DISTINCT {month} AS m FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-08-01 00:00:00') "
            "SELECT r.*, CAST((SELECT count(*) FROM old WHERE m NOT IN (SELECT m FROM new)) AS INTEGER) AS months_untouched FROM r"
        ),
        "replayed_batch": (
            "WITH kept AS (SELECT * FROM events WHERE event_id % 8 IN (0, 1, 2)), "
            f"d AS (SELECT user_id, {DAY_OF.format(ts='ts')} AS day, count(value) AS c FROM kept GROUP BY 1, 2) "
            "SELECT user_id, n_facts, facts_newest, n_days, days, facts_newest AS newest FROM "
            "(SELECT user_id, count(*) AS n_facts, max(ts) AS facts_newest FROM kept GROUP BY user_id) f "
            "JOIN (SELECT user_id, CAST(sum(c) AS BIGINT) AS n_days, count(*) AS days FROM d GROUP BY user_id) x USING (user_id)"
        ),
        "evolved_rollup": _rollup_sql("lineitem", "l_suppkey", li_day, "day", [*_full("l_quantity"), *_full("l_tax")]),
        "sketched_quantiles": (
            "SELECT l_returnflag, CAST(date_trunc('year', l_shipdate) AS DATE) AS year, count(l_extendedprice) AS n, "
            "true AS within_p10, true AS within_p50, true AS within_p90 FROM lineitem GROUP BY 1, 2"
        ),
        "named_aggregates": _rollup_sql(
            "events", "user_id", DAY_OF.format(ts="ts"), "day",
            [
                f"{_r6('quantile_cont(value, 0.5)')} AS value_median", f"{_r6('quantile_cont(value, 0.75)')} AS value_quantile_075",
                f"{_r6('min(value)')} AS value_any", f'{_r6("var_pop(value)")} AS "value_varPop"', f'{_r6("stddev_pop(value)")} AS "value_stddevPop"',
            ],
        ),
        "native_windows": " UNION ALL ".join(
            f"SELECT user_id, '{kind}' AS kind, {start} AS bucket, count(value) AS value_count, {_r6('sum(value)')} AS value_sum FROM events GROUP BY 1, 3"
            for kind, start in (
                ("month", "CAST(date_trunc('month', ts) AS DATE)"),
                ("week", "CAST(CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS DATE)"),
            )
        ),
        "all_constraints": (
            "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name, "
            "CASE WHEN c_custkey % 5 = 0 THEN repeat(c_mktsegment, 3) ELSE c_mktsegment END AS c_mktsegment, "
            "CAST(floor(c_custkey / 2) AS BIGINT) AS pair FROM customer) "
            "SELECT 'not_null(c_name)' AS \"constraint\", CAST(to_json({'c_custkey': c_custkey}) AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n FROM c WHERE c_name IS NULL "
            "UNION ALL SELECT 'max_len(c_mktsegment,12)', CAST(to_json({'c_custkey': c_custkey}) AS VARCHAR), 1 FROM c WHERE length(c_mktsegment) > 12 "
            "UNION ALL SELECT 'unique(pair)', CAST(to_json({'pair': pair}) AS VARCHAR), count(*) FROM c GROUP BY pair HAVING count(*) > 1 "
            "UNION ALL SELECT 'unique(c_custkey)', CAST(to_json({'c_custkey': c_custkey}) AS VARCHAR), count(*) FROM c GROUP BY c_custkey HAVING count(*) > 1"
        ),
        "map_ready": (
            f"WITH last AS ({last_events}), "
            "st AS (SELECT c_custkey AS id, c_name AS label, "
            "CAST(57.0 AS DOUBLE) + c_acctbal / CAST(1000.0 AS DOUBLE) AS lat, "
            "CAST(4.0 AS DOUBLE) + c_nationkey * CAST(0.5 AS DOUBLE) AS lon FROM customer) "
            "SELECT last.user_id, last.value, strftime(last.ts, '%Y-%m-%d %H:%M:%S') AS ts, st.label, "
            "round(st.lat, 6) AS lat, round(st.lon, 6) AS lon, round(st.lon, 6) AS geom_x, round(st.lat, 6) AS geom_y, "
            "4326 AS srid, printf('POINT (%.6f %.6f)', st.lon, st.lat) AS wkt, st.label AS category "
            "FROM last JOIN st ON st.id = last.user_id"
        ),
    }
