"""Dimension operators: insert-if-absent, keys, constraints, enrichment joins, geometry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shared import SF_SMALL
from rollstate.functions import geo
from rollstate.operators import dims

STATIONS = "id long, label string, lat double, lon double"


def test_insert_if_absent_assigns_dense_keys(spark):
    target = spark.createDataFrame([(1, "Oslo", 59.9, 10.7), (2, "Bergen", 60.4, 5.3)], STATIONS)
    incoming = spark.createDataFrame(
        [(None, "Bergen", 1.0, 1.0), (None, "Tønsberg", 59.3, 10.4), (None, "Ålesund", 62.5, 6.2), (None, "Ålesund", 62.5, 6.2)],
        STATIONS,
    )
    new = dims.insert_if_absent(target, incoming, ["label"], id_column="id").collect()
    got = sorted((r.id, r.label) for r in new)
    assert got == [(3, "Tønsberg"), (4, "Ålesund")]
    assert dims.insert_if_absent(target, target, ["label"]).count() == 0


def test_assign_keys_across_many_partitions(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", "id").alias("name")).repartition(13)
    out = dims.assign_keys(df, ["name"], "key", start=100).collect()
    keys = sorted(r.key for r in out)
    assert keys == list(range(101, 5101))
    assert all(r.key == 101 + int(r.name[1:]) for r in out)


def test_violations(spark):
    df = spark.createDataFrame(
        [(1, "a", "x" * 300), (2, None, "ok"), (2, "b", "ok"), (3, "c", "ok")], "id long, name string, note string"
    )
    v = {(r.constraint, r.key, r.n) for r in dims.violations(df, ["id"], not_null=["name"], unique=[["id"]], max_len={"note": 255}).collect()}
    assert v == {("not_null(name)", '{"id":2}', 1), ("unique(id)", '{"id":2}', 2), ("max_len(note,255)", '{"id":1}', 1)}


def test_enrich_broadcasts_checked_small_side(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sup = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    j = dims.enrich(ev, sup, "user_id", "s_suppkey")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert j.count() == ev.join(sup, ev.user_id == sup.s_suppkey).count()
    # over the bound: no broadcast hint (the planner / AQE decide on measured sizes)
    assert not dims.fits_broadcast(sup, max_rows=3)
    assert not dims.fits_broadcast(sup, max_bytes=10)


def test_geometry_and_map_ready(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 2, 3, 4, 5, 678), 4.5, "Tønsberg", 59.2675, 10.4076)],
        "sensor long, taken_at timestamp_ntz, v double, label string, lat double, lon double",
    )
    r = geo.map_ready(df, "taken_at").first()
    assert r.taken_at == "2024-01-02 03:04:05"
    assert (r.geometry.x, r.geometry.y, r.geometry.srid) == (10.4076, 59.2675, 4326)
    assert r.wkt == "POINT (10.407600 59.267500)"
    assert r.category == "Tønsberg"
    feat = df.select(geo.geojson_feature("lon", "lat", ["label"]).alias("f")).first().f
    assert feat == '{"type":"Feature","geometry":{"type":"Point","coordinates":[10.4076,59.2675]},"properties":{"label":"Tønsberg"}}'


def test_engine_map_view(spark, tmp_root):
    from rollstate import Engine, catalog

    e = Engine(spark, catalog.EVENTS_LAST_SPEC, tmp_root)
    rows = [(1, dt.datetime(2024, 1, 2, 3, 4, 5), 4.5), (1, dt.datetime(2024, 1, 1), 1.0), (2, dt.datetime(2024, 1, 1), 2.0)]
    e.ingest(spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, value double"), "events", "s", 0)
    dim = spark.createDataFrame([(1, "Tønsberg", 59.2675, 10.4076)], STATIONS)
    r = e.map_view("events_last", dim, "id").collect()
    assert [(x.user_id, x.value, x.ts, x.wkt, x.category) for x in r] == [
        (1, 4.5, "2024-01-02 03:04:05", "POINT (10.407600 59.267500)", "Tønsberg")
    ]
