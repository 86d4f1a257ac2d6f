"""JSON message decode cases and the key/value encoder."""

from __future__ import annotations

import datetime as dt

import pytest

from shared import SF_SMALL, as_set
from rollstate import catalog
from rollstate.sources import codec
from rollstate.spec import load_spec

T = load_spec(
    {
        "tables": [
            {
                "name": "obs",
                "id_column": {"name": "sensor", "type": "Int64"},
                "ts_column": {"name": "taken_at", "type": "Datetime64(6)"},
                "columns": [{"name": "humidity", "type": "Float64"}, {"name": "pressure", "type": "Float64"}],
            }
        ]
    }
).tables[0]


def _decode(spark, messages, **kw):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    return codec.decode(df, T, **kw).collect()


def test_decode_cases(spark):
    rows = _decode(
        spark,
        [
            '{"sensor": 1, "taken_at": "2023-06-01T12:00:00.123456", "humidity": 0.5, "pressure": 1000.5}',
            '{"sensor": 2, "taken_at": "2023-06-01T12:00:00", "humidity": 1, "pressure": 990}',
            '{"sensor": 3, "taken_at": "2023-06-01T12:00:00", "humidity": 0.2}',
            '{"sensor": "x", "taken_at": "2023-06-01T12:00:00", "humidity": 0.2}',
            '{"sensor": 4, "taken_at": "2023-06-01T12:00',
            "not json",
            '{"sensor": 5, "taken_at": "2023-06-01T12:00:00", "humidity": 0.1, "pressure": 1, "extra": [1]}',
            '{"taken_at": "2023-06-01T12:00:00", "humidity": 0.1}',
            '{"sensor": 6, "humidity": 0.1}',
        ],
    )
    by_reason = [r.reject_reason for r in rows]
    assert by_reason == [None, None, None, "malformed", "malformed", "malformed", None, "missing id", "missing time"]
    assert rows[0].taken_at == dt.datetime(2023, 6, 1, 12, 0, 0, 123456)  # µs kept
    assert rows[1].humidity == 1.0  # integer for a double field is cast
    assert rows[2].pressure is None  # missing measure
    assert rows[6].sensor == 5  # unknown field ignored
    assert rows[3]._corrupt_record.startswith('{"sensor": "x"')


def test_fill_missing(spark):
    rows = _decode(spark, ['{"sensor": 3, "taken_at": "2023-06-01T12:00:00", "humidity": 0.2}'], fill_missing=True)
    assert rows[0].pressure == 0.0


def test_max_bad(spark):
    df = spark.createDataFrame([("{}",), ("nope",), ('{"sensor": 1, "taken_at": "2023-06-01T12:00:00"}',)], "value string")
    d = codec.decode(df, T)
    assert codec.check_rejects(d, 2) == 2
    with pytest.raises(codec.TooManyRejects):
        codec.check_rejects(d, 1)
    with pytest.raises(codec.TooManyRejects):
        codec.check_rejects(d, 0)
    assert codec.check_rejects(d, None) == -1


def test_binary_value_is_accepted(spark):
    df = spark.createDataFrame(
        [(bytearray(b'{"sensor": 9, "taken_at": "2023-06-01T12:00:00"}'),)], "value binary"
    )
    assert codec.good(codec.decode(df, T), T).first().sensor == 9


def test_roundtrip_keeps_microseconds(spark):
    t = load_spec({"tables": [catalog.EVENTS_WIRE_TABLE]}).tables[0]
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    msgs = codec.encode(ev, t)
    assert msgs.columns == ["key", "value"]
    first = msgs.first()
    assert first.value.count(".") >= 1 and '"ts":"' in first.value
    back = codec.good(codec.decode(msgs, t), t)
    cols = [c.name for c in t.all_columns]
    assert as_set(back.collect()) == as_set(ev.select(*cols).collect())
    assert msgs.where("key <> cast(get_json_object(value, '$.user_id') as string)").count() == 0


def test_several_objects_in_a_message(spark):
    one = '{"sensor": 1, "taken_at": "2023-06-01T12:00:00", "humidity": 0.1}'
    two = '{"sensor": 2, "taken_at": "2023-06-01T12:00:00", "humidity": 0.2}'
    for text in (f"{one}\n{two}", f"{one}\r\n \n{two}\n", f"[{one}, {two}]"):
        rows = _decode(spark, [text])
        assert [(r.sensor, r.reject_reason) for r in rows] == [(1, None), (2, None)]
    for text in (f"{one} garbage", f"{one}{two}", f"{one}\nnot json", f"[{one}", "", "[]", None):
        rows = _decode(spark, [text])
        assert [r.reject_reason for r in rows] == ["malformed"], text
    rows = _decode(spark, [f'[{one}, {{"sensor": "x"}}]'])
    assert [r.reject_reason for r in rows] == [None, "malformed"]


def test_fill_missing_by_type_and_key(spark):
    t = load_spec(
        {
            "tables": [
                {
                    "name": "obs",
                    "id_column": {"name": "id", "type": "Int64"},
                    "ts_column": {"name": "at", "type": "DateTime64(6)"},
                    "columns": [{"name": n, "type": k} for n, k in (("s", "String"), ("d", "Date"), ("n", "Int64"), ("m", "DateTime64(3)"))],
                }
            ]
        }
    ).tables[0]
    df = spark.createDataFrame([("k", '{"id": 1, "at": "2024-01-01T00:00:00"}')], "key string, value string")
    r = codec.decode(df, t, fill_missing=True).first()
    assert (r.key, r.s, r.d, r.n, r.m) == ("k", "", dt.date(1970, 1, 1), 0, dt.datetime(1970, 1, 1))
