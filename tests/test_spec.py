"""Spec loading and validation: every key, names and types, and the error cases."""

from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import types as T

from rollstate.functions.naming import slugify
from rollstate.spec import IntervalAggregator, LastAggregator, SpecError, load_spec

# A power plant's meters: own names and shapes, for every key a spec may use.
GRID = {
    "tables": [
        {
            "name": "meterReading",
            "id_column": {"name": "meter", "type": "Int64"},
            "ts_column": {"name": "read_at", "type": "Datetime64(6)", "codec": ["LZ4"]},
            "columns": [
                {"name": "volts", "type": "Float64"},
                {"name": "amps", "type": "Float64", "codec": "Gorilla, LZ4"},
                {"name": "pulses", "type": "Int64"},
            ],
            "kafka_topic": "grid.readings",
        }
    ],
    "analytical_tables": [
        {"table": "meterReading", "aggregator": {"type": "last"}},
        {
            "table": "meterReading",
            "aggregator": {
                "type": "interval",
                "name": "month",
                "group_functions": ["toYYYYMM"],
                "aggregations": [{"type": "max"}, {"type": "quantiles", "args_agg": ["0.25", "0.75"]}],
            },
        },
    ],
}

# A till whose time column has the id's name by mistake.
TILL = """
{"tables": [{"name": "till sales", "id_column": {"name": "till", "type": "Int64"},
             "ts_column": {"name": "till", "type": "Datetime64(3)"},
             "columns": [{"name": "total", "type": "Float64"}]}],
 "analytical_tables": [{"table": "till sales", "aggregator": {"type": "interval", "name": "hour",
                        "group_functions": ["toStartOfHour"], "aggregations": [{"type": "sum"}]}}]}
"""


def test_spec_loads_and_names():
    spec = load_spec(GRID)
    t = spec.table("meterReading")
    assert t.id == "meter" and t.ts == "read_at" and t.measures == ["volts", "amps", "pulses"]
    assert isinstance(t.schema["read_at"].dataType, T.TimestampNTZType)
    assert t.columns[1].codec == ("Gorilla", "LZ4")
    assert [a.name for a in spec.analytical_tables] == ["meterReading_last", "meterReading_month"]
    month = spec.rollup("meterReading_month").aggregator
    assert isinstance(month, IntervalAggregator)
    assert [a.slug() for a in month.aggregations] == ["max", "quantiles_025_075"]
    assert t.streamed


def test_input_dict_unchanged():
    before = copy.deepcopy(GRID)
    load_spec(GRID)
    assert GRID == before


def test_duplicate_column_rejected_then_accepted():
    d = json.loads(TILL)
    with pytest.raises(SpecError, match="duplicate column"):
        load_spec(d)
    d["tables"][0]["ts_column"]["name"] = "sold_at"
    spec = load_spec(d)
    assert spec.table("till sales").ts == "sold_at" and not spec.table("till sales").streamed
    assert spec.rollup("till sales_hour").aggregator.aggregations[0].slug() == "sum"


def test_type_names_case_insensitive():
    d = json.loads(TILL)
    d["tables"][0]["ts_column"] = {"name": "sold_at", "type": "DATETIME64(6)"}
    assert isinstance(load_spec(d).table("till sales").schema["sold_at"].dataType, T.TimestampNTZType)


def test_batch_only_table():
    d = copy.deepcopy(GRID)
    d["tables"][0]["kafka_topic"] = None
    assert not load_spec(d).tables[0].streamed
    del d["tables"][0]["kafka_topic"]
    assert not load_spec(d).tables[0].streamed


@pytest.mark.parametrize(
    "path, value, match",
    [
        (("analytical_tables", 1, "aggregator", "type"), "sliding", "unknown aggregator"),
        (("analytical_tables", 1, "aggregator", "aggregations", 0, "type"), "mode", "unknown aggregation"),
        (("analytical_tables", 1, "aggregator", "group_functions", 0), "toFortnight", "unknown bucket"),
        (("tables", 0, "columns", 0, "type"), "Tuple(9,2)", "unknown column type"),
        (("analytical_tables", 0, "table"), "nope", "unknown table"),
        (("analytical_tables", 1, "aggregator", "aggregations", 1, "args_agg"), ["1.5"], r"\[0, 1\]"),
        (("analytical_tables", 1, "aggregator", "aggregations", 1, "args_agg"), None, "needs quantile levels"),
    ],
)
def test_bad_specs(path, value, match):
    d = copy.deepcopy(GRID)
    node = d
    for p in path[:-1]:
        node = node[p]
    node[path[-1]] = value
    with pytest.raises(SpecError, match=match):
        load_spec(d)


def test_extra_args_aggregation():
    d = copy.deepcopy(GRID)
    d["analytical_tables"][1]["aggregator"]["aggregations"] = [{"type": "argMax", "args_func": ["read_at"]}]
    agg = load_spec(d).rollup("meterReading_month").aggregator
    assert agg.aggregations[0].slug() == slugify("argMax_read_at")
    d["analytical_tables"][1]["aggregator"]["aggregations"] = [{"type": "argMax"}]
    with pytest.raises(SpecError, match="extra column"):
        load_spec(d)


def test_last_aggregator_name_is_fixed():
    spec = load_spec(GRID)
    assert isinstance(spec.rollup("meterReading_last").aggregator, LastAggregator)


@pytest.mark.parametrize(
    "text, slug",
    [
        ("quantiles_0.1_0.5_0.9", "quantiles_01_05_09"),
        ("avg", "avg"),
        ("a b-c,d.e", "abcde"),
        ("Tønsberg_Ålesund", "Tønsberg_Ålesund"),
        ("x[1]^{2}~", "x[1]^{2}~"),
        ("æøå!?", "æøå"),
    ],
)
def test_slug(text, slug):
    assert slugify(text) == slug


def test_load_spec_file_yaml_and_json(tmp_path):
    import yaml

    from rollstate.spec import load_spec_file

    y = tmp_path / "spec.yaml"
    y.write_text(yaml.safe_dump(GRID))
    j = tmp_path / "spec.json"
    j.write_text(json.dumps(GRID))
    assert load_spec_file(str(y)) == load_spec_file(str(j)) == load_spec(GRID)
