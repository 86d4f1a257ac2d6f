"""Declarative table / rollup specification.

A spec is the same dict shape a YAML or JSON file produces::

    tables:
      - name, id_column{name,type[,codec]}, ts_column{...}, columns[...], kafka_topic (optional, may be null)
    analytical_tables:
      - table: <table name>
        aggregator: {type: last [, tiebreak: [col...]]}
                  | {type: interval, name, group_functions: [...], aggregations: [{type, args_agg, args_func, columns, k, exact}]}

Parsing is pure (the input dict is never mutated) and validates everything up front: unknown types,
aggregators, aggregation functions, bucket functions, table references and duplicate column names
raise ``SpecError`` at load time.  Names are data and never become SQL text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from rollstate.functions.naming import slugify


class SpecError(ValueError):
    """Raised for any invalid spec."""


# The declared type names of the spec and the Spark type each maps to; unsigned numbers
# take the next wider signed type.  Matched case-insensitively (the spec spells both Datetime64 and DateTime64).
_SCALAR_TYPES = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "uuid": T.StringType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
}
_DATETIME64 = re.compile(r"^datetime64\(\s*(\d)\s*\)$", re.IGNORECASE)
_DECIMAL = re.compile(r"^decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)$", re.IGNORECASE)
_WRAPPED = re.compile(r"^(?:nullable|lowcardinality)\((.*)\)$", re.IGNORECASE)
#: Types an id may have: anything that groups, sorts and has a text form that names it.
_ID_TYPES = (T.IntegralType, T.StringType, T.DateType)


def spark_type(type_name: str) -> T.DataType:
    """Map a declared column type to a Spark type.

    ``DateTime64(p)`` becomes ``TIMESTAMP_NTZ``: a zone-less wall-clock instant kept at microsecond
    precision (p ≤ 6); the session time zone never shifts it.  Every column may be NULL, so
    ``Nullable(…)`` changes nothing, nor does ``LowCardinality(…)`` (Parquet encodes it by itself).
    """
    if not isinstance(type_name, str):
        raise SpecError(f"column type must be a string, got {type_name!r}")
    key = type_name.strip().lower()
    if key in _SCALAR_TYPES:
        return _SCALAR_TYPES[key]
    if m := _WRAPPED.match(key):
        return spark_type(m.group(1))
    if m := _DECIMAL.match(key):
        precision, scale = int(m.group(1)), int(m.group(2))
        if not 1 <= precision <= 38 or scale > precision:
            raise SpecError(f"{type_name}: decimals have 1 to 38 digits, of which the scale")
        return T.DecimalType(precision, scale)
    m = _DATETIME64.match(key)
    if m:
        if int(m.group(1)) > 6:
            raise SpecError(f"{type_name}: precision above microseconds is not supported")
        return T.TimestampNTZType()
    raise SpecError(f"unknown column type {type_name!r}")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    codec: tuple[str, ...] | None = None  # accepted, not modelled: Parquet files use zstd throughout

    @property
    def dtype(self) -> T.DataType:
        return spark_type(self.type)

    @staticmethod
    def parse(d: Mapping) -> "Column":
        _check_keys(d, {"name", "type"}, {"codec"}, "column")
        if not isinstance(d["name"], str) or not d["name"]:
            raise SpecError(f"column name must be a non-empty string: {d!r}")
        spark_type(d["type"])  # validate
        codec = d.get("codec")
        if isinstance(codec, str):
            codec = tuple(c.strip() for c in codec.split(",") if c.strip())
        elif codec is not None:
            codec = tuple(codec)
        return Column(d["name"], d["type"], codec)


@dataclass(frozen=True)
class Table:
    name: str
    id_column: Column
    ts_column: Column
    columns: tuple[Column, ...]
    kafka_topic: str | None = None
    kafka_bootstrap_host: str | None = None  # brokers of this table's topic; None: those of the stream

    @property
    def id(self) -> str:
        return self.id_column.name

    @property
    def ts(self) -> str:
        return self.ts_column.name

    @property
    def measures(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def all_columns(self) -> list[Column]:
        return [self.id_column, self.ts_column, *self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.all_columns])

    @property
    def streamed(self) -> bool:
        """A table without a topic is batch-only: no stream half is built for it."""
        return self.kafka_topic is not None

    @staticmethod
    def parse(d: Mapping) -> "Table":
        _check_keys(d, {"name", "id_column", "ts_column", "columns"}, {"kafka_topic", "kafka_bootstrap_host"}, "table")
        t = Table(
            name=d["name"],
            id_column=Column.parse(d["id_column"]),
            ts_column=Column.parse(d["ts_column"]),
            columns=tuple(Column.parse(c) for c in d["columns"]),
            kafka_topic=d.get("kafka_topic"),
            kafka_bootstrap_host=d.get("kafka_bootstrap_host"),
        )
        names = [c.name for c in t.all_columns]
        dupes = sorted({n for n in names if names.count(n) > 1})
        if dupes:
            raise SpecError(f"table {t.name!r}: duplicate column names {dupes}")
        if not isinstance(t.id_column.dtype, _ID_TYPES):
            raise SpecError(f"table {t.name!r}: id column must be a whole number, a text or a date, not {t.id_column.type}")
        if not isinstance(t.ts_column.dtype, T.TimestampNTZType):
            raise SpecError(f"table {t.name!r}: time column must be DateTime or DateTime64")
        if t.kafka_bootstrap_host is not None and (not isinstance(t.kafka_bootstrap_host, str) or not t.kafka_bootstrap_host):
            raise SpecError(f"table {t.name!r}: kafka_bootstrap_host must be an address")
        return t


@dataclass(frozen=True)
class Aggregation:
    """One aggregate function applied to every measure (or to ``columns`` when given)."""

    type: str
    args_agg: tuple[str, ...] = ()
    args_func: tuple[str, ...] = ()
    columns: tuple[str, ...] | None = None
    k: int | None = None  # quantiles: size parameter of a sketch
    exact: int | None = None  # quantiles: values that a group's state keeps as they are

    def slug(self) -> str:
        return slugify("_".join([self.type, *self.args_agg, *self.args_func]))

    @staticmethod
    def parse(d: Mapping) -> "Aggregation":
        from rollstate.operators import aggs  # registry lives with the operators

        _check_keys(d, {"type"}, {"args_agg", "args_func", "columns", "k", "exact"}, "aggregation")
        a = Aggregation(
            type=d["type"],
            args_agg=tuple(str(x) for x in (d.get("args_agg") or ())),
            args_func=tuple(d.get("args_func") or ()),
            columns=tuple(d["columns"]) if d.get("columns") is not None else None,
            k=d.get("k"),
            exact=d.get("exact"),
        )
        aggs.validate(a)
        return a


@dataclass(frozen=True)
class LastAggregator:
    """Newest row per id: the time and every measure of one coherent row."""

    tiebreak: tuple[str, ...] = ()
    name: str = "last"

    @staticmethod
    def parse(d: Mapping) -> "LastAggregator":
        _check_keys(d, {"type"}, {"tiebreak"}, "last aggregator")
        return LastAggregator(tiebreak=tuple(d.get("tiebreak") or ()))


@dataclass(frozen=True)
class IntervalAggregator:
    """Per (id, time bucket): every aggregation of every measure."""

    name: str
    group_functions: tuple[str, ...]
    aggregations: tuple[Aggregation, ...]

    @staticmethod
    def parse(d: Mapping) -> "IntervalAggregator":
        from rollstate.functions import timefn

        _check_keys(d, {"type", "name", "group_functions", "aggregations"}, set(), "interval aggregator")
        if not d["aggregations"]:
            raise SpecError("interval aggregator needs at least one aggregation")
        gf = tuple(d["group_functions"])
        for f in gf:
            if f not in timefn.BUCKET_FUNCTIONS:
                raise SpecError(f"unknown bucket function {f!r}")
        return IntervalAggregator(
            name=d["name"], group_functions=gf, aggregations=tuple(Aggregation.parse(a) for a in d["aggregations"])
        )


Aggregator = LastAggregator | IntervalAggregator


@dataclass(frozen=True)
class AnalyticalTable:
    table: Table
    aggregator: Aggregator

    @property
    def name(self) -> str:
        """Relation name ``<table>_<aggregator name>``."""
        return f"{self.table.name}_{self.aggregator.name}"

    @property
    def keys(self) -> list[str]:
        if isinstance(self.aggregator, LastAggregator):
            return [self.table.id]
        return [self.table.id, self.aggregator.name]


@dataclass(frozen=True)
class Spec:
    tables: tuple[Table, ...]
    analytical_tables: tuple[AnalyticalTable, ...] = field(default=())

    def table(self, name: str) -> Table:
        for t in self.tables:
            if t.name == name:
                return t
        raise SpecError(f"unknown table {name!r}")

    def rollup(self, name: str) -> AnalyticalTable:
        for a in self.analytical_tables:
            if a.name == name:
                return a
        raise SpecError(f"unknown analytical table {name!r}")

    def rollups_of(self, table: str) -> list[AnalyticalTable]:
        return [a for a in self.analytical_tables if a.table.name == table]


def parse_aggregator(d: Mapping) -> Aggregator:
    if not isinstance(d, Mapping) or "type" not in d:
        raise SpecError(f"aggregator needs a type: {d!r}")
    if d["type"] == "last":
        return LastAggregator.parse(d)
    if d["type"] == "interval":
        return IntervalAggregator.parse(d)
    raise SpecError(f"unknown aggregator type {d['type']!r}")


def load_spec(d: Mapping) -> Spec:
    """Parse and validate a spec dict (from YAML or JSON). The input is left unchanged."""
    _check_keys(d, {"tables"}, {"analytical_tables"}, "spec")
    tables = tuple(Table.parse(t) for t in d["tables"])
    by_name: dict[str, Table] = {}
    for t in tables:
        if t.name in by_name:
            raise SpecError(f"duplicate table name {t.name!r}")
        by_name[t.name] = t
    ats = []
    for a in d.get("analytical_tables") or ():
        _check_keys(a, {"table", "aggregator"}, set(), "analytical table")
        if a["table"] not in by_name:
            raise SpecError(f"analytical table refers to unknown table {a['table']!r}")
        table = by_name[a["table"]]
        agg = parse_aggregator(a["aggregator"])
        _check_rollup_columns(table, agg)
        ats.append(AnalyticalTable(table, agg))
    names = [a.name for a in ats]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise SpecError(f"duplicate analytical table names {dupes}")
    return Spec(tables, tuple(ats))


def load_spec_file(path: str) -> Spec:
    """Load a spec from a ``.json`` file, or from YAML when PyYAML is installed (driver-side, small)."""
    import json

    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.lower().endswith(".json"):
        return load_spec(json.loads(text))
    try:
        import yaml
    except ImportError as e:  # YAML support is optional
        raise SpecError(f"{path}: reading YAML needs PyYAML; use a .json spec instead") from e
    return load_spec(yaml.safe_load(text))


def _check_rollup_columns(table: Table, agg: Aggregator) -> None:
    known = {c.name for c in table.all_columns}
    if isinstance(agg, LastAggregator):
        bad = [c for c in agg.tiebreak if c not in known]
        if bad:
            raise SpecError(f"{table.name}: unknown tiebreak columns {bad}")
        return
    if agg.name in known:
        raise SpecError(f"{table.name}: bucket name {agg.name!r} collides with a column")
    for a in agg.aggregations:
        bad = [c for c in (*a.args_func, *(a.columns or ())) if c not in known]
        if bad:
            raise SpecError(f"{table.name}: aggregation {a.type} refers to unknown columns {bad}")


def _check_keys(d: Mapping, required: set[str], optional: set[str], what: str) -> None:
    if not isinstance(d, Mapping):
        raise SpecError(f"{what} must be a mapping, got {type(d).__name__}")
    missing = required - d.keys()
    if missing:
        raise SpecError(f"{what}: missing keys {sorted(missing)}")
    extra = d.keys() - required - optional
    if extra:
        raise SpecError(f"{what}: unknown keys {sorted(extra)}")
