"""Fact rows: the declared schema, literal rows, time ranges and id filters.

Facts are stored by month (``yyyymm``), sorted by ``(id, ts)`` (``plans.part_store``): time ranges prune
months, and Parquet's statistics skip row groups for id and time predicates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollstate.functions.timefn import as_time, month_range
from rollstate.spec import Table

MONTH = "yyyymm"
SOURCE = "source_id"
BATCH = "batch_id"


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Select the table's columns in declared order, cast to the declared types."""
    return df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in table.all_columns])


def read_declared(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """Read any Parquet data holding the table's columns with the declared schema (never inferred);
    the reader prunes to exactly those columns."""
    return spark.read.schema(table.schema).parquet(path)


def literal_rows(spark: SparkSession, table: Table, rows: list[tuple]) -> DataFrame:
    """Inline rows (id, ts, measures… in declared order) as a DataFrame of the declared schema."""
    return spark.createDataFrame(rows, table.schema)


def time_range(
    df: DataFrame,
    table: Table,
    lo: dt.datetime | dt.date | str | None = None,
    hi: dt.datetime | dt.date | str | None = None,
) -> DataFrame:
    """Rows with ``lo <= ts < hi`` (a date bound is its midnight), plus the implied ``yyyymm`` bounds so whole months are pruned.

    Spark does not derive a partition predicate from a predicate on the time column, so both are
    added here; the time predicate itself also reaches the Parquet reader as a pushed filter.
    """
    cond, months = F.lit(True), month_range(lo, hi)
    if lo is not None:
        cond = cond & (F.col(f"`{table.ts}`") >= _lit_ts(lo, table)) & (F.col(MONTH) >= months[0])
    if hi is not None:
        cond = cond & (F.col(f"`{table.ts}`") < _lit_ts(hi, table)) & (F.col(MONTH) <= months[1])
    return df.where(cond)


def for_id(df: DataFrame, table: Table, value: int | str) -> DataFrame:
    """Equality filter on the id, applied before any action so it reaches the Parquet scan."""
    return df.where(F.col(f"`{table.id}`") == F.lit(value).cast(table.id_column.dtype))


def _lit_ts(v: dt.datetime | dt.date | str, table: Table):
    """A zone-less literal of the time column's type (from text, so no time zone is involved)."""
    text = v if isinstance(v, str) else as_time(v).isoformat(sep=" ")
    return F.lit(text).cast(table.ts_column.dtype)
