"""Dimension-table operators: insert-if-absent, surrogate keys, constraint checks, enrichment joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollstate.session import checkpoint_dir

# Upper bounds for broadcasting a dimension: checked on the data, not guessed from statistics.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


# ------------------------------------------------------------------------------- size-checked broadcast


_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row: actual length for strings/binary/nested values, fixed width otherwise."""
    parts = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(8))
        else:
            parts.append(F.lit(_FIXED_WIDTH.get(type(f.dataType), 8)))
    return reduce(lambda a, b: a + b, parts, F.lit(0)).cast("long")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (measured, not estimated).

    One aggregation (row count and summed row bytes) with map-side partial aggregation: no rows
    move, only one partial row per task, whatever the size of ``df``.
    """
    n, size = df.select(F.count(F.lit(1)), F.sum(_row_bytes(df.schema))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Column | str | Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Join with ``small`` broadcast when its size is within bounds; otherwise a shuffle join
    (which AQE may still turn into a broadcast at run time from measured sizes)."""
    side = F.broadcast(small) if fits_broadcast(small, max_rows, max_bytes) else small
    return big.join(side, on, how)


def enrich(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner", **bounds: int
) -> DataFrame:
    """Facts (or a rollup view) × dimension on ``fact_key = dim_key``, all columns of both."""
    return join_small(facts, dim, facts[fact_key] == dim[dim_key], how, **bounds)


# ------------------------------------------------------------------------------- insert-if-absent


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the remaining columns (deterministic).  Built as an
    aggregation, so a key repeated many times is pre-aggregated map-side, never gathered in one task."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def assign_keys(df: DataFrame, order_by: Sequence[str], key: str, start: int = 0) -> DataFrame:
    """Dense surrogate keys ``start+1, start+2, …`` in ``order_by`` order, computed distributed.

    Rows are range-partitioned on the order columns; each partition numbers its own rows and adds
    the row count of all earlier partitions (a table with one row per partition).  The partitioned
    frame is checkpointed first so both uses see the same partition assignment.
    """
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order_by).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    rn = F.row_number().over(Window.partitionBy("_pid").orderBy(*order_by))
    # ``offsets`` has one row per partition: a fixed, small bound.
    return (
        ranged.withColumn("_rn", rn)
        .join(F.broadcast(offsets), "_pid")
        .withColumn(key, (F.lit(int(start)) + F.col("_off") + F.col("_rn")).cast("long"))
        .drop("_pid", "_rn", "_off")
    )


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], id_column: str | None = None
) -> DataFrame:
    """Rows of ``incoming`` to append to ``target`` so the unique ``keys`` stay unique
    (``INSERT … ON CONFLICT DO NOTHING``): duplicates within ``incoming`` keep their first row, rows
    whose key is already in ``target`` are dropped.  With ``id_column``, new rows get surrogate ids
    after the current maximum (``serial``)."""
    fresh = first_per_key(incoming.drop(id_column) if id_column else incoming, keys)
    fresh = fresh.join(target.select(*keys), list(keys), "left_anti")
    if id_column is None:
        return fresh
    start = target.agg(F.max(id_column)).first()[0] or 0
    return assign_keys(fresh, keys, id_column, start)


# ------------------------------------------------------------------------------- constraints


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n`` (UNIQUE / PRIMARY KEY check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def violations(
    df: DataFrame,
    key: Sequence[str],
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    max_len: Mapping[str, int] | None = None,
) -> DataFrame:
    """Every constraint violation as ``constraint, key, n``; ``key`` is the JSON of the offending
    row's ``key`` columns (or of the duplicated columns for a uniqueness violation).

    Row constraints take one scan together; uniqueness takes one more, as grouping sets of one
    aggregation, which pre-aggregates each set of columns before the shuffle.
    """
    key_json = F.to_json(F.struct(*[F.col(k) for k in key]))

    def entry(broken: Column, constraint: str) -> Column:
        one = F.lit(1).cast("long").alias("n")
        return F.when(broken, F.struct(F.lit(constraint).alias("constraint"), key_json.alias("key"), one))

    parts = []
    broken = [(F.col(c).isNull(), f"not_null({c})") for c in not_null]
    broken += [(F.length(c) > n, f"max_len({c},{n})") for c, n in (max_len or {}).items()]
    if broken:
        offences = F.filter(F.array(*[entry(b, c) for b, c in broken]), lambda e: e.isNotNull())
        parts.append(df.where(reduce(lambda a, b: a | b, [b for b, _ in broken])).select(F.explode(offences).alias("_e")).select("_e.*"))
    if unique:
        columns = list(dict.fromkeys(c for cols in unique for c in cols))
        grouped = df.groupingSets([[F.col(c) for c in cols] for cols in unique], *[F.col(c) for c in columns])
        repeated = grouped.agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set")).where(F.col("n") > 1)
        name, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        for cols in unique:
            mine = F.col("_set") == sum(1 << i for i, c in enumerate(reversed(columns)) if c not in cols)
            name = F.when(mine, F.lit(f"unique({','.join(cols)})")).otherwise(name)
            text = F.when(mine, F.to_json(F.struct(*cols))).otherwise(text)
        parts.append(repeated.select(name.alias("constraint"), text.alias("key"), "n"))
    if not parts:
        return df.sparkSession.createDataFrame([], "constraint string, key string, n long")
    return reduce(DataFrame.unionByName, parts)


def checked_insert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    id_column: str | None = None,
    not_null: Sequence[str] = (),
    max_len: Mapping[str, int] | None = None,
) -> DataFrame:
    """``insert_if_absent`` that raises when the new rows break NOT NULL / length constraints."""
    new = insert_if_absent(target, incoming, keys, id_column)
    bad = violations(new, keys, not_null=not_null, max_len=max_len)
    found = bad.limit(5).collect()
    if found:
        raise ValueError(f"constraint violations: {[r.asDict() for r in found]}")
    return new
