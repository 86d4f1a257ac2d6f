"""Rollups: last value per id and interval (time-bucket) aggregates, one-pass and as partial states.

* one-pass: ``last(df, table)`` / ``interval(df, table, agg)`` over a fact DataFrame.
* persisted: ``partial(df, at)`` aggregates any slice of facts (a micro-batch, a backfill) into state
  rows keyed like the rollup; ``merge(states, at)`` folds state rows with equal keys into one (used
  by compaction, result is again a state table); ``finish(states, at)`` turns merged states into the
  user-facing columns.  ``view(states, at) = finish(merge(states, at))``.

Every function is one ``groupBy(keys).agg(...)``: all measures × aggregations in one pass and one
shuffle, with Catalyst's map-side partial aggregation, so a hot key reaches the final aggregation as
one partial row per map task rather than as its raw rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollstate.functions import timefn
from rollstate.operators import aggs, quantiles
from rollstate.operators.dims import fits_broadcast
from rollstate.session import checkpoint_dir
from rollstate.spec import AnalyticalTable, IntervalAggregator, LastAggregator, Table

LAST_STATE = "_last"


# --------------------------------------------------------------------------------------------- last


def _last_order(table: Table, tiebreak: tuple[str, ...]) -> list[str]:
    """Struct field order for the newest-row comparison: time, tie-break columns, then measures."""
    rest = [m for m in table.measures if m not in tiebreak]
    return [table.ts, *[c for c in tiebreak if c != table.ts], *rest]


def _last_struct(table: Table, tiebreak: tuple[str, ...]) -> Column:
    # Rows without a time never become the last value.
    return F.when(F.col(table.ts).isNotNull(), F.struct(*[F.col(c) for c in _last_order(table, tiebreak)]))


def _last_columns(table: Table, s: Column) -> list[Column]:
    return [s[table.ts].alias(table.ts), *[s[m].alias(m) for m in table.measures]]


def last(df: DataFrame, table: Table, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Newest row per id: ``id, ts, measures…`` taken from one row.

    The newest row is the maximum of ``struct(ts, tiebreak…, measures…)``, so equal times are broken by
    the given columns and then by the measures: the result is deterministic and never mixes values of
    different rows.  NULL sorts lowest, so a NULL measure loses a tie.

    Spark sorts every task's rows to take the maximum of a struct.  So the newest time of each id is
    found first, by hashing, and while these fit a broadcast (measured) only the rows at that time
    reach the struct; beyond, all rows do.
    """
    ident = F.col(f"`{table.id}`")
    checkpoint_dir(df.sparkSession)
    newest = df.groupBy(ident.alias("_id")).agg(F.max(f"`{table.ts}`").alias("_ts")).checkpoint(eager=True)
    rows = df
    if fits_broadcast(newest):
        same = ident.eqNullSafe(F.col("_id")) & (F.col(f"`{table.ts}`") == F.col("_ts"))
        # Ids without any time have a row too, with NULLs.
        without = newest.where(F.col("_ts").isNull()).select(F.col("_id").alias(table.id))
        rows = df.join(F.broadcast(newest), same, "left_semi").unionByName(without, allowMissingColumns=True)
    s = F.max(_last_struct(table, tiebreak)).alias(LAST_STATE)
    return rows.groupBy(ident).agg(s).select(ident, *_last_columns(table, F.col(LAST_STATE)))


# ----------------------------------------------------------------------------------------- interval


def output_specs(table: Table, agg: IntervalAggregator) -> list[tuple[str, str, aggs.Aggregation]]:
    """(output column, input column, aggregation) in output order: column-major, like the spec's fan-out."""
    cols = [c.name for c in table.all_columns]
    ordered = [*table.measures, *[c for c in cols if c not in table.measures]]
    out = []
    for c in ordered:
        for a in agg.aggregations:
            if c in aggs.targets([c], table.measures, a):
                out.append((f"{c}_{a.slug()}", c, a))
    return out


def interval(
    df: DataFrame,
    table: Table,
    agg: IntervalAggregator,
    hot_rows: int = quantiles.HOT_GROUP_ROWS,
    partition_rows: int = quantiles.PARTITION_ROWS,
) -> DataFrame:
    """One-pass rollup per (id, bucket): every aggregation of every measure.

    Without quantiles this is one aggregation (one shuffle, map-side partial aggregation).  Exact
    quantiles are rank selections (``operators.quantiles``): ordinary groups are ranked by a window
    and aggregated in the same shuffle; groups above ``hot_rows`` rows take a distributed path.
    """
    specs = output_specs(table, agg)
    keys = [table.id, agg.name]
    keyed = df.withColumn(agg.name, timefn.bucket(table.ts, agg.group_functions))
    q_specs = [(name, c, aggs.probs_of(a)) for name, c, a in specs if aggs.get(a.type).takes_probs]
    others = [(name, aggs.one_pass(a, F.col(c))) for name, c, a in specs if not aggs.get(a.type).takes_probs]
    if not q_specs:
        return keyed.groupBy(*keys).agg(*[c.alias(n) for n, c in others])
    out = quantiles.exact(keyed, keys, q_specs, others, hot_rows, partition_rows)
    return out.select(*keys, *[_one_level(F.col(f"`{name}`"), a).alias(name) for name, _, a in specs])


def _one_level(levels: Column, a: aggs.Aggregation) -> Column:
    return F.get(levels, F.lit(0)) if aggs.get(a.type).scalar else levels


# ------------------------------------------------------------------------------------------- states


def state_columns(at: AnalyticalTable) -> list[str]:
    if isinstance(at.aggregator, LastAggregator):
        return [LAST_STATE]
    return [f"{name}_state" for name, _, _ in output_specs(at.table, at.aggregator)]


def _sketch_size(a: aggs.Aggregation) -> int:
    return a.k or aggs.DEFAULT_K


def _bound(specs: list) -> int:
    """Values that a quantile state keeps: the largest of the rollup's bounds."""
    given = [a.exact for _, _, a in specs if aggs.get(a.type).takes_probs]
    return max(aggs.DEFAULT_EXACT if e is None else e for e in given)


def partial(df: DataFrame, at: AnalyticalTable, only: list[str] | None = None) -> DataFrame:
    """Aggregate a slice of facts into state rows: ``keys…, <state columns>`` (``only`` some of them)."""
    return partial_and_most(df, at, only)[0]


def partial_and_most(df: DataFrame, at: AnalyticalTable, only: list[str] | None = None) -> tuple[DataFrame, int | None]:
    """``partial``, and how many values a quantile state in it has at most; None where one may be a sketch."""
    t, g = at.table, at.aggregator
    if isinstance(g, LastAggregator):
        return df.groupBy(F.col(f"`{t.id}`")).agg(F.max(_last_struct(t, g.tiebreak)).alias(LAST_STATE)), 0
    specs = [(f"{name}_state", c, a) for name, c, a in output_specs(t, g) if only is None or f"{name}_state" in only]
    keyed = df.withColumn(g.name, timefn.bucket(t.ts, g.group_functions))
    q_specs = [(name, c, _sketch_size(a)) for name, c, a in specs if aggs.get(a.type).takes_probs]
    gathered = {c for _, c, _ in q_specs if isinstance(df.schema[c].dataType, T.NumericType)}
    plain, derived = [], []
    for name, c, a in specs:
        if aggs.get(a.type).takes_probs:
            continue
        state = aggs.state(a, F.col(f"`{c}`"))
        if c in gathered and (of_values := aggs.get(a.type).of_values):
            derived.append((name, c, of_values, state))
        else:
            plain.append(state.alias(name))
    if not q_specs:
        return keyed.groupBy(*at.keys).agg(*plain), 0
    out, most = quantiles.states(keyed, at.keys, q_specs, plain, _bound(specs), derived)
    return out.select(*at.keys, *[F.col(f"`{name}`") for name, _, _ in specs]), most


def quantile_states(at: AnalyticalTable) -> list[str]:
    """State columns that hold quantiles."""
    if isinstance(at.aggregator, LastAggregator):
        return []
    return [f"{name}_state" for name, _, a in output_specs(at.table, at.aggregator) if aggs.get(a.type).takes_probs]


def keeps_values(at: AnalyticalTable, most: int | None) -> bool:
    """Whether states of keys with at most ``most`` values merge without any sketch."""
    return not quantile_states(at) or (most is not None and most <= _bound(output_specs(at.table, at.aggregator)))


def merge(states: DataFrame, at: AnalyticalTable, most: int | None = None, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Fold state rows with equal keys into one state row (same schema as ``partial``'s output).

    State tables hold one row per key and part (compaction keeps the parts few), so a key that is hot
    in the facts is not hot here.  ``most`` is how many values the quantile states of a key have at
    most, where that is known and none is a sketch.  ``dealt_by`` names columns that follow from the
    keys and by which, with the keys, rows lie in order of tasks already: they stay in the result, and
    rows do not move again.
    """
    t, g = at.table, at.aggregator
    keys = [*dealt_by, *at.keys]
    if isinstance(g, LastAggregator):
        return states.groupBy(*keys).agg(F.max(LAST_STATE).alias(LAST_STATE))
    specs = [(f"{name}_state", a) for name, _, a in output_specs(t, g)]
    q_specs = [(name, _sketch_size(a)) for name, a in specs if aggs.get(a.type).takes_probs]
    folded = [(name, fold) for name, a in specs if q_specs and (fold := aggs.get(a.type).fold)]
    others = [(name, a) for name, a in specs if not aggs.get(a.type).takes_probs and name not in dict(folded)]
    plain = [aggs.merge(a, F.col(f"`{name}`")).alias(name) for name, a in others]
    if not q_specs:
        return states.groupBy(*keys).agg(*plain)
    out = quantiles.merged(states, keys, q_specs, plain, _bound(output_specs(t, g)), folded, most, bool(dealt_by))
    return out.select(*keys, *[F.col(f"`{name}`") for name, _ in specs])


def finish(states: DataFrame, at: AnalyticalTable) -> DataFrame:
    """Turn merged states into the rollup's columns."""
    t, g = at.table, at.aggregator
    if isinstance(g, LastAggregator):
        return states.select(F.col(t.id), *_last_columns(t, F.col(LAST_STATE)))

    specs = output_specs(t, g)
    quantile = [name for name, _, a in specs if aggs.get(a.type).takes_probs]
    states = states.select("*", *[F.sort_array(F.col(f"`{name}_state`.values")).alias(f"_v{quantile.index(name)}") for name in quantile])

    def done(name: str, a: aggs.Aggregation) -> Column:
        s = F.col(f"`{name}_state`")
        if name in quantile:
            return _one_level(quantiles.finished(s, F.col(f"_v{quantile.index(name)}"), aggs.probs_of(a)), a).alias(name)
        return aggs.finish(a, s).alias(name)

    return states.select(*[F.col(k) for k in at.keys], *[done(name, a) for name, _, a in specs])


def view(states: DataFrame, at: AnalyticalTable, most: int | None = None) -> DataFrame:
    """Merge-on-read: final values from any number of state rows per key (``most``: see ``merge``)."""
    return finish(merge(states, at, most), at)


def one_pass(df: DataFrame, at: AnalyticalTable, **quantile_options: int) -> DataFrame:
    """The rollup computed directly from facts (no persisted state).  ``quantile_options``:
    ``hot_rows`` / ``partition_rows`` of ``operators.quantiles``."""
    if isinstance(at.aggregator, LastAggregator):
        return last(df, at.table, at.aggregator.tiebreak)
    return interval(df, at.table, at.aggregator, **quantile_options)


# ------------------------------------------------------------------------------------- bucket months

#: The month of states that have no bucket (last values).
NO_MONTH = 0


def bucket_start(bucket: Column, agg: IntervalAggregator) -> Column:
    """The time at which a bucket starts."""
    if agg.group_functions[0] == "toYYYYMM":
        bucket = F.make_date(F.floor(bucket / 100).cast("int"), bucket % 100, F.lit(1))
    return bucket.cast("timestamp_ntz")


def _month(at: AnalyticalTable, bucket: Column) -> Column:
    if isinstance(at.aggregator, LastAggregator):
        return F.lit(NO_MONTH)
    return bucket if at.aggregator.group_functions[0] == "toYYYYMM" else timefn.yyyymm(bucket)


def month_of_row(at: AnalyticalTable) -> Column:
    """The month of the bucket that a fact row belongs to."""
    return _month(at, F.lit(None) if isinstance(at.aggregator, LastAggregator) else timefn.bucket(at.table.ts, at.aggregator.group_functions))


def with_month(states: DataFrame, at: AnalyticalTable) -> DataFrame:
    """State rows with the month of their bucket, by which their files are partitioned."""
    return states.withColumn("yyyymm", _month(at, F.col(f"`{at.keys[-1]}`")).cast("int"))


def _bounds(lo, hi) -> tuple[dt.datetime | None, dt.datetime | None]:
    return tuple(None if v is None else timefn.as_time(v) for v in (lo, hi))


def bucket_months(at: AnalyticalTable, lo=None, hi=None) -> tuple[int, int] | None:
    """First and last month of buckets that start at or after ``lo`` and before ``hi``."""
    if lo is None and hi is None:
        return None
    if isinstance(at.aggregator, LastAggregator):
        raise ValueError(f"{at.name} has no time bucket to select a range of")
    return timefn.month_range(lo, hi)


def bucket_range(at: AnalyticalTable, lo=None, hi=None) -> Column:
    """Buckets that start at or after ``lo`` and before ``hi``."""
    start, (first, end) = bucket_start(F.col(f"`{at.keys[-1]}`"), at.aggregator), _bounds(lo, hi)
    cond = F.lit(True)
    if first is not None:
        cond = cond & (start >= F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (start < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
    return cond
