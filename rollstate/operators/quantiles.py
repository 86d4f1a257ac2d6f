"""Quantiles per group: exact in one pass, and as mergeable states of bounded size.

For a group with ``n`` non-NULL values sorted ascending (0-based), level ``p`` sits at position
``h = p·(n−1)``; the result is ``v[⌊h⌋] + (h − ⌊h⌋)·(v[⌈h⌉] − v[⌊h⌋])`` (the same definition as
SQL ``percentile_cont`` / ``quantile_cont``).

**One pass** (``exact``), by the size of a group, which a sample of the keys tells:

* at most ``list_rows`` rows: the values of each measure are gathered in one aggregation, without any
  sort of the rows, and sorted as an array;
* at most ``hot_rows`` rows: a window ``row_number`` per measure ordered by value, and an aggregation
  that keeps the values at the wanted ranks;
* beyond: rows are range-partitioned on ``(keys, value)`` so one group spreads over many tasks;
  per-partition row counts give each partition's rank offset; only the partitions holding a wanted
  rank are ranked locally.  No task ever holds more than one range partition of a group.

Rows are never dropped or sampled: the result is exact for every group.

**States** (``states``, ``merged``, ``finished``): a group's values as they are while there are no more
than a bound, a KLL sketch beyond.  So small groups, of which there may be very many, cost no sketch
and give the exact, interpolated quantile of one pass; large groups have a state of bounded size that
answers with an observed value, with the sketch's rank error.  States may be merged in any order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollstate.operators.dims import join_small
from rollstate.session import checkpoint_dir

# Rows up to which the values of a group are gathered in an array.
LIST_ROWS = 20_000
# Rows above which a group takes the distributed (range-partitioned) path.
HOT_GROUP_ROWS = 1_000_000
# Target rows per range partition on that path (keys + one double per row).
PARTITION_ROWS = 4_000_000
# Expected sampled rows of a group with exactly ``list_rows`` rows (sets the sampling fraction).
SAMPLE_PER_GROUP = 200

QSpec = tuple[str, str, tuple[float, ...]]  # (output column, input column, levels)
StateSpec = tuple[str, int]  # (state column, size parameter of its sketch)
Named = tuple[str, Column]  # (output column, aggregate expression)
Derived = tuple[str, str, Callable[[Column], Column], Column]  # (output column, input column, of its values, aggregate expression)
Folded = tuple[str, Callable[[Column, str], Column]]  # (state column, merged state of a field of an array of structs)


def _interpolate(lo: Column, hi: Column, n: Column, p: float) -> Column:
    h = (n - 1).cast("double") * F.lit(p)
    return lo + (h - F.floor(h)) * (hi - lo)


def _rank_lo(n: Column, p: float) -> Column:
    return F.floor((n - 1).cast("double") * F.lit(p)).cast("long")


def _rank_hi(n: Column, p: float) -> Column:
    return F.ceil((n - 1).cast("double") * F.lit(p)).cast("long")


def of_sorted(values: Column, probs: Sequence[float]) -> Column:
    """Interpolated quantiles of a sorted array, which should be a column (sorted once, read often);
    NULL when it is empty."""
    n = F.size(values)

    # One small function for all levels: the code that would be generated for each of them is more
    # than the JVM compiles.
    def at(p: Column) -> Column:
        h = (n - 1) * p
        low = F.floor(h)
        v = F.get(values, low.cast("int"))
        return v + (h - low) * (F.get(values, F.ceil(h).cast("int")) - v)

    levels = F.array(*[F.lit(float(p)) for p in probs])
    return F.when(n == 1, F.array_repeat(F.get(values, F.lit(0)), len(probs))).when(n > 1, F.transform(levels, at))


def _by_lists(df: DataFrame, keys: Sequence[str], specs: Sequence[QSpec], others: Sequence[Named]) -> DataFrame:
    """Small groups: one aggregation gathers the values of every measure beside the other aggregates.

    Lists do not shrink by partial aggregation, so rows are dealt by key first; no group is large."""
    inputs = list(dict.fromkeys(c for _, c, _ in specs))
    lists = [F.collect_list(F.col(f"`{c}`").cast("double")).alias(f"_v{i}") for i, c in enumerate(inputs)]
    agg = df.repartition(*keys).groupBy(*keys).agg(*[c.alias(n) for n, c in others], *lists)
    kept = [F.col(f"`{n}`") for n, _ in others]
    agg = agg.select(*keys, *kept, *[F.sort_array(f"_v{i}").alias(f"_v{i}") for i in range(len(inputs))])
    outs = [of_sorted(F.col(f"_v{inputs.index(c)}"), ps).alias(name) for name, c, ps in specs]
    return agg.select(*keys, *kept, *outs)


def _by_window(df: DataFrame, keys: Sequence[str], specs: Sequence[QSpec], others: Sequence[Named]) -> DataFrame:
    """Ordinary groups: rank by window, keep the values at the wanted ranks, interpolate.  The other
    aggregates run in the same aggregation, which reuses the window's partitioning (one shuffle)."""
    inputs = list(dict.fromkeys(c for _, c, _ in specs))
    wk = Window.partitionBy(*keys)
    # One projection: the per-measure counts share one window operator; each rank needs its own
    # ordering (Catalyst groups window expressions by specification).
    counts = [F.count(F.col(c).cast("double")).over(wk).alias(f"_n{i}") for i, c in enumerate(inputs)]
    ranks = []
    for i, c in enumerate(inputs):
        x = F.col(c).cast("double")
        ranks.append(F.when(x.isNotNull(), F.row_number().over(wk.orderBy(x.asc_nulls_last())) - 1).alias(f"_r{i}"))
    ranked = df.select("*", *counts, *ranks)
    picks = []
    for i, c in enumerate(inputs):
        x, r, n = F.col(c).cast("double"), F.col(f"_r{i}"), F.col(f"_n{i}")
        picks.append(F.max(n).alias(f"_n{i}"))
        for p in sorted({p for _, cc, ps in specs if cc == c for p in ps}):
            tag = _tag(p)
            picks.append(F.max(F.when(r == _rank_lo(n, p), x)).alias(f"_lo{i}_{tag}"))
            picks.append(F.max(F.when(r == _rank_hi(n, p), x)).alias(f"_hi{i}_{tag}"))
    agg = ranked.groupBy(*keys).agg(*[c.alias(n) for n, c in others], *picks)
    outs = []
    for name, c, ps in specs:
        i = inputs.index(c)
        n = F.col(f"_n{i}")
        vals = [_interpolate(F.col(f"_lo{i}_{_tag(p)}"), F.col(f"_hi{i}_{_tag(p)}"), n, p) for p in ps]
        outs.append(F.when(n > 0, F.array(*vals)).alias(name))
    return agg.select(*keys, *[n for n, _ in others], *outs)


def _tag(p: float) -> str:
    return repr(float(p)).replace(".", "_").replace("-", "m")


def _hot_one(
    rows: DataFrame, keys: Sequence[str], c: str, probs: Sequence[float], partitions: int
) -> DataFrame:
    """Hot groups, one measure: ``keys, p, q`` rows (one per group and level)."""
    x = rows.select(*keys, F.col(c).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    # A unique tie-breaker in the range key lets many equal values (a stuck sensor) spread over
    # several partitions; ranks among equal values are interchangeable.  Checkpointed so every later
    # use sees the same partition ids (range bounds come from a sample).
    ranged = (
        x.withColumn("_tb", F.monotonically_increasing_id())
        .repartitionByRange(partitions, *keys, "_x", "_tb")
        .withColumn("_pid", F.spark_partition_id())
        .drop("_tb")
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    by_pid = Window.partitionBy(*keys).orderBy("_pid")
    offsets = counts.select(
        *keys,
        "_pid",
        "_c",
        F.coalesce(F.sum("_c").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias("_n"),
    )
    wanted = F.explode(
        F.array(
            *[
                F.struct(F.lit(float(p)).alias("p"), F.lit(side).alias("side"), rank(F.col("_n"), p).alias("rank"))
                for p in probs
                for side, rank in (("lo", _rank_lo), ("hi", _rank_hi))
            ]
        )
    )
    targets = (
        offsets.select(*keys, "_pid", "_c", "_off", "_n", wanted.alias("_t"))
        .where((F.col("_t.rank") >= F.col("_off")) & (F.col("_t.rank") < F.col("_off") + F.col("_c")))
        .select(
            *keys,
            "_pid",
            "_n",
            F.col("_t.p").alias("p"),
            F.col("_t.side").alias("side"),
            (F.col("_t.rank") - F.col("_off")).alias("_lr"),
        )
        .checkpoint(eager=True)  # small (2 rows per group and level); reused by size checks and joins
    )
    needed = targets.select(*keys, "_pid").distinct()
    slices = join_small(ranged, needed.withColumnsRenamed({k: f"_k_{k}" for k in [*keys, "_pid"]}), _on_renamed(keys, "_pid"), "left_semi")
    local = slices.withColumn("_lr", F.row_number().over(Window.partitionBy(*keys, "_pid").orderBy("_x")) - 1)
    # Both sides descend from ``ranged``: give the target side its own column names.
    t = targets.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*keys, "_pid", "_lr"]],
        F.col("p").alias("_tp"),
        F.col("side").alias("_tside"),
        F.col("_n").alias("_tn"),
    )
    cond = _on_renamed(keys, "_pid", "_lr")
    vals = join_small(local, t, cond, "inner").select(*keys, "_tp", "_tside", "_tn", "_x")
    per_p = vals.groupBy(*keys, F.col("_tp").alias("p")).agg(
        F.max(F.when(F.col("_tside") == "lo", F.col("_x"))).alias("_lo"),
        F.max(F.when(F.col("_tside") == "hi", F.col("_x"))).alias("_hi"),
        F.max("_tn").alias("_n"),
    )
    h = (F.col("_n") - 1).cast("double") * F.col("p")
    return per_p.select(*keys, "p", (F.col("_lo") + (h - F.floor(h)) * (F.col("_hi") - F.col("_lo"))).alias("q"))


def _on_renamed(keys: Sequence[str], *extra: str) -> Column:
    cols = [*keys, *extra]
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in cols])


def _by_range(
    rows: DataFrame,
    keys: Sequence[str],
    specs: Sequence[QSpec],
    others: Sequence[Named],
    rows_per_partition: int,
    total: int,
) -> DataFrame:
    """Hot groups: other aggregates by partial (map-side) aggregation, quantiles by distributed exact
    selection per measure, assembled into one row per group."""
    checkpoint_dir(rows.sparkSession)
    partitions = max(2, math.ceil(total / max(1, rows_per_partition)))
    out = rows.groupBy(*keys).agg(*([c.alias(n) for n, c in others] or [F.count(F.lit(1)).alias("_rows")]))
    for name, c, ps in specs:
        q = _hot_one(rows, keys, c, ps, partitions)
        arr = q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(f"_p{j}") for j, p in enumerate(ps)])
        arr = arr.select(*keys, F.array(*[F.col(f"_p{j}") for j in range(len(ps))]).alias(name))
        renamed = arr.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        out = out.join(renamed, _on_renamed(keys), "left").drop(*[f"_k_{k}" for k in keys])
    return out.select(*keys, *[n for n, _ in others], *[name for name, _, _ in specs])


def large_groups(df: DataFrame, keys: Sequence[str], rows: int, seed: int = 17) -> tuple[DataFrame | None, int]:
    """Groups likely above ``rows`` rows with their estimated size ``_rows``, and the total of these.

    A group of ``rows`` rows contributes about ``SAMPLE_PER_GROUP`` sampled rows; a group is flagged
    at half that.  Routing only decides which exact path a group takes, so a near-threshold group may
    go either way without changing any result; a group far above the bound is flagged with
    overwhelming probability.  The flagged keys are checkpointed so every later use agrees.
    """
    fraction = min(1.0, SAMPLE_PER_GROUP / max(1, rows))
    sample = df.select(*keys) if fraction >= 1.0 else df.select(*keys).sample(False, fraction, seed)
    cutoff = rows if fraction >= 1.0 else SAMPLE_PER_GROUP / 2
    checkpoint_dir(df.sparkSession)
    flagged = sample.groupBy(*keys).agg((F.count(F.lit(1)) / fraction).cast("long").alias("_rows"))
    fixed = flagged.where(F.col("_rows") > int(cutoff / fraction)).checkpoint(eager=True)
    n, total = fixed.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    return (fixed, int(total)) if n else (None, 0)


def _split(df: DataFrame, keys: Sequence[str], groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the groups, and all others."""
    renamed = groups.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return join_small(df, renamed, _on_renamed(keys), "left_semi"), join_small(df, renamed, _on_renamed(keys), "left_anti")


def exact(
    df: DataFrame,
    keys: Sequence[str],
    specs: Sequence[QSpec],
    others: Sequence[Named] = (),
    hot_rows: int = HOT_GROUP_ROWS,
    partition_rows: int = PARTITION_ROWS,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """Per group: ``keys…``, the named aggregates ``others…``, then one ``array<double>`` column per
    quantile spec (NULL when the group has no values).

    ``df`` must carry the key columns.  A sampled pass (keys only) finds groups far above
    ``list_rows`` rows; when there are none, only the first path runs.
    """
    keys, list_rows = list(keys), min(list_rows, hot_rows)
    flagged, _ = large_groups(df, keys, list_rows)
    if flagged is None:
        return _by_lists(df, keys, specs, others)
    large, small = _split(df, keys, flagged)
    out = _by_lists(small, keys, specs, others)
    hot = flagged.where(F.col("_rows") > hot_rows)
    n_hot, total = hot.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if n_hot < flagged.count():
        middle = large if not n_hot else _split(large, keys, hot)[1]
        out = out.unionByName(_by_window(middle, keys, specs, others))
    if n_hot:
        hot_df = _split(large, keys, hot)[0]
        out = out.unionByName(_by_range(hot_df, keys, specs, others, partition_rows, int(total)))
    return out


# ------------------------------------------------------------------------------------------- states


def _state(values: Column, sketch: Column) -> Column:
    return F.struct(values.alias("values"), sketch.alias("sketch"))


def _no_values() -> Column:
    return F.array().cast("array<double>")


def _values(rows: Column, field: str) -> Column:
    """Values of a field of an array of structs, without NULLs."""
    one = F.get(rows, F.lit(0))[field]
    several = F.filter(F.transform(rows, lambda r: r[field]), lambda v: v.isNotNull())
    return F.when(F.size(rows) > 1, several).when(one.isNotNull(), F.array(one)).otherwise(_no_values())


def states(
    df: DataFrame, keys: Sequence[str], specs: Sequence[tuple[str, str, int]], others: Sequence[Column], bound: int, derived: Sequence[Derived] = ()
) -> tuple[DataFrame, int | None]:
    """State rows: ``keys…``, ``others…``, ``derived…`` and one quantile state per (state column, input column, k);
    and how many values a state holds at most, None where there are sketches.

    The rows of each group are counted first (partial aggregation, one row per group and task moves).
    Groups of at most ``bound`` rows keep their values, larger ones get sketches, whose buffers are
    bounded whatever the group.  A small group's rows are gathered in one list, which also gives the
    ``derived`` columns: (name, input column, function of the array of its values, aggregate that gives
    the same of a large group).
    """
    checkpoint_dir(df.sparkSession)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most = counted.agg(F.max("_rows")).first()[0] or 0

    def listed(rows: DataFrame) -> DataFrame:
        inputs = list(dict.fromkeys([*(c for _, c, _ in specs), *(c for _, c, _, _ in derived)]))
        row = F.struct(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(inputs)])
        out = rows.repartition(*keys).groupBy(*keys).agg(*others, F.collect_list(row).alias("_rows"))  # as in ``_by_lists``
        kept = [F.col(f"`{c}`") for c in out.columns if c != "_rows"]
        out = out.select(*kept, *[_values(F.col("_rows"), f"x{i}").alias(f"_v{i}") for i in range(len(inputs))])
        values = {c: F.col(f"_v{i}") for i, c in enumerate(inputs)}
        lists = [_state(values[c], F.lit(None).cast("binary")).alias(name) for name, c, _ in specs]
        return out.select(*kept, *[of(values[c]).alias(name) for name, c, of, _ in derived], *lists)

    def sketched(rows: DataFrame) -> DataFrame:
        def one(c: str, k: int) -> Column:
            x = F.col(f"`{c}`").cast("double")
            return _state(_no_values(), F.when(F.count(x) > 0, F.kll_sketch_agg_double(x, k)))

        return rows.groupBy(*keys).agg(*others, *[c.alias(name) for name, _, _, c in derived], *[one(c, k).alias(name) for name, c, k in specs])

    if most <= bound:
        return listed(df), most
    large_keys = counted.where(F.col("_rows") > bound).select(*keys).checkpoint(eager=True)
    large, small = _split(df, keys, large_keys)
    return listed(small).unionByName(sketched(large)), None


def _crowded(s: Column, bound: int) -> Column:
    """The values of a merged state exceed the bound, or stand beside a sketch."""
    return (F.size(s["values"]) > bound) | (s["sketch"].isNotNull() & (F.size(s["values"]) > 0))


def _joined(rows: Column, name: str) -> Column:
    """Quantile state of a field of an array of structs: values joined, sketches merged."""
    one = F.get(rows, F.lit(0))[name]
    given = F.filter(F.transform(rows, lambda r: r[name]), lambda s: s.isNotNull())
    sketches = F.filter(F.transform(given, lambda s: s["sketch"]), lambda s: s.isNotNull())
    rest = F.slice(sketches, F.lit(2), F.greatest(F.size(sketches) - 1, F.lit(0)))
    both = F.when(F.size(sketches) > 0, F.aggregate(rest, F.get(sketches, F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b)))
    several = _state(F.flatten(F.transform(given, lambda s: s["values"])), both)
    return F.when(F.size(rows) > 1, several).when(one.isNotNull(), one).otherwise(_state(_no_values(), F.lit(None).cast("binary")))


def merged(
    rows: DataFrame,
    keys: Sequence[str],
    specs: Sequence[StateSpec],
    others: Sequence[Column],
    bound: int,
    folded: Sequence[Folded] = (),
    most: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """One state row per key: ``others…`` (aggregates with an alias), ``folded…`` and the merged quantile states.

    The quantile states and those to fold are gathered in one list.  Where the values of a key then
    exceed the bound, or stand beside a sketch, they go into the sketch by a second aggregation, of
    those keys only; there is none if a key has at most ``most`` values, which is within the bound, and
    no sketch.  ``dealt`` rows of a key are in one task already.
    """
    gathered = F.struct(*[F.col(f"`{name}`") for name, _ in [*folded, *specs]])
    placed = rows if dealt else rows.repartition(*keys)  # one row per key and part
    out = placed.groupBy(*keys).agg(*others, F.collect_list(gathered).alias("_rows"))
    kept = [c for c in out.columns if c not in keys and c != "_rows"] + [name for name, _ in folded]
    together = [fold(F.col("_rows"), name).alias(name) for name, fold in folded]
    together += [_joined(F.col("_rows"), name).alias(name) for name, _ in specs]
    out = out.select(*[F.col(f"`{c}`") for c in out.columns if c != "_rows"], *together)
    if most is not None and most <= bound:
        return out
    cols = [F.col(f"`{name}`") for name, _ in specs]
    any_crowded = reduce(lambda a, b: a | b, [_crowded(c, bound) for c in cols])

    def tagged(i: int, s: Column) -> Column:
        values = F.when(_crowded(s, bound), s["values"]).otherwise(_no_values())
        return F.transform(values, lambda v: F.struct(F.lit(i).alias("i"), v.alias("v")))

    again = out.where(any_crowded).withColumn("_e", F.explode(F.concat(*[tagged(i, c) for i, c in enumerate(cols)])))
    again = again.groupBy(*keys).agg(
        *[F.first(f"`{c}`").alias(c) for c in kept],
        *[F.first(c).alias(f"_s{i}") for i, c in enumerate(cols)],
        *[F.kll_sketch_agg_double(F.when(F.col("_e.i") == i, F.col("_e.v")), k).alias(f"_k{i}") for i, (_, k) in enumerate(specs)],
    )
    settled = []
    for i, (name, _) in enumerate(specs):
        s, more = F.col(f"_s{i}"), F.col(f"_k{i}")
        sketch = F.when(s["sketch"].isNull(), more).otherwise(F.kll_sketch_merge_double(s["sketch"], more))
        settled.append(F.when(_crowded(s, bound), _state(_no_values(), sketch)).otherwise(s).alias(name))
    again = again.select(*keys, *[F.col(f"`{c}`") for c in kept], *settled)
    return out.where(~any_crowded).unionByName(again)


def finished(s: Column, values: Column, probs: Sequence[float]) -> Column:
    """Quantiles of a merged state whose sorted values are a column of their own; NULL when it holds none."""
    levels = F.array(*[F.lit(float(p)) for p in probs])
    return F.when(s["sketch"].isNotNull(), F.kll_sketch_get_quantile_double(s["sketch"], levels)).otherwise(of_sorted(values, probs))
