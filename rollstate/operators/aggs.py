"""Aggregate-function registry: name → one-pass, partial state, state merge and finish.

Every entry is written with built-in Spark expressions, so both the one-pass form and the state forms
get Catalyst's partial (map-side) aggregation and no Python runs in the data path.

State layouts (all mergeable in any order):

=============  ====================================  ===============================================
function       state                                 merge
=============  ====================================  ===============================================
count          n long                                sum
avg            struct<sum double, n long>            field-wise sum
quantiles      struct<values, sketch>                values joined, sketches merged (``quantiles``)
stddevSamp     struct<n long, mean, m2>              pairwise, by the exact update of mean and m2
min/max/sum    same type as input                    min / max / sum
argMax/argMin  struct<by, value>                     max(by) / max_by(value, by)  (min for argMin)
=============  ====================================  ===============================================

The moments of two states are joined around their common mean (``m2`` grows by the squared distance
of the means, weighted), never through Σn·mean², which cancels for values near 1e9 with a small
spread.  A key has one state per live part, so the list that is folded is short.

Beside quantiles, whose states gather a group's rows or states in one list, further lists and running
values cost more than all the rest: ``of_values`` gives a state from the values in that list, and
``fold`` a merged state from the states in it.  Both take a shorter way with one value or one state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollstate.spec import Aggregation, SpecError


#: A sketch's size parameter: its bounds in Spark, and its default (rank error about 1.3 %).
MIN_K, MAX_K, DEFAULT_K = 8, 65535, 200
#: Values that a group's state keeps as they are, by default and at most.
DEFAULT_EXACT, MAX_EXACT = 512, 100_000


@dataclass(frozen=True)
class AggFn:
    name: str
    one_pass: Callable[[Column, tuple[float, ...], list[Column]], Column]
    state: Callable[[Column, tuple[float, ...], list[Column]], Column]
    merge: Callable[[Column, tuple[float, ...]], Column]
    finish: Callable[[Column, tuple[float, ...]], Column]
    n_extra: int = 0  # number of ``args_func`` columns
    takes_probs: bool = False  # ``args_agg`` are quantile levels; states and merges: ``operators.quantiles``
    levels: tuple[float, ...] = ()  # fixed quantile levels (of ``median``)
    scalar: bool = False  # one level, given as a number instead of an array
    of_values: Callable[[Column], Column] | None = None  # state of an array of values, none of them NULL
    fold: Callable[[Column, str], Column] | None = None  # merged state of a field of an array of structs


def _d(c: Column) -> Column:
    return c.cast("double")


def _avg_finish(s: Column, _p) -> Column:
    return F.when(s["n"] > 0, s["sum"] / s["n"])


def _stddev_state(x: Column, _p, _e) -> Column:
    x = _d(x)
    n = F.count(x)
    return F.struct(n.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * n).alias("m2"))


def _moments(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), mean.alias("mean"), m2.alias("m2"))


def _no_moments() -> Column:
    return _moments(F.lit(0), F.lit(0.0), F.lit(0.0))


def _joined_moments(states: Column) -> Column:
    def join(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        mean = a["mean"] + apart * b["n"] / n
        m2 = a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n
        return F.when(a["n"] == 0, b).otherwise(_moments(n, mean, m2))

    return F.aggregate(states, _no_moments(), join)


def _stddev_merge(s: Column, _p) -> Column:
    return _joined_moments(F.collect_list(F.when(s["n"] > 0, s)))


def _avg_state(total: Column, n: Column) -> Column:
    return F.struct(total.alias("sum"), n.alias("n"))


def _stddev_fold(rows: Column, name: str) -> Column:
    one = F.get(rows, F.lit(0))[name]
    several = F.filter(F.transform(rows, lambda r: r[name]), lambda s: s["n"] > 0)
    return F.when(F.size(rows) > 1, _joined_moments(several)).when(one["n"] > 0, one).otherwise(_no_moments())


def _stddev_of_values(values: Column) -> Column:
    def add(s: Column, x: Column) -> Column:
        n, apart = s["n"] + 1, x - s["mean"]
        mean = s["mean"] + apart / n
        return _moments(n, mean, s["m2"] + apart * (x - mean))

    one, none = F.get(values, F.lit(0)), F.lit(None).cast("double")
    several = F.aggregate(values, _no_moments(), add)
    # A value less itself: 0, or NaN where a spread has no meaning.
    return F.when(F.size(values) > 1, several).otherwise(F.when(F.size(values) == 1, _moments(F.lit(1), one, one - one)).otherwise(_moments(F.lit(0), none, none)))


def _avg_of_values(values: Column) -> Column:
    total = F.when(F.size(values) > 1, F.aggregate(values, F.lit(0.0), lambda a, x: a + x)).otherwise(F.get(values, F.lit(0)))
    return _avg_state(total, F.size(values).cast("long"))


def _spread(one_pass: Callable[[Column], Column], sample: bool, root: bool) -> dict:
    """A variance or standard deviation, of a sample or of all values, on the state of ``stddevSamp``."""

    def finish(s: Column, _p) -> Column:
        var = F.greatest(s["m2"], F.lit(0.0)) / (s["n"] - 1 if sample else s["n"])
        return F.when(s["n"] > (1 if sample else 0), F.sqrt(var) if root else var)

    return dict(
        one_pass=lambda x, _p, _e: one_pass(_d(x)),
        state=_stddev_state,
        merge=_stddev_merge,
        finish=finish,
        of_values=_stddev_of_values,
        fold=_stddev_fold,
    )


def _probs(p: tuple[float, ...]) -> Column:
    return F.array(*[F.lit(float(x)) for x in p])


def _arg(extreme_by: Callable, extreme: Callable) -> tuple[Callable, Callable, Callable, Callable]:
    def one_pass(x, _p, e):
        return extreme_by(x, e[0])

    def state(x, _p, e):
        return F.struct(extreme(e[0]).alias("by"), extreme_by(x, e[0]).alias("value"))

    def merge(s, _p):
        return F.struct(extreme(s["by"]).alias("by"), extreme_by(s["value"], s["by"]).alias("value"))

    def finish(s, _p):
        return s["value"]

    return one_pass, state, merge, finish


def _simple(fn: Callable[[Column], Column], merge_fn: Callable[[Column], Column] | None = None) -> dict:
    m = merge_fn or fn
    return dict(
        one_pass=lambda x, _p, _e: fn(x),
        state=lambda x, _p, _e: fn(x),
        merge=lambda s, _p: m(s),
        finish=lambda s, _p: s,
    )


def _quantile() -> dict:
    """States, their merge and their finish depend on the group's size: see ``operators.quantiles``."""

    def elsewhere(*_):
        raise NotImplementedError("quantile states are built by operators.quantiles")

    return dict(one_pass=lambda x, p, _e: F.percentile(_d(x), _probs(p)), state=elsewhere, merge=elsewhere, finish=elsewhere)


REGISTRY: dict[str, AggFn] = {
    "count": AggFn("count", **_simple(F.count, F.sum), of_values=lambda values: F.size(values).cast("long")),
    "max": AggFn("max", **_simple(F.max)),
    "min": AggFn("min", **_simple(F.min)),
    "sum": AggFn("sum", **_simple(lambda x: F.sum(_d(x)), F.sum)),
    "avg": AggFn(
        "avg",
        one_pass=lambda x, _p, _e: F.avg(_d(x)),
        state=lambda x, _p, _e: F.struct(F.sum(_d(x)).alias("sum"), F.count(x).alias("n")),
        merge=lambda s, _p: F.struct(F.sum(s["sum"]).alias("sum"), F.sum(s["n"]).alias("n")),
        finish=_avg_finish,
        of_values=_avg_of_values,
    ),
    "stddevSamp": AggFn("stddevSamp", **_spread(F.stddev_samp, sample=True, root=True)),
    "stddevPop": AggFn("stddevPop", **_spread(F.stddev_pop, sample=False, root=True)),
    "varSamp": AggFn("varSamp", **_spread(F.var_samp, sample=True, root=False)),
    "varPop": AggFn("varPop", **_spread(F.var_pop, sample=False, root=False)),
    # One pass: exact, with linear interpolation, by ``operators.quantiles`` (``one_pass`` here is
    # Spark's ``percentile``, for small inputs only: it holds a group's distinct values in one buffer).
    # States: the values themselves for small groups, a KLL sketch beyond.
    "quantiles": AggFn("quantiles", **_quantile(), takes_probs=True),
    "quantile": AggFn("quantile", **_quantile(), takes_probs=True, scalar=True),
    "median": AggFn("median", **_quantile(), takes_probs=True, levels=(0.5,), scalar=True),
    # Any value will do; the smallest makes results repeat.
    "any": AggFn("any", **_simple(F.min)),
    "argMax": AggFn("argMax", *_arg(F.max_by, F.max), n_extra=1),
    "argMin": AggFn("argMin", *_arg(F.min_by, F.min), n_extra=1),
}


def get(name: str) -> AggFn:
    try:
        return REGISTRY[name]
    except KeyError:
        raise SpecError(f"unknown aggregation {name!r}; known: {sorted(REGISTRY)}") from None


def probs_of(a: Aggregation) -> tuple[float, ...]:
    return get(a.type).levels or tuple(float(x) for x in a.args_agg)


def validate(a: Aggregation) -> None:
    fn = get(a.type)
    if fn.takes_probs and not fn.levels:
        if not a.args_agg:
            raise SpecError(f"{a.type} needs quantile levels in args_agg")
        try:
            ps = probs_of(a)
        except ValueError:
            raise SpecError(f"{a.type}: quantile levels must be numbers, got {a.args_agg}") from None
        if any(not 0.0 <= p <= 1.0 for p in ps):
            raise SpecError(f"{a.type}: quantile levels must lie in [0, 1], got {a.args_agg}")
        if fn.scalar and len(ps) != 1:
            raise SpecError(f"{a.type} takes one quantile level, got {a.args_agg}")
    elif a.args_agg:
        raise SpecError(f"{a.type} takes no args_agg")
    if len(a.args_func) != fn.n_extra:
        raise SpecError(f"{a.type} takes {fn.n_extra} extra column(s) in args_func, got {len(a.args_func)}")
    for name, value, low, high in (("k", a.k, MIN_K, MAX_K), ("exact", a.exact, 0, MAX_EXACT)):
        if not fn.takes_probs and value is not None:
            raise SpecError(f"{a.type} takes no {name}")
        if value is not None and (isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high):
            raise SpecError(f"{a.type}: {name} must be a whole number from {low} to {high}, got {value!r}")


def extra_cols(a: Aggregation) -> list[Column]:
    return [F.col(c) for c in a.args_func]


def one_pass(a: Aggregation, x: Column) -> Column:
    out = get(a.type).one_pass(x, probs_of(a), extra_cols(a))
    return F.get(out, F.lit(0)) if get(a.type).scalar else out


def state(a: Aggregation, x: Column) -> Column:
    return get(a.type).state(x, probs_of(a), extra_cols(a))


def merge(a: Aggregation, s: Column) -> Column:
    return get(a.type).merge(s, probs_of(a))


def finish(a: Aggregation, s: Column) -> Column:
    return get(a.type).finish(s, probs_of(a))


def targets(columns: Sequence[str], measures: Sequence[str], a: Aggregation) -> list[str]:
    """Columns an aggregation applies to: every measure, or its own ``columns`` list."""
    return [c for c in columns if (c in a.columns if a.columns is not None else c in measures)]
