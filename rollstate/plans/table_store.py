"""A fact table and its rollups on one commit log: batches, replays, compaction, backfill, vacuum."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollstate.functions import timefn
from rollstate.operators import rollups
from rollstate.plans import commit_log as log
from rollstate.plans.part_store import MONTH, PART, PartStore, tier
from rollstate.plans.files import NULL_PARTITION
from rollstate.sources import store
from rollstate.spec import AnalyticalTable, Spec, Table

FACTS = "facts"
SOURCE, BATCH = store.SOURCE, store.BATCH
#: Columns of fact files that say in which batch a row came.
ROW_SOURCE, ROW_BATCH = "_source_id", "_batch_id"
ROWS = "rows"  # the column group of a relation whose columns are not tracked one by one


class ReplayError(RuntimeError):
    """A batch that is merged with others cannot be replaced, because its facts were not stored."""


class TableStore:
    def __init__(self, spark: SparkSession, spec: Spec, table: Table, root: str):
        self.spark, self.table, self.root = spark, table, root.rstrip("/")
        self.rollups = {at.name: at for at in spec.rollups_of(table.name)}
        self.log = log.CommitLog(spark, f"{self.root}/log")
        self._parts: dict[str, PartStore] = {}

    # ------------------------------------------------------------------ relations
    def parts(self, name: str) -> PartStore:
        if name not in self._parts:
            t = self.table
            if name == FACTS:
                ids = [T.StructField(ROW_SOURCE, T.StringType()), T.StructField(ROW_BATCH, T.LongType())]
                schema, order = T.StructType([*t.schema.fields, *ids]), [t.id, t.ts]
            else:
                schema, order = self.state_schema(name), self.rollups[name].keys
            self._parts[name] = PartStore(self.spark, f"{self.root}/{name}", schema, t.id, order)
        return self._parts[name]

    def state_schema(self, name: str) -> T.StructType:
        """Schema of ``partial``'s output, from an empty frame of the fact schema."""
        return rollups.partial(self.spark.createDataFrame([], self.table.schema), self.rollups[name]).schema

    def _columns(self, name: str) -> list[str]:
        return [ROWS] if name == FACTS else rollups.state_columns(self.rollups[name])

    # ------------------------------------------------------------------ reads
    def facts(self, ids: Sequence | None = None, lo=None, hi=None, identity: bool = False) -> DataFrame:
        """Live fact rows with ``yyyymm``; only of ``ids`` and of ``lo <= time < hi`` where given.

        Months outside the range and files that cannot hold an id are not opened.  ``identity`` adds
        the batch of each row as ``source_id`` and ``batch_id``.
        """
        state = self.log.read()[1]
        months = timefn.month_range(lo, hi)
        df = self._fact_rows(state, self._live(state, FACTS, months), ids)
        if ids is not None:
            df = df.where(_is_any(F.col(f"`{self.table.id}`"), ids))
        if lo is not None or hi is not None:
            df = store.time_range(df, self.table, lo, hi)
        cols = [F.col(f"`{c.name}`") for c in self.table.all_columns] + [F.col(MONTH)]
        if identity:
            cols += [F.col(ROW_SOURCE).alias(SOURCE), F.col(ROW_BATCH).alias(BATCH)]
        return df.select(*cols)

    def states(self, name: str, ids: Sequence | None = None, lo=None, hi=None) -> DataFrame:
        """Live state rows; with a range, those whose bucket starts at or after ``lo`` and before ``hi``."""
        return self._state_rows(self.log.read()[1], name, ids, lo, hi)

    def _state_rows(self, state: log.State, name: str, ids: Sequence | None = None, lo=None, hi=None) -> DataFrame:
        at = self.rollups[name]
        months = rollups.bucket_months(at, lo, hi)
        df = self._read(state, name, self._live(state, name, months), ids)
        if ids is not None:
            df = df.where(_is_any(F.col(f"`{self.table.id}`"), ids))
        if months is not None:
            df = df.where(rollups.bucket_range(at, lo, hi) & F.col(MONTH).between(*months))
        return df.select(*[F.col(f"`{c}`") for c in self.parts(name).schema.fieldNames()])

    def view(self, name: str, ids: Sequence | None = None, lo=None, hi=None) -> DataFrame:
        """Merge-on-read: the rollup's final columns."""
        at, state = self.rollups[name], self.log.read()[1]
        most = [part.get("most") for part in log.relation(state, name)["parts"].values()]
        return rollups.view(self._state_rows(state, name, ids, lo, hi), at, None if None in most else sum(most))

    def covered(self, name: str) -> log.Ranges:
        """Batches that the relation holds in all its columns."""
        return self._covered(self.log.read()[1], name)

    def _covered(self, state: log.State, name: str) -> log.Ranges:
        return log.covered(state, name, self._columns(name))

    def versions(self, name: str) -> int:
        """How many compactions the relation has seen."""
        return log.relation(self.log.read()[1], name)["compactions"]

    def months(self, name: str) -> dict[str, list[str]]:
        """Live parts of every month."""
        out: dict[str, list[str]] = {}
        for p, ms in self._live(self.log.read()[1], name).items():
            for m in ms:
                out.setdefault(m, []).append(p)
        return {m: sorted(ps) for m, ps in sorted(out.items())}

    @staticmethod
    def _live(state: log.State, name: str, months: tuple[int, int] | None = None) -> dict[str, list[str]]:
        def wanted(m: str) -> bool:
            return months is None or (m != NULL_PARTITION and months[0] <= int(m) <= months[1])

        live = {p: [m for m in part["months"] if wanted(m)] for p, part in log.relation(state, name)["parts"].items()}
        return {p: ms for p, ms in live.items() if ms}

    def _read(self, state: log.State, name: str, live: dict[str, list[str]], ids: Sequence | None = None) -> DataFrame:
        parts = log.relation(state, name)["parts"]

        def whole(p: str, months: list[str]) -> bool:
            return not parts[p].get("cut") and len(months) == len(parts[p]["months"])

        return self.parts(name).read({p: None if whole(p, ms) else ms for p, ms in live.items()}, ids)

    def _fact_rows(self, state: log.State, live: dict[str, list[str]], ids: Sequence | None = None) -> DataFrame:
        """Fact rows of parts, without rows of batches that were replayed since."""
        df = self._read(state, FACTS, live, ids)
        for source, batch, parts in state["dropped"]:
            if live.keys() & set(parts):
                df = df.where(~(F.col(PART).isin(parts) & (F.col(ROW_SOURCE) == source) & (F.col(ROW_BATCH) == batch)))
        return df

    # ------------------------------------------------------------------ batches
    def ingest(self, rows: DataFrame, source: str, batch: int, write_facts: bool = True) -> None:
        """Stores one batch: fact rows and the states of every rollup, visible together by one commit.

        The same (source, batch) again replaces all that it stored before, also by nothing, and also
        after compactions: merged fact rows of the old batch are masked until the next compaction, and
        the months of a rollup that it touched are aggregated anew from the facts.
        """
        batch, part, written, most = int(batch), uuid.uuid4().hex, {}, {}
        if write_facts:
            tagged = rows.withColumn(MONTH, timefn.yyyymm(F.col(f"`{self.table.ts}`")))
            tagged = tagged.withColumn(ROW_SOURCE, F.lit(source)).withColumn(ROW_BATCH, F.lit(batch).cast("long"))
            written[FACTS] = self.parts(FACTS).write(tagged, part)
        for name, at in self.rollups.items():
            states, most[name] = rollups.partial_and_most(rows, at)
            written[name] = self.parts(name).write(rollups.with_month(states, at), part)
        while True:
            version, state = self.log.read()
            if FACTS not in written and log.has(self._covered(state, FACTS), source, batch):
                raise ReplayError(f"facts of batch {batch} of {source} are stored; replay it with them")
            lacking = [n for n in self.rollups if log.is_folded(state, n, source, batch) and log.minus(self._covered(state, FACTS), self._covered(state, n))]
            if lacking:  # months are aggregated anew from all facts, so the rollup must hold them all
                for name in lacking:
                    self.backfill(name)
                continue
            record, extra = self._batch_record(state, written, part, source, batch, most)
            if self.log.commit(version, record):
                return
            for name in extra:  # aggregated from facts that have changed since
                self.parts(name).delete(extra[name])

    def _batch_record(self, state: log.State, written: dict[str, dict], part: str, source: str, batch: int, most: dict[str, int | None]) -> tuple[log.Record, dict[str, str]]:
        record: log.Record = []
        merged = [name for name in written if log.is_folded(state, name, source, batch)]
        for name, months in written.items():
            rel = log.relation(state, name)
            if name in merged and name != FACTS:
                continue
            if name in merged:
                holding = [p for p, v in rel["parts"].items() if log.has(v["batches"], source, batch)]
                if holding:
                    record.append({"do": "drop", "source": source, "batch": batch, "parts": holding})
            prior = rel["own"].get(source, {}).get(str(batch))
            if prior in rel["parts"]:
                record.append({"do": "remove", "in": name, "part": prior, "months": list(rel["parts"][prior]["months"])})
            record += self._added(name, part if months else None, months, {source: [[batch, batch]]}, most=most.get(name))
            record.append({"do": "own", "in": name, "source": source, "batch": batch, "part": part if months else None})
        extra = {}
        for name in merged:
            if name != FACTS:
                extra[name] = uuid.uuid4().hex
                record += self._rebuilt(state, record, name, extra[name], part, written, source, batch)
        return record, extra

    def _added(
        self, name: str, part: str | None, months: dict[str, int], batches: log.Ranges, columns: Sequence[str] | None = None, most: int | None = None
    ) -> log.Record:
        add = [_add(name, part, months, batches, most)] if part else []
        return [*add, {"do": "cover", "in": name, "columns": list(columns or self._columns(name)), "batches": batches}]

    def _rebuilt(self, state: log.State, record: log.Record, name: str, fresh: str, part: str, written: dict, source: str, batch: int) -> log.Record:
        """Actions that replace the months of a rollup that the old or the new rows of a batch touch
        by states aggregated from the facts as they are after the replay."""
        at, rel = self.rollups[name], log.relation(state, name)
        missing = log.minus(self._covered(state, name), self._covered(state, FACTS))
        if FACTS not in written or missing:
            raise ReplayError(f"{name}: batch {batch} of {source} is merged with others and facts are not stored of {missing or 'it'}")
        own = log.relation(state, FACTS)["own"].get(source, {}).get(str(batch))
        old = {own: list(log.relation(state, FACTS)["parts"][own]["months"])} if own else {}
        if log.is_folded(state, FACTS, source, batch):
            old = {p: m for p, m in self._live(state, FACTS).items() if log.has(log.relation(state, FACTS)["parts"][p]["batches"], source, batch)}
        before = self._fact_rows(state, old).where((F.col(ROW_SOURCE) == source) & (F.col(ROW_BATCH) == batch))
        touched = {NULL_PARTITION if r[0] is None else str(r[0]) for r in before.select(rollups.month_of_row(at)).distinct().collect()}
        touched |= set(written[name])
        after = log.apply(state, [a for a in record if a.get("in", FACTS) == FACTS], 0)
        rows = self._fact_rows(after, self._live(after, FACTS))
        numbers = [int(m) for m in touched if m != NULL_PARTITION]
        month = rollups.month_of_row(at)
        wanted = month.isin(numbers) if numbers else F.lit(False)
        if NULL_PARTITION in touched:
            wanted = wanted | month.isNull()
        elif numbers and numbers != [rollups.NO_MONTH]:  # a bucket starts at most a year before its rows
            wanted = wanted & F.col(MONTH).between(min(numbers), max(numbers) + 100)
        states, most = rollups.partial_and_most(rows.where(wanted), at)
        months = self.parts(name).write(rollups.with_month(states, at), fresh) if touched else {}
        out: log.Record = []
        shared = []
        for p, v in rel["parts"].items():
            if gone := [m for m in v["months"] if m in touched]:
                out.append({"do": "remove", "in": name, "part": p, "months": gone})
                shared += [[s, int(b)] for s, bs in rel["own"].items() for b, q in bs.items() if q == p]
        everything = log.union(self._covered(state, name), {source: [[batch, batch]]})
        out += self._added(name, fresh if months else None, months, everything, most=most)
        return [*out, {"do": "share", "in": name, "batches": [*shared, [source, batch]]}]

    # ------------------------------------------------------------------ compaction
    def compact(self, name: str, full: bool = False, growth: float = 4.0, target_bytes: int | None = None) -> int:
        """Merges parts of the relation, each month by itself; returns how many compactions it has seen.

        Of every month the small parts are merged as long as they amount to something beside the next
        larger one (``tier``); with ``full`` all parts of a month are, and rows of replayed batches
        are left out for good.  Months with nothing to merge keep their files.  Batches that arrive
        meanwhile stay beside the new part.
        """
        while True:
            version, state = self.log.read()
            rel = log.relation(state, name)
            by_month: dict[str, dict[str, int]] = {}
            for p, v in rel["parts"].items():
                for m, size in v["months"].items():
                    by_month.setdefault(m, {})[p] = size
            masked = {p for _, _, ps in state["dropped"] for p in ps} if name == FACTS else set()
            chosen: dict[str, list[str]] = {}
            for m, sizes in by_month.items():
                for p in (list(sizes) if full and (len(sizes) > 1 or masked & sizes.keys()) else tier(sizes, growth)):
                    chosen.setdefault(p, []).append(m)
            if not chosen:
                return rel["compactions"]
            part = uuid.uuid4().hex
            total = sum(rel["parts"][p]["months"][m] for p, ms in chosen.items() for m in ms)
            parts, options = self.parts(name), {"target_bytes": target_bytes} if target_bytes else {}
            if name == FACTS:
                held, most = parts.measure(chosen)[0], None
                months = parts.write(self._fact_rows(state, chosen).drop(PART), part, parts.ranges(held, total, **options))
            else:
                months, most = self._merge(state, name, chosen, part, total, options)
            batches: log.Ranges = {}
            for p in chosen:
                batches = log.union(batches, rel["parts"][p]["batches"])
            record: log.Record = [{"do": "remove", "in": name, "part": p, "months": ms} for p, ms in chosen.items()]
            if months:
                record.append(_add(name, part, months, batches, most))
            shared = [[s, int(b)] for s, bs in rel["own"].items() for b, p in bs.items() if p in chosen]
            record += [{"do": "share", "in": name, "batches": shared}, {"do": "fold", "in": name}]
            while True:
                if self.log.commit(version, record):
                    return self.versions(name)
                version, now = self.log.read()
                live = self._live(now, name)
                if now["dropped"] != state["dropped"] or any(m not in live.get(p, ()) for p, ms in chosen.items() for m in ms):
                    break  # another writer replaced what this merged: start over
            self.parts(name).delete(part)

    def _merge(self, state: log.State, name: str, chosen: dict[str, list[str]], part: str, total: int, options: dict) -> tuple[dict[str, int], int | None]:
        """Writes the merged states of live months of parts; returns the bytes of each month and ``most``.

        State rows go to the ranges in which they will lie and are merged there, so they move once and
        borders are sampled from files.  Only where values have to go into sketches are they merged first.
        """
        at, parts = self.rollups[name], self.parts(name)
        held, most = parts.measure(chosen, rollups.quantile_states(at))
        ranges = parts.ranges(held, total, tasks=self.spark.sparkContext.defaultParallelism, **options)
        rows = self._read(state, name, chosen).drop(PART)
        if rollups.keeps_values(at, most):
            merged = rollups.merge(parts.deal(rows, ranges), at, most, [MONTH])
            return parts.write(merged, part, ranges, dealt=True), most
        return parts.write(rollups.with_month(rollups.merge(rows.drop(MONTH), at), at), part, ranges), None

    def backfill(self, name: str) -> list[str]:
        """Aggregates stored facts into state columns that lack them, and only these; returns the columns.

        A rollup that did not exist when facts were stored lacks every column, one whose spec gained a
        measure or an aggregation only the new ones: older state files stay as they are, and a part
        with the new columns alone is written beside them.  May run at any time; a later replay of a
        batch aggregates its months from the facts.
        """
        at, filled = self.rollups[name], []
        while True:
            version, state = self.log.read()
            groups = log.relation(state, name)["covered"]
            stored = self._covered(state, FACTS)
            lacking: dict[str, list[str]] = {}
            for c in self._columns(name):
                if gap := log.minus(stored, groups.get(c, {})):
                    lacking.setdefault(repr(sorted(gap.items())), []).append(c)
            if not lacking:
                return filled
            columns = next(iter(lacking.values()))
            gap = log.minus(stored, groups.get(columns[0], {}))
            live = {p: m for p, m in self._live(state, FACTS).items() if _meet(log.relation(state, FACTS)["parts"][p]["batches"], gap)}
            rows = self._fact_rows(state, live).where(log.in_ranges(gap, F.col(ROW_SOURCE), F.col(ROW_BATCH)))
            part = uuid.uuid4().hex
            states, most = rollups.partial_and_most(rows, at, only=columns)
            months = self.parts(name).write(rollups.with_month(states, at), part)
            record = self._added(name, part if months else None, months, gap, columns, most)
            while not self.log.commit(version, record):
                version, now = self.log.read()
                if now["dropped"] != state["dropped"] or _own(now, FACTS, gap) != _own(state, FACTS, gap):
                    break  # a batch was replayed meanwhile
            else:
                filled += columns
                continue
            self.parts(name).delete(part)

    def vacuum(self, keep_versions: int = 1, orphan_hours: float = 24.0) -> dict[str, int]:
        """Deletes what no reader of the newest ``keep_versions`` compactions needs (the state before
        the first one counts as one), parts that no commit names and that are older than
        ``orphan_hours`` (left by writers that failed), and old log records.  Returns counts."""
        counts = {"parts": 0, "orphans": 0}
        for name in [FACTS, *self.rollups]:
            version, state = self.log.read()
            folds = log.relation(state, name)["folds"]
            kept = [0, *folds][max(0, len(folds) + 1 - max(1, keep_versions))]
            dead = [d for d in state["dead"] if d[1] == name and d[0] <= kept]
            for _, _, part, months in dead:
                self.parts(name).delete(part, months)
                counts["parts"] += 1
            while dead and not self.log.commit(version, [{"do": "forget", "in": name, "until": kept}]):
                version, _ = self.log.read()
            # Listed before the log is read: a part that is committed in between is known.
            on_disk = self.parts(name).parts_on_disk()
            _, state = self.log.read()
            known = {*log.relation(state, name)["parts"], *(d[2] for d in state["dead"] if d[1] == name)}
            for part, changed in on_disk.items():
                if part not in known and changed < time.time() - orphan_hours * 3600:
                    self.parts(name).delete(part)
                    counts["orphans"] += 1
        self.log.trim()
        return counts


def _add(name: str, part: str, months: dict[str, int], batches: log.Ranges, most: int | None) -> dict:
    known = {} if most is None else {"most": most}
    return {"do": "add", "in": name, "part": part, "months": months, "batches": batches, **known}


def _own(state: log.State, name: str, batches: log.Ranges) -> dict:
    own = log.relation(state, name)["own"]
    return {(s, b): p for s, bs in own.items() for b, p in bs.items() if log.has(batches, s, int(b))}


def _meet(a: log.Ranges, b: log.Ranges) -> bool:
    return log.minus(a, b) != a


def _is_any(column: Column, values: Sequence) -> Column:
    some = [v for v in values if v is not None]
    cond = column.isin(some) if some else F.lit(False)
    return cond | column.isNull() if len(some) < len(values) else cond
