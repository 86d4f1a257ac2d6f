"""``Engine``: a spec bound to a Spark session and a root folder on the shared file system.

    <root>/<table>/log/…        commits of the table and its rollups (``plans.commit_log``)
    <root>/<table>/facts/…      fact rows (``plans.part_store`` layout)
    <root>/<table>/<rollup>/…   states of a rollup

Every operation is idempotent per ``(source_id, batch_id)``: replaying a batch replaces what it wrote, in
facts and rollups by one commit, also by nothing and also after compactions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from rollstate.functions import geo
from rollstate.operators.dims import enrich as join_small_on
from rollstate.plans.table_store import FACTS, TableStore
from rollstate.sources import store
from rollstate.spec import Spec, load_spec


class Engine:
    def __init__(self, spark: SparkSession, spec: Spec | Mapping, root: str):
        self.spark = spark
        self.spec = spec if isinstance(spec, Spec) else load_spec(spec)
        self.root = root.rstrip("/")
        self._tables: dict[str, TableStore] = {}
        self._named: dict[str, Callable[[], DataFrame]] = {}

    def table(self, name: str) -> TableStore:
        """The store of a fact table and its rollups."""
        if name not in self._tables:
            self._tables[name] = TableStore(self.spark, self.spec, self.spec.table(name), f"{self.root}/{name}")
        return self._tables[name]

    def _of(self, rollup: str) -> TableStore:
        return self.table(self.spec.rollup(rollup).table.name)

    # ------------------------------------------------------------------ setup and reads
    def register(self, name: str, relation: DataFrame | Callable[[], DataFrame]) -> None:
        """Name a relation for ``sql`` (create-or-replace): a dimension's frame, or a function that
        opens it anew for every query."""
        self._named[name] = relation if callable(relation) else (lambda: relation)

    def setup(self) -> list[str]:
        """Name every fact table and rollup and register each as a temp view (create-or-replace,
        idempotent); returns the names.  May run before any data exists.  A temp view shows the data
        of its registration; ``sql`` always shows the newest."""
        for t in self.spec.tables:
            self.register(t.name, lambda name=t.name: self.facts(name))
        for at in self.spec.analytical_tables:
            self.register(at.name, lambda name=at.name: self.view(name))
        for name in self._named:
            self._open(name)
        return [*(t.name for t in self.spec.tables), *(at.name for at in self.spec.analytical_tables)]

    def _open(self, name: str) -> None:
        self._named[name]().createOrReplaceTempView("`" + name.replace("`", "``") + "`")

    def sql(self, text: str) -> DataFrame:
        """Run SQL over the named relations; those whose name stands in the text are opened now, so
        rows ingested after ``setup`` are seen.  Any name works, in backticks where SQL asks for them."""
        if not self._named:
            self.setup()
        plain = text.replace("``", "`").lower()
        for name in self._named:
            if name.lower() in plain:
                self._open(name)
        return self.spark.sql(text)

    def facts(self, table: str, ids: Sequence | None = None, lo=None, hi=None) -> DataFrame:
        """Live fact rows; only of ``ids`` and of ``lo <= time < hi`` where given, which leaves out
        the files of other months and, once compacted, of other ids."""
        return self.table(table).facts(ids, lo, hi)

    def view(self, rollup: str, ids: Sequence | None = None, lo=None, hi=None) -> DataFrame:
        """Merge-on-read view of a rollup; only of ``ids`` and of buckets that start at or after ``lo``
        and before ``hi`` where given: states of other months are not read."""
        return self._of(rollup).view(rollup, ids, lo, hi)

    def enriched_view(self, rollup: str, dim: DataFrame, dim_key: str, how: str = "inner") -> DataFrame:
        """A rollup view joined with a dimension on the rollup's id (size-checked broadcast)."""
        return join_small_on(self.view(rollup), dim, self.spec.rollup(rollup).table.id, dim_key, how)

    def map_view(
        self, rollup: str, dim: DataFrame, dim_key: str, lon: str = "lon", lat: str = "lat", category: str = "label"
    ) -> DataFrame:
        """Map-ready rows of a last-value rollup: enriched with the dimension, plus point geometry,
        WKT, display time and a colour category."""
        at = self.spec.rollup(rollup)
        return geo.map_ready(self.enriched_view(rollup, dim, dim_key), at.table.ts, lon, lat, category)

    # ------------------------------------------------------------------ writes
    def ingest(
        self,
        df: DataFrame,
        table: str,
        source_id: str,
        batch_id: int,
        write_facts: bool = True,
        cache: bool = True,
        dedup: bool = False,
    ) -> None:
        """Store one batch of rows: facts, then the partial states of every rollup of the table.

        The batch is read once per output (facts, each rollup); with ``cache`` it is kept in executor
        memory/disk for that time.  Pass ``cache=False`` when ``df`` is already cached.  ``dedup``
        drops repeated ``(id, ts)`` rows within the batch (opt-in; counts otherwise include
        duplicate deliveries, as the stream delivered them)."""
        t = self.spec.table(table)
        cache = cache and int(write_facts) + len(self.spec.rollups_of(table)) > 1  # only worth it when read twice
        rows = store.conform(df, t)
        if dedup:
            rows = rows.dropDuplicates([t.id, t.ts])
        if cache:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.table(table).ingest(rows, source_id, batch_id, write_facts)
        finally:
            if cache:
                rows.unpersist()

    def compact(self, rollup: str, keep_versions: int | None = None, full: bool = False) -> int:
        """Merge small state parts, month by month (``full``: all of them); with ``keep_versions``,
        delete what only readers of older compactions need.  Returns how many compactions there were."""
        done = self._of(rollup).compact(rollup, full)
        if keep_versions:
            self._of(rollup).vacuum(keep_versions)
        return done

    def compact_facts(self, table: str, keep_versions: int | None = None, full: bool = False, target_bytes: int | None = None) -> int:
        """Merge small fact parts, month by month, into files of disjoint id ranges of about
        ``target_bytes`` each; otherwise like ``compact``."""
        done = self.table(table).compact(FACTS, full, target_bytes=target_bytes)
        if keep_versions:
            self.table(table).vacuum(keep_versions)
        return done

    def backfill(self, rollup: str) -> list[str]:
        """Aggregate stored facts into state columns that lack them (a new rollup, or one with a new
        measure or aggregation); returns the columns.  May run at any time."""
        return self._of(rollup).backfill(rollup)
