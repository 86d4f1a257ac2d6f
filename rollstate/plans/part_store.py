"""Parts of one relation: Parquet files by month, sorted by id, and reads that open only what is asked.

Layout::

    <root>/part=<name>/yyyymm=<YYYYMM>/*.zstd.parquet
    <root>/part=<name>/_files.json                     id range of every file of a compacted part

A part is written once and never changed; which parts and months are live is the commit log's
business.  Within a month rows are sorted by id and time, so row groups cover narrow ranges and
Parquet's statistics skip them.  A compacted part is range-partitioned on (month, id, time) from
sampled borders: its files cover disjoint id ranges, whose bounds let a reader leave files out.
There are as many ranges as the rows need in memory, which their compressed files do not tell: a
task reads and sorts the same amount however much is compacted and however well it compresses.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollstate.plans import files

MONTH = "yyyymm"
PART = "part"
#: Bytes that a file of a compacted part has at most, about.
TARGET_BYTES = 512 << 20
#: Bytes of rows, as they lie in memory, that a task of a compaction reads and sorts, about.
TASK_BYTES = 256 << 20
#: Bytes of rows for which a compaction of states takes another task, as long as there are cores.
BUSY_BYTES = 32 << 20
MAX_RECORDS = 5_000_000
#: Months by part; None for a part all of whose months are wanted and live.
Live = dict[str, Iterable[str] | None]


class PartStore:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, id_column: str, order: Sequence[str]):
        """``schema`` without the month; files are sorted by ``order``, whose first column is the id."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.id_column, self.order = id_column, list(order)

    def _path(self, part: str) -> str:
        return f"{self.root}/{PART}={part}"

    def measure(self, live: Live, quantiles: Sequence[str] = ()) -> tuple[int, int | None]:
        """Bytes in memory of the rows of live months of parts; and how many values the ``quantiles``
        states of one key have at most, as a part has one row of it; None where there is a sketch."""
        fixed = sum(b for f in self.schema.fields if (b := fixed_bytes(f.dataType)) is not None)
        columns = [memory_bytes(F.col(f"`{f.name}`"), f.dataType) for f in self.schema.fields if fixed_bytes(f.dataType) is None]
        held = F.sum(reduce(lambda a, b: a + b, columns, F.lit(fixed).cast("long"))).alias("held")
        states = [F.col(f"`{name}`") for name in quantiles]
        values = [F.max(F.size(s["values"])) for s in states]
        sketches = [F.count(s["sketch"]) for s in states]
        found = self.read(live).groupBy(PART).agg(held, *[v.alias(f"v{i}") for i, v in enumerate(values)], *[k.alias(f"k{i}") for i, k in enumerate(sketches)])
        rows = found.collect()  # one for each part
        most = sum(max([r[f"v{i}"] or 0 for i in range(len(states))], default=0) for r in rows)
        return sum(r.held or 0 for r in rows), None if any(r[f"k{i}"] for r in rows for i in range(len(states))) else most

    @staticmethod
    def ranges(held: int, file_bytes: int, target_bytes: int = TARGET_BYTES, tasks: int = 1) -> int:
        """Into how many ranges rows go when they are compacted: none has more than about ``TASK_BYTES``
        in memory, or files of more than about ``target_bytes``; ``tasks`` or more where each of them
        has ``BUSY_BYTES``."""
        return max(1, math.ceil(held / TASK_BYTES), math.ceil(file_bytes / target_bytes), min(tasks, held // BUSY_BYTES))

    def deal(self, df: DataFrame, ranges: int) -> DataFrame:
        """Rows partitioned into ranges of month and order."""
        return df.repartitionByRange(ranges, MONTH, *self._cols(self.order))

    def write(self, df: DataFrame, part: str, ranges: int | None = None, dealt: bool = False) -> dict[str, int]:
        """Writes a part; ``df`` has the schema's columns and ``yyyymm``.  Returns the bytes of each month.

        A batch is rebalanced by month (adaptive execution splits a month that is too large for one
        task and joins small ones).  What is compacted is partitioned into ``ranges`` of month and
        order, unless it is ``dealt`` so already, and the id bounds of every file are kept beside it.
        """
        if not dealt:
            df = df.hint("rebalance", MONTH) if ranges is None else self.deal(df, ranges)
        path = self._path(part)
        (
            # The writer needs its input ordered by the partition column; leading with it keeps the
            # order inside every file instead of letting the writer sort by the partition alone.
            df.sortWithinPartitions(MONTH, *self._cols(self.order))
            .write.option("compression", "zstd")
            .option("maxRecordsPerFile", MAX_RECORDS)
            .partitionBy(MONTH)
            .parquet(path)
        )
        months: dict[str, int] = {}
        for name, size in files.sizes(self.spark, path, f"{MONTH}=*/*.parquet").items():
            month = name.split("/")[0].split("=", 1)[1]
            months[month] = months.get(month, 0) + size
        if not months:
            files.delete(self.spark, path)
        elif ranges is not None:
            self._keep_bounds(part, months)
        return months

    def _comparable(self, ident: Column) -> Column:
        """An id as JSON can hold it, in the same order: a number or a text."""
        return ident if isinstance(self.schema[self.id_column].dataType, T.IntegralType) else ident.cast("string")

    def _cols(self, names: Sequence[str]) -> list[Column]:
        return [F.col(f"`{n}`") for n in names]

    def _keep_bounds(self, part: str, months: dict[str, int]) -> None:
        ident = self._comparable(F.col(f"`{self.id_column}`"))
        rows = self.read({part: None}).select(MONTH, ident.alias("_id"), F.col("_metadata.file_name").alias("_file"))
        bounds = rows.groupBy(MONTH, "_file").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"), F.count("_id").alias("n"), F.count(F.lit(1)).alias("rows"))
        # One row for each file written: as many as the listing that the driver goes through anyway.
        kept: dict[str, list] = {}
        for r in bounds.collect():
            month = files.NULL_PARTITION if r[MONTH] is None else str(r[MONTH])
            kept.setdefault(month, []).append([r["_file"], r.lo, r.hi, r.n < r.rows])
        files.create_json(self.spark, f"{self._path(part)}/_files.json", kept)

    def read(self, live: Live, ids: Sequence | None = None) -> DataFrame:
        """Rows of live months of parts, with ``yyyymm`` and ``part``; with ``ids``, files that cannot
        hold any of them are left out (rows still have to be filtered).  Only the named folders are
        listed, so what else lies below the root costs nothing."""
        if ids is not None and not isinstance(self.schema[self.id_column].dataType, T.IntegralType):
            ids = [None if i is None else str(i) for i in ids]
        schema = T.StructType([*self.schema.fields, T.StructField(MONTH, T.IntegerType()), T.StructField(PART, T.StringType())])
        paths = []
        for part, months in sorted(live.items()):
            if months is None and ids is None:
                paths.append(self._path(part))
                continue
            bounds = files.read_json(self.spark, f"{self._path(part)}/_files.json") if ids is not None else None
            if months is None:
                listed = [n for n in files.names(self.spark, self._path(part)) if n.startswith(f"{MONTH}=")]
                months = [n.split("=", 1)[1] for n in listed] if bounds is None else bounds
            for month in sorted(months):
                folder = f"{self._path(part)}/{MONTH}={month}"
                if bounds is None:
                    paths.append(folder)
                else:
                    paths += [f"{folder}/{f}" for f, lo, hi, nulls in bounds.get(month, []) if any(_within(i, lo, hi, nulls) for i in ids)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def delete(self, part: str, months: Iterable[str] | None = None) -> None:
        """Deletes months of a part, and the part itself once it has none left (or if ``months`` is None)."""
        for month in months or ():
            files.delete(self.spark, f"{self._path(part)}/{MONTH}={month}")
        left = [n for n in files.names(self.spark, self._path(part)) if n.startswith(f"{MONTH}=")]
        if months is None or not left:
            files.delete(self.spark, self._path(part))

    def parts_on_disk(self) -> dict[str, float]:
        """Every part folder with the time of its last change, live or not."""
        found = [n for n in files.names(self.spark, self.root) if n.startswith(f"{PART}=")]
        return {n.split("=", 1)[1]: files.modified(self.spark, f"{self.root}/{n}") for n in found}


def memory_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value in a row in memory, without the gaps that align it."""
    if isinstance(kind, T.StructType):
        fields = [memory_bytes(value[f.name], f.dataType) for f in kind.fields]
        return F.when(value.isNull(), F.lit(8)).otherwise(reduce(lambda a, b: a + b, fields, F.lit(16)))
    if isinstance(kind, T.ArrayType):  # the states' arrays hold numbers
        return 16 + 8 * F.coalesce(F.size(value), F.lit(0)).cast("long")
    if isinstance(kind, T.StringType | T.BinaryType):
        return 8 + F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    return F.lit(8).cast("long")


def fixed_bytes(kind: T.DataType) -> int | None:
    """Bytes of any value of a type in a row in memory, at most; None if they depend on the value."""
    if isinstance(kind, T.StructType):
        fields = [fixed_bytes(f.dataType) for f in kind.fields]
        return None if None in fields else 16 + sum(fields)
    return None if isinstance(kind, T.ArrayType | T.StringType | T.BinaryType) else 8


def _within(value, lo, hi, nulls: bool) -> bool:
    if value is None:
        return nulls
    return lo is not None and lo <= value <= hi


def tier(sizes: dict[str, int], growth: float) -> list[str]:
    """Parts of one month to merge: the smallest ones, as long as the next is at most ``growth`` times
    as large as all before it together.  Every row is then rewritten a number of times that grows with
    the logarithm of the month's size."""
    order = sorted(sizes, key=lambda p: (sizes[p], p))
    chosen, total = 0, 0
    for i, part in enumerate(order):
        if i and sizes[part] <= growth * total:
            chosen = i + 1
        total += sizes[part]
    return order[:chosen]
