"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of one Arrow batch sent to a Python worker; bounds a worker's memory whatever the row sizes.
ARROW_BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def bound_batches(spark: SparkSession) -> None:
    """Limits Arrow batches by bytes as well as by rows."""
    for key, value in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES)),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "5000"),
    ):
        spark.conf.set(key, value)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def map_arrow(
    df: DataFrame,
    outputs: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Adds ``outputs`` to every row by a function over Arrow batches, built once per task by ``make``.

    Input columns are kept, except those in ``drop`` and those whose name (without regard to case)
    an output takes.
    """
    bound_batches(df.sparkSession)
    taken = {name.lower() for name, _ in outputs} | {c.lower() for c in drop}
    keep = [c for c in df.columns if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, t) for n, t in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        names = keep + [n for n, _ in outputs]
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + fn(b), names=names)

    return df.mapInArrow(run, schema)


def list_array(values, lengths, value_type: pa.DataType) -> pa.ListArray:
    """Arrow list column of consecutive runs of ``values``."""
    import numpy as np

    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, value_type))
