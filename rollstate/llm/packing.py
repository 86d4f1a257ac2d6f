"""Packing into length buckets of least padding (operator 8).

The lengths of all documents are counted; dynamic programming over that histogram chooses the
bucket borders with the least total padding; inside a bucket, batches of a token budget are filled
in order of length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollstate.operators.dims import join_small
from rollstate.session import scratch_dir

#: Lengths up to this are counted exactly, longer ones rounded up by less than 1 / EXACT of
#: themselves, so the histogram has at most EXACT entries and EXACT more each time lengths double.
EXACT = 2048
#: Shares of a bucket that are ranked apart; a bucket of any size spreads over so many groups.
SALTS = 64


def rounded(length: Column) -> Column:
    """The length to which a document is padded within the histogram's resolution; at least 1."""
    n = F.greatest(length, F.lit(1)).cast("long")
    grain = F.when(n <= EXACT, F.lit(1)).otherwise(
        F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double") / EXACT)) - 1)
    ).cast("long")
    return F.when(n <= EXACT, n).otherwise((F.ceil(n / grain) * grain).cast("long"))


@dataclass(frozen=True)
class Buckets:
    borders: list[int]  # each bucket's padded length, ascending
    padding: int  # total padding of all documents


def best_borders(lengths: list[int], counts: list[int], buckets: int) -> Buckets:
    """Borders (values of ``lengths``, ascending) with the least sum of (border - length) * count.

    cost[k][j]: least padded total of the first j lengths in k buckets.  The cost of one bucket
    obeys the quadrangle inequality, so the best split moves one way and each level is solved by
    divide and conquer in O(m log m) for m lengths.
    """
    m = len(lengths)
    if not m:
        return Buckets([], 0)
    size = np.asarray(lengths, dtype=np.float64)
    seen = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    cost = np.concatenate([[0.0], np.full(m, np.inf)])
    splits = []
    for _ in range(min(buckets, m)):
        new, split = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=np.int64)
        new[0] = 0.0
        todo = [(1, m, 0, m - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(first, min(mid - 1, last) + 1)
            total = cost[i] + size[mid - 1] * (seen[mid] - seen[i])
            best = int(np.argmin(total))
            new[mid], split[mid] = total[best], i[best]
            todo += [(lo, mid - 1, first, int(i[best])), (mid + 1, hi, int(i[best]), last)]
        cost = new
        splits.append(split)
    borders, j = [], m
    for split in reversed(splits):
        if j:
            borders.append(int(lengths[j - 1]))
            j = int(split[j])
    return Buckets(sorted(borders), int(cost[m] - float(np.dot(size, np.asarray(counts, dtype=np.float64)))))


def choose_buckets(df: DataFrame, length: Column, buckets: int) -> Buckets:
    """Best borders over the lengths of all rows.  Only the histogram, bounded by EXACT, reaches the driver."""
    histogram = df.select(rounded(length).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()
    rows = sorted((r.n, r.c) for r in histogram if r.n is not None)
    return best_borders([n for n, _ in rows], [c for _, c in rows], buckets)


def pack(df: DataFrame, key: str, length: Column, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """Puts every row into a length bucket and a batch; columns ``key``, length, bucket_len, batch_id, slot, padding.

    A batch holds budget // bucket_len rows (at least one) of one bucket, all of them full but a
    bucket's last.  Rows are dealt into SALTS groups by a hash of the key; their sizes give each
    group's first rank, so batches run on across groups and no task holds a whole bucket.  A null
    length counts as 0 and pads to 1; equal keys are packed each for itself; an empty table gives
    an empty result.
    """
    # Measured once and written: lengths are used several times, and measuring reads whole texts.
    measured = f"{scratch_dir(df.sparkSession, 'packing')}/lengths"
    df.select(F.col(key).alias("_key"), F.coalesce(length, F.lit(0)).cast("long").alias("_length")).write.parquet(measured)
    rows = df.sparkSession.read.parquet(measured)
    borders = choose_buckets(rows, F.col("_length"), buckets).borders or [1]
    fits = F.filter(F.lit(borders).cast("array<long>"), lambda b: b >= rounded(F.col("_length")))
    rows = rows.withColumn("_bucket", F.get(fits, F.lit(0)))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)))
    sizes = rows.groupBy("_bucket", "_salt").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_bucket").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", "_salt", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy("_bucket", "_salt").orderBy("_length", "_key")
    ranked = join_small(rows.withColumn("_rank", F.row_number().over(order) - 1), offsets, ["_bucket", "_salt"])
    rank = F.col("_first") + F.col("_rank")
    per_batch = F.greatest(F.floor(F.lit(budget) / F.col("_bucket")), F.lit(1))
    return ranked.select(
        F.col("_key").alias(key),
        F.col("_length").alias("length"),
        F.col("_bucket").alias("bucket_len"),
        F.concat_ws("-", F.col("_bucket"), F.floor(rank / per_batch)).alias("batch_id"),
        (rank % per_batch).cast("long").alias("slot"),
        (F.col("_bucket") - F.greatest("_length", F.lit(1))).alias("padding"),
    )
