"""Exact top-k search over binary codes by incremental multi-index hashing (operator 9).

A code is cut into m segments of 16 bits, each with an index from value to codes.  Codes within
distance m * (r + 1) - 1 of a query agree with it in some segment up to r bits, so probing every
value within r bits of each of the query's segments finds them all.  The radius r grows until the
k-th verified distance is covered; queries that are done drop out.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollstate.session import scratch_dir

BITS = 16
#: Groups into which a code's members are dealt before its first k are chosen.
SALTS = 64


def binary_codes(df: DataFrame, vector: str, segments: int) -> Column:
    """Sign code of a vector as 16-bit segments: a bit is set where the value is above 0.

    Null, NaN and missing entries give bit 0, a null vector all zeros.
    """

    def segment(s: int) -> Column:
        bits = F.transform(
            F.sequence(F.lit(s * BITS), F.lit(s * BITS + BITS - 1)),
            lambda i: F.coalesce(((F.get(F.col(vector), i) > 0) & ~F.isnan(F.get(F.col(vector), i))).cast("int"), F.lit(0)),
        )
        return F.aggregate(bits, F.lit(0), lambda acc, bit: acc * 2 + bit)

    return F.array(*[segment(s) for s in range(segments)])


def _distance(a: Column, b: Column, s: int) -> Column:
    return F.bit_count(F.get(a, F.lit(s)).bitwiseXOR(F.get(b, F.lit(s))))


def _first_by(df: DataFrame, by: str, order: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def search(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows nearest to every query row by Hamming distance: ``query_id``, ``rank``, key, ``distance``.

    Queries are searched against all rows, themselves included; ties go to the smaller key.  Rows
    with the same code are one entry of the index, and queries with the same code are searched
    once.  Rows with a null key are left out.  A table of fewer than k rows gives them all; an
    empty one an empty result.  A repeated key is a row of its own and may be found twice.
    """
    spark = df.sparkSession
    base = scratch_dir(spark, "hamming")
    longest = df.agg(F.max(F.size(vector))).first()[0]
    m = max(1, -(-max(longest or 0, 0) // BITS))
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_id"), binary_codes(df, vector, m).alias("_code"), F.coalesce(is_query, F.lit(False)).alias("_query")
    )
    rows.write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    rows.groupBy("_code").agg(
        F.min("_id").alias("_entry"), F.count(F.lit(1)).alias("_members"), F.max("_query").alias("_asked")
    ).write.parquet(f"{base}/entries")
    entries = spark.read.parquet(f"{base}/entries")
    index = entries.select(
        F.col("_code").alias("_found"), F.col("_entry").alias("_found_id"), "_members", F.posexplode("_code").alias("_s", "_value")
    )
    active = entries.filter("_asked").select("_entry", "_code", F.lit(None).cast("int").alias("_bound"))
    best = None
    for r in range(BITS + 1):
        if r and active.isEmpty():
            break
        masks = [sum(1 << b for b in bits) for bits in combinations(range(BITS), r)]
        probes = active.select("*", F.posexplode("_code").alias("_s", "_own")).select(
            "_entry", "_code", "_bound", "_s", F.explode(F.transform(F.lit(masks), lambda x: F.col("_own").bitwiseXOR(x))).alias("_value")
        )
        near = [_distance(F.col("_code"), F.col("_found"), s) for s in range(m)]
        total = reduce(lambda a, b: a + b, near)
        # Found here and nowhere before: no segment is nearer than r, and none before this one is as near.
        first_here = reduce(lambda a, b: a & b, [(near[s] > r) | ((near[s] == r) & (F.col("_s") <= s)) for s in range(m)])
        better = F.col("_bound").isNull() | (total <= F.col("_bound"))
        # Probes are far more rows than the planner sees in the file of queries: never broadcast them.
        x = index.withColumnRenamed("_s", "_at").withColumnRenamed("_value", "_is").hint("merge")
        found = probes.join(x, (F.col("_s") == F.col("_at")) & (F.col("_value") == F.col("_is")) & first_here & better)
        found = found.select("_entry", "_code", "_found_id", "_members", total.cast("int").alias("_distance"))
        kept = found if best is None else best.unionByName(found)
        _first_by(kept, "_entry", ["_distance", "_found_id"], k).write.parquet(f"{base}/best{r}")
        best = spark.read.parquet(f"{base}/best{r}")
        # The distance of the k-th row so far, if there are so many.
        w = Window.partitionBy("_entry").orderBy("_distance", "_found_id")
        counted = best.withColumn("_reached", F.sum("_members").over(w))
        bound = counted.groupBy("_entry").agg(F.min(F.when(F.col("_reached") >= k, F.col("_distance"))).alias("_bound"))
        covered = m * (r + 1) - 1
        asked = entries.filter("_asked").select("_entry", "_code")
        active = asked.join(bound, "_entry", "left").filter(F.col("_bound").isNull() | (F.col("_bound") > covered))
        active.write.parquet(f"{base}/active{r}")
        active = spark.read.parquet(f"{base}/active{r}")
    salted = Window.partitionBy("_code", F.pmod(F.xxhash64("_id"), F.lit(SALTS))).orderBy("_id")
    members = rows.withColumn("_i", F.row_number().over(salted)).filter(F.col("_i") <= k)
    members = _first_by(members, "_code", ["_id"], k).join(entries.select("_code", "_entry"), "_code")
    hits = best.select("_entry", "_found_id", "_distance").join(
        members.select(F.col("_entry").alias("_found_id"), F.col("_id").alias(key)), "_found_id"
    )
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("_entry").orderBy("_distance", key)))
    ranked = ranked.filter(F.col("rank") <= k).select("_entry", "rank", key, F.col("_distance").alias("distance"))
    queries = rows.filter("_query").join(entries.select("_code", "_entry"), "_code").select(F.col("_id").alias("query_id"), "_entry")
    return queries.join(ranked, "_entry").select("query_id", "rank", key, "distance")

