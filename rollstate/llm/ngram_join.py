"""Similarity join on word n-grams by banded MinHash (operator 5).

Every distinct n-gram set gets a signature for each of ``TREES`` bands.  Bands have a fixed depth,
the greatest up to ``FULL_DEPTH`` at which pairs at the threshold meet in some band with the target
probability; there are no sorted prefix trees, and the depth does not follow the data.  Sets that meet are
gathered into clusters, and inside a cluster every pair is verified on the exact sets, in blocks
of bounded size that give link counts and class ties, never rows of pairs.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollstate.operators.dims import join_small
from rollstate.session import scratch_dir

from .common import list_array, map_arrow
from .components import components

WORDS, THRESHOLD = 5, 0.8
TREES, FULL_DEPTH, TARGET_RECALL = 16, 6, 0.9995
#: Sets, and n-grams in them, of one verification block; larger clusters are split into blocks.
BLOCK_SETS, BLOCK_GRAMS = 512, 400_000
CACHE_WORDS = 300_000
SEED = 20_231

_MIX = np.uint64(0x9E3779B97F4A7C15)


def recall(depth: int, threshold: float, trees: int) -> float:
    """Probability that a pair of this likeness shares a prefix of this depth in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def prefix_depth(threshold: float, trees: int = TREES, full: int = FULL_DEPTH, target: float = TARGET_RECALL) -> int:
    """Shortens the matched prefix from full depth until the target recall is reached (at least 1)."""
    depth = full
    while depth > 1 and recall(depth, threshold, trees) < target:
        depth -= 1
    return depth


class Grams:
    """Sets of hashed word n-grams of texts."""

    def __init__(self, words: int):
        self.n = words
        self.hashes: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        h = self.hashes.get(word)
        if h is None:
            if len(self.hashes) > CACHE_WORDS:
                self.hashes.clear()
            h = self.hashes[word] = xxhash.xxh64_intdigest(word)
        return h

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes; a text of fewer than n words has one n-gram of all of them, one without words none."""
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = np.fromiter(map(self._hash, words), np.uint64, len(words))
        n = min(self.n, len(h))
        out = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : len(h) - n + 1 + k]
        out = (out ^ (out >> np.uint64(32))) * _MIX
        return np.unique(out ^ (out >> np.uint64(29)))


def _signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` MinHash values (32 bits) of every set; zeros for an empty one."""
    out = np.zeros((len(sets), count), dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        factors = np.random.default_rng(SEED).integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for j, factor in enumerate(factors):
            out[full, j] = np.minimum.reduceat(((flat ^ (flat >> np.uint64(31))) * factor) >> np.uint64(32), starts)
    return out


def _sets(df: DataFrame, key: str, text: str, words: int, trees: int, depth: int) -> DataFrame:
    """``_id``, ``_key`` (digest of the n-gram set), ``_grams`` (its size) and ``_sig`` (depth values for each tree)."""

    def make():
        grams = Grams(words)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            keys, sizes, sigs = [], [], []
            column = batch.column("_text")
            for at in range(0, batch.num_rows, 256):
                sets = [grams(t) for t in column.slice(at, 256).to_pylist()]
                keys += [hashlib.md5(s.tobytes()).digest() for s in sets]
                sizes += map(len, sets)
                sigs += [row.tobytes() for row in _signatures(sets, trees * depth)]
            return [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())]

        return run

    rows = df.select(F.col(key).cast("long").alias("_id"), F.md5(text).alias("_row"), F.col(text).alias("_text"))
    return map_arrow(rows, [("_key", T.BinaryType()), ("_grams", T.LongType()), ("_sig", T.BinaryType())], make, drop=("_text",))


def _meetings(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """Edges from the least node under each shared prefix to the others there."""
    at = F.posexplode(F.array(*[F.substring("_sig", t * depth * 4 + 1, depth * 4) for t in range(trees)])).alias("_tree", "_prefix")
    members = nodes.filter("_grams > 0").select("_node", at).select("_node", F.xxhash64("_tree", "_prefix").alias("_bucket"))
    shared = members.groupBy("_bucket").agg(F.min("_node").alias("a"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return members.join(shared, "_bucket").select("a", F.col("_node").alias("b")).filter("a <> b")


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix, by ``left`` and ``right`` (positions in ``sets``): exact likeness at least ``threshold``.

    Shared n-grams are counted by matrix products over slices of the n-grams that several sets have.
    """
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    several = times[place] > 1
    owner, place = owner[several], number[place[several]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((len(left), len(right)), dtype=np.float64)
    width = 4096
    for start in range(0, int(number[-1]) + 1, width):
        lo, hi = np.searchsorted(place, [start, start + width])
        x = np.zeros((len(sets), width), dtype=np.float32)
        x[owner[lo:hi], place[lo:hi] - start] = 1
        shared += x[left] @ x[right].T
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    either = sizes[left][:, None] + sizes[right][None, :] - shared
    return shared >= threshold * either - 1e-9


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least position tied to each of n positions by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(clusters: DataFrame, texts: DataFrame, key: str, text: str, words: int, threshold: float) -> DataFrame:
    """``node``, ``n_links`` (in part, to be summed) and ``root`` (a node of the same class), by exact sets."""
    sizes = clusters.groupBy("_cluster").agg(F.count(F.lit(1)).alias("_sets"), F.sum("_grams").alias("_total"))
    blocks = F.greatest(F.ceil(F.col("_sets") / BLOCK_SETS), F.ceil(F.col("_total") / BLOCK_GRAMS)).cast("int").alias("_blocks")
    placed = clusters.join(sizes.select("_cluster", blocks, "_total"), "_cluster")
    wanted = placed.select("_node", F.col("_first").alias("_wanted"), "_key", "_cluster", "_blocks", "_total")
    one = F.struct(F.col(key).isNull(), F.col(key).cast("long"), F.md5(text))
    rows = join_small(texts.select(F.xxhash64(one).alias("_row"), F.col(text).alias("_text")), wanted, F.col("_row") == F.col("_wanted"))

    def make():
        grams, seen = Grams(words), set()

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            sets = [grams(t) for t in batch.column("_text").to_pylist()]
            same = []
            for s, k, node in zip(sets, batch.column("_key").to_pylist(), batch.column("_node").to_pylist(), strict=True):
                same.append(node not in seen and hashlib.md5(s.tobytes()).digest() == k)  # a repeated row once a task
                if same[-1]:
                    seen.add(node)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            return [list_array(flat, [len(s) for s in sets], pa.int64()), pa.array(same, pa.bool_())]

        return run

    read = map_arrow(rows.drop("_wanted", "_row"), [("_set", T.ArrayType(T.LongType())), ("_same", T.BooleanType())], make, drop=("_text", "_key"))
    # Another row may have the same hash; its set tells.  Rows of one id and text are the same set.
    read = read.filter("_same").drop("_same").withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    # A block meets every block of its cluster; small clusters share a task.
    others = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    spread = read.select("*", others).withColumn("_lo", F.least("_block", "_other")).withColumn("_hi", F.greatest("_block", "_other"))
    few = F.col("_blocks") == 1
    spread = spread.withColumn("_task", F.when(few, F.pmod(F.xxhash64("_cluster"), F.lit(_bins(placed)))).otherwise(F.xxhash64("_cluster", "_lo", "_hi")))
    spread = spread.select("_task", "_cluster", "_lo", "_hi", "_block", "_node", "_set")
    schema = "node long, n_links long, root long"

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_cluster", "ascending"), ("_lo", "ascending"), ("_hi", "ascending"), ("_node", "ascending")])
        columns = {c: np.asarray(table[c]) for c in ("_cluster", "_lo", "_hi", "_block", "_node")}
        lists = table["_set"].combine_chunks()
        values, ends = np.asarray(lists.values), np.asarray(lists.offsets)
        edges = np.flatnonzero(np.any([np.diff(columns[c]) != 0 for c in ("_cluster", "_lo", "_hi")], axis=0)) + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for rows in np.split(np.arange(table.num_rows), edges):
            nodes = columns["_node"][rows]
            rows = rows[np.concatenate([[True], nodes[1:] != nodes[:-1]])]  # repeated rows once
            nodes = columns["_node"][rows]
            if len(rows) < 2:
                continue
            sets = [values[ends[r] : ends[r + 1]] for r in rows]
            lo, hi, block = columns["_lo"][rows[0]], columns["_hi"][rows[0]], columns["_block"][rows]
            left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            if not len(left) or not len(right):
                continue
            linked = _links(sets, left, right, threshold)
            if lo == hi:
                np.fill_diagonal(linked, False)
            a, b = np.nonzero(linked)
            counts = np.zeros(len(rows), dtype=np.int64)
            np.add.at(counts, left, linked.sum(axis=1))
            if lo != hi:
                np.add.at(counts, right, linked.sum(axis=0))
            root = _roots(len(rows), left[a], right[b])
            out.append((nodes[counts > 0], counts[counts > 0], nodes[root[counts > 0]]))
        joined = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
        return pa.table({"node": joined[0], "n_links": joined[1], "root": joined[2]})

    return spread.groupBy("_task").applyInArrow(verify, schema)


def _bins(placed: DataFrame) -> int:
    """Tasks' worth of small clusters, by the n-grams in them."""
    total = placed.filter("_blocks = 1").agg(F.sum("_grams")).first()[0] or 0
    return 1 + int(total // BLOCK_GRAMS)


def similarity_classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD
) -> DataFrame:
    """``key``, ``class_id``, ``n_links`` and ``n_copies`` of every row.

    Two rows are linked if the Jaccard likeness of their sets of ``words``-grams (lower-cased words
    between white space) is at least ``threshold``; a class is a set of rows tied by links, and its
    id the least key in it (null if no row of it has a key).  ``n_links`` counts the different sets a
    row's set is linked to, ``n_copies`` the rows with the very same set, itself included; copies are
    one node of the graph.  A null text counts as empty; texts without words are copies of each other.
    A text of fewer words has one n-gram of all.  A repeated row is a copy, rows of one key with
    different texts are sets of their own, and so are rows without a key; an empty table gives an
    empty result.
    """
    return _classes(df, key, text, words, threshold).select(F.col("_id").alias(key), "class_id", "n_links", "n_copies")


def later_members(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``_id`` (key) and ``_row`` (MD5 of the text, null for a null text) of every row that is not the
    first of its class.  The first has the least key (nulls last), and of those the least MD5."""
    first = F.col("_id").eqNullSafe(F.col("_first_id")) & F.col("_row").eqNullSafe(F.col("_first_row"))
    return _classes(df, key, text, words, threshold).filter(~first).select("_id", "_row").distinct()


def _classes(df: DataFrame, key: str, text: str, words: int, threshold: float) -> DataFrame:
    spark = df.sparkSession
    base = scratch_dir(spark, "ngram")
    depth = prefix_depth(threshold)
    _sets(df, key, text, words, TREES, depth).write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")
    # A set is a node; it is numbered once, when it is written, whatever keys its rows have.
    least = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_least")
    found = sets.groupBy("_key").agg(least, F.count(F.lit(1)).alias("_copies"), F.first("_grams").alias("_grams"), F.first("_sig").alias("_sig"))
    found = found.withColumn("_first", F.xxhash64("_least")).withColumn("_node", F.monotonically_increasing_id())
    found.write.parquet(f"{base}/nodes")
    nodes = spark.read.parquet(f"{base}/nodes")
    candidates = components(_meetings(nodes, TREES, depth), "ngram-candidates")
    clusters = candidates.join(nodes.select("_node", "_key", "_grams", "_first"), F.col("node") == F.col("_node"))
    clusters = clusters.select("_node", "_key", "_grams", "_first", F.col("component").alias("_cluster"))
    clusters.write.parquet(f"{base}/clusters")
    _verify(spark.read.parquet(f"{base}/clusters"), df, key, text, words, threshold).write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")
    ties = components(links.select(F.col("root").alias("a"), F.col("node").alias("b")), "ngram-classes")
    counted = links.groupBy("node").agg(F.sum("n_links").alias("n_links")).join(ties, "node", "left")
    tied = nodes.select("_key", "_node", "_copies", "_least").join(counted, F.col("_node") == F.col("node"), "left")
    tied = tied.select(
        F.col("_key").alias("_of"),
        F.coalesce("component", "_node").alias("_class"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("_copies").alias("n_copies"),
        "_least",
    )
    firsts = tied.groupBy("_class").agg(F.min("_least").alias("_f"))
    firsts = firsts.select("_class", F.col("_f.id").alias("class_id"), F.col("_f.id").alias("_first_id"), F.col("_f.row").alias("_first_row"))
    classes = tied.drop("_least").join(firsts, "_class")
    return sets.select("_id", "_row", "_key").join(classes, F.col("_key") == F.col("_of"))
