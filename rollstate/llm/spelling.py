"""Spelling variants: words one edit apart, found by k-d trees over letter counts (operator 12).

One inserted, deleted or replaced letter changes a word's letter counts by at most one up and one
down, an L1 distance of at most two.  Words of one length are points of a k-d tree over their counts;
a search goes on below a node only if its box can still be reached by the ups and downs that the pair
of lengths allows (same length: one each; one letter longer: one up, for both words of the pair).
What is left is compared letter by letter.

The top of every length's tree is fitted on the driver to a bounded sample (about ``SAMPLE`` words),
which decides only how evenly cells are filled: every word is in one cell, and every search visits
all cells in reach.  Spark sorts points and searches by cell; a task goes through its cells one after
the other, builds the lower part of the tree from a cell's points and streams the searches by.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollstate.session import scratch_dir

from .common import bound_batches, shuffle_width

#: Letters counted one by one; code points above share what is left of the dimensions, which only
#: brings words nearer to each other.
DIMS = 32
#: Points of one cell that the sample aims at, and of one leaf below.
CELL, LEAF = 8000, 24
#: About as many words, and letters, are sampled at most.
SAMPLE, SAMPLE_LETTERS = 200_000, 4_000_000
#: Searches that meet a cell's points at a time.
BLOCK = 20_000
_A = ord("a")


@dataclass
class Node:
    """A split by ``counts[dim] < at``, or a leaf with the rows (or the cell) it holds."""

    dim: int = -1
    at: int = 0
    low: "Node | None" = None
    high: "Node | None" = None
    rows: np.ndarray | int | None = None


def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter stands in each word."""
    dims = np.where((codes >= _A) & (codes < _A + 26), codes - _A, 26 + codes % (DIMS - 26)).astype(np.int64)
    n, length = dims.shape
    flat = (np.arange(n, dtype=np.int64)[:, None] * DIMS + dims).ravel()
    return np.bincount(flat, minlength=n * DIMS).reshape(n, DIMS).astype(np.int32)


def signatures(points: np.ndarray) -> np.ndarray:
    """Two bits a dimension (at least one, at least two); no two differ in more bits than their L1 distance."""
    bits = np.hstack([points >= 1, points >= 2])
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def best_split(points: np.ndarray) -> tuple[int, int] | None:
    """Dimension and count that part the points most evenly; None if all are equal."""
    middle, best, n = np.median(points, axis=0).astype(np.int64), None, len(points)
    for at in (middle, middle + 1):
        below = (points < at).sum(axis=0)
        uneven = np.where((below == 0) | (below == n), n + 1, np.abs(2 * below - n))
        d = int(uneven.argmin())
        if uneven[d] <= n and (best is None or uneven[d] < best[0]):
            best = (int(uneven[d]), d, int(at[d]))
    return best and best[1:]


def build(points: np.ndarray, rows: np.ndarray, leaf: int) -> Node:
    split = best_split(points[rows]) if len(rows) > leaf else None
    if split is None:
        return Node(rows=rows)
    dim, at = split
    low = points[rows, dim] < at
    return Node(dim, at, build(points, rows[low], leaf), build(points, rows[~low], leaf))


def search(node: Node, x: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray | int]]:
    """Leaves with the rows of ``x`` that can reach them by ``up`` letters more and ``down`` fewer."""
    n = len(x)
    low, high = np.zeros(DIMS, np.int64), np.full(DIMS, np.iinfo(np.int32).max, np.int64)

    def walk(node, who, ups, downs):
        if node.dim < 0:
            yield who, node.rows
            return
        d, v = node.dim, x[who, node.dim]
        before = high[d]
        more = downs + np.maximum(0, v - (node.at - 1)) - np.maximum(0, v - before)
        near = more <= down
        if near.any():
            high[d] = node.at - 1
            yield from walk(node.low, who[near], ups[near], more[near])
            high[d] = before
        before = low[d]
        more = ups + np.maximum(0, node.at - v) - np.maximum(0, before - v)
        near = more <= up
        if near.any():
            low[d] = node.at
            yield from walk(node.high, who[near], more[near], downs[near])
            low[d] = before

    if n:
        yield from walk(node, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows where the words differ by exactly one replaced letter, or by one letter that is left out."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    head = np.cumprod(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def reach(own: int, other: int) -> tuple[int, int]:
    """Letters more and fewer by which a word reaches words as long as itself, or one letter longer."""
    return (1, 1) if own == other else (1, 0)


_RUN = re.compile("[a-z\u00c0-\u00ff]+")
#: Distinct words a task counts before it passes them on.
HELD = 200_000


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for b in batches:
        for key, text in zip(b.column("_key").to_pylist(), b.column("_text").to_pylist()):
            start = zlib.crc32(key.encode() + b":")
            # The lower case of bytes is that of A-Z alone.
            for run, n in Counter(_RUN.findall(text.lower().decode())).items():
                h = zlib.crc32(run.encode(), start)
                if h % 97 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                held[run] = held.get(run, 0) + n
            if len(held) >= HELD:
                yield flush()
    if held:
        yield flush()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of maximal runs of letters with A-Z lower-cased, pre-aggregated: a word may
    have several rows, which add up.

    By the crc32 of key and run, about one run in 97 loses one letter, which plants variants.
    A null key counts as an empty text; a null text has no runs.
    """
    bound_batches(docs.sparkSession)
    rows = docs.filter(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), F.col(text).cast("binary").alias("_text")
    )
    return rows.mapInArrow(_run_counts, "word string, n long")


def vocabulary(counted: DataFrame, min_letters: int, min_count: int) -> DataFrame:
    """``word`` and ``n`` of words long and frequent enough."""
    long_enough = counted.filter(F.char_length("word") >= min_letters)
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def fit_tops(words: DataFrame) -> dict[int, Node]:
    """The top of the tree of every length that occurs; leaves are numbered cells."""
    by_length = {r[0]: r[1] for r in words.groupBy(F.char_length("word")).agg(F.count(F.lit(1))).collect()}
    drawn: dict[int, list[str]] = {}
    if any(c > CELL for c in by_length.values()):
        size = max(sum(by_length.values()) / SAMPLE, sum(n * c for n, c in by_length.items()) / SAMPLE_LETTERS)
        drawn_one = F.pmod(F.xxhash64("word"), F.lit(1_000_000_000)) < int(1_000_000_000 / max(1.0, size))
        for (w,) in words.filter(drawn_one).select("word").collect():
            drawn.setdefault(len(w), []).append(w)
    tops = {}
    for length, n in by_length.items():
        sample = drawn.get(length, [])
        if n <= CELL or not sample:
            tops[length] = Node(rows=0)
            continue
        points = counts(letters(sample, length))
        top = build(points, np.arange(len(points)), max(16, int(CELL * len(points) / n)))
        tops[length] = _numbered(top)
    return tops


def _numbered(top: Node) -> Node:
    todo, cell = [top], 0
    while todo:
        node = todo.pop()
        if node.dim < 0:
            node.rows, cell = cell, cell + 1
        else:
            todo += [node.high, node.low]
    return top


def _routes(tops: dict[int, Node], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word as the point of its cell (role 0) and as a search in all cells in reach (role 1)."""
    for batch in batches:
        words, ns = batch.column("word"), batch.column("n")
        lengths = np.array([len(w) for w in words.to_pylist()], np.int64)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            x = counts(letters(words.take(pa.array(rows)).to_pylist(), length))
            for target in (length, length + 1):
                if target not in tops:
                    continue
                homes = search(tops[target], x, 0, 0) if target == length else ()
                for role, visits in ((0, homes), (1, search(tops[target], x, *reach(length, target)))):
                    for who, cell in visits:
                        take, k = pa.array(rows[who]), len(who)
                        cols = [pa.array(np.full(k, v), t) for v, t in ((target, pa.int32()), (cell, pa.int32()), (role, pa.int32()))]
                        yield pa.RecordBatch.from_arrays(cols + [words.take(take), ns.take(take)], names=["length", "cell", "role", "word", "n"])


class _Cell:
    """The points of one cell and the lower part of their tree."""

    def __init__(self, length: int, words: list[str], ns: list[int]):
        self.length = length
        # In the order in which near words are preferred: frequent ones first, then by code points.
        order = sorted(range(len(words)), key=lambda i: (-ns[i], words[i]))
        self.words, self.n = [words[i] for i in order], np.array(ns, np.int64)[order]
        self.codes = letters(self.words, length)
        self.counts = counts(self.codes)
        self.signatures = signatures(self.counts)
        self.tree = build(self.counts, np.arange(len(words)), LEAF)

    def near(self, asked: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
        """``(word, found, best n, best word)`` of the searches (word, n) that find something; of points
        found by searches of another length too, as those words are not searched for the other way."""
        by_length: dict[int, list[tuple[str, int]]] = {}
        for one in sorted(asked, key=lambda a: (-a[1], a[0])):
            by_length.setdefault(len(one[0]), []).append(one)
        for own, group in by_length.items():
            names, ns = [w for w, _ in group], np.array([n for _, n in group], np.int64)
            codes = letters(names, own)
            x = counts(codes)
            mine, (up, down) = signatures(x), reach(own, self.length)
            pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for who, points in search(self.tree, x, up, down):
                bits = np.bitwise_count(mine[who][:, None] ^ self.signatures[points][None, :])
                i, j = np.nonzero(bits <= up + down)
                q, p = who[i], points[j]
                close = np.abs(x[q] - self.counts[p]).sum(axis=1) <= up + down
                q, p = q[close], p[close]
                same = one_edit(codes[q], self.codes[p])
                pairs.append((q[same], p[same]))
            q, p = (np.concatenate(side) for side in zip(*pairs))
            yield from _tally(q, p, names, self.words, self.n)
            if own != self.length:
                yield from _tally(p, q, self.words, names, ns)


def _tally(one: np.ndarray, other: np.ndarray, names: list[str], others: list[str], ns: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """Per word of ``one``: how many others it met and the first of them, which is the preferred one."""
    found = np.bincount(one, minlength=len(names))
    best = np.full(len(names), len(others), np.int64)
    np.minimum.at(best, one, other)
    for i in np.flatnonzero(found).tolist():
        yield names[i], int(found[i]), int(ns[best[i]]), others[best[i]]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and role: a cell's points first, then its searches."""
    names, types = ["word", "found", "best_n", "best"], [pa.string(), pa.int64(), pa.int64(), pa.string()]
    key, points, cell, waiting = None, ([], []), None, []

    def flush():
        if not waiting:
            return None
        rows = list(cell.near(waiting)) if cell else []
        waiting.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names) if rows else None

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("length", "cell", "role", "word", "n")]
        for length, at, role, word, n in zip(*columns):
            if (length, at) != key:
                if (out := flush()) is not None:
                    yield out
                key, points, cell = (length, at), ([], []), None
            if role == 0:
                points[0].append(word)
                points[1].append(n)
                continue
            if cell is None and points[0]:
                cell = _Cell(length, *points)
            waiting.append((word, n))
            if len(waiting) >= BLOCK and (out := flush()) is not None:
                yield out
    if (out := flush()) is not None:
        yield out


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` (words one edit away) and of those the most frequent: ``best_n``, ``best``."""
    bound_batches(words.sparkSession)
    tops = fit_tops(words)
    # Searches are far more work than the few bytes of the words let the planner see.
    spread = words.repartition(shuffle_width(words.sparkSession), "word")
    routed = spread.mapInArrow(lambda b: _routes(tops, b), "length int, cell int, role int, word string, n long")
    width = max(shuffle_width(words.sparkSession), sum(1 for t in tops.values() for _ in _leaves(t)) // 4)
    dealt = routed.repartition(width, "length", "cell").sortWithinPartitions("length", "cell", "role")
    found = dealt.mapInArrow(_searched, "word string, found long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("found").alias("n_near"), first.alias("_b")).select(
        "word", "n_near", (-F.col("_b.m")).alias("best_n"), F.col("_b.w").alias("best")
    )


def _leaves(node: Node) -> Iterator[Node]:
    if node.dim < 0:
        yield node
    else:
        yield from _leaves(node.low)
        yield from _leaves(node.high)


def group_variants(words: DataFrame, ratio: float = 2.0) -> DataFrame:
    """``word``, ``n``, ``form``, ``root``, ``n_near``, ``form_n`` of every row of (``word``, ``n``).

    The form is the near word of largest ``n`` (ties: smallest by code points) if that is at least
    ``ratio`` (above 1) times the word's own; the root is where forms lead in the end, the word itself
    without a form.  Words must be distinct and not null; an empty table gives an empty result, a
    word of any length is compared.  Other columns are left out.

    Frequencies grow along forms, so chains end; they are halved each round by a join, and every
    round is written to the shared folder.
    """
    spark = words.sparkSession
    base = scratch_dir(spark, "spelling")
    words.select("word", "n").write.parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")
    near_words(words).write.parquet(f"{base}/near")
    near = spark.read.parquet(f"{base}/near")
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    known = words.join(near, "word", "left").select(
        "word",
        "n",
        F.when(is_form, F.col("best")).alias("form"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    known.write.parquet(f"{base}/known")
    known = spark.read.parquet(f"{base}/known")
    links, r = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")).write.parquet(f"{base}/roots{r}")
        done = spark.read.parquet(f"{base}/roots{r}")
        links, r = done.select("word", "root"), r + 1
        if done.filter("_moved").isEmpty():
            break
    return known.join(links, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = 5, min_count: int = 3) -> DataFrame:
    """Variants among the words of texts: see ``word_counts``, ``vocabulary`` and ``group_variants``.

    Null and empty texts have no words, repeated rows count again, other columns are not read.
    """
    return group_variants(vocabulary(word_counts(docs, key, text), min_letters, min_count))
