"""Quality classifier: a factorisation machine over words and structure (operator 6).

Inputs of a score are the hashed distinct words of a text, statistics of its structure and its
size.  The machine gives every input a weight and a short vector; two inputs interact by the
product of their vectors.  The sum over all pairs is half of (sum of vectors) squared minus the
sum of squared vectors, so a text is scored in time linear in its inputs.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import list_array, map_arrow

WORD_BUCKETS = 1 << 15
RANK = 8
#: Labelled rows the machine is fitted on at most (those with the smallest hash of their id).
MAX_LABELLED = 20_000
#: Words whose bucket a worker remembers; beyond it starts afresh.
CACHE_WORDS = 500_000

STRUCTURE = (
    "upper lower digit blank newline stop comma bang bar symbol wide "
    "log_chars log_words word_length distinct_words distinct_lines line_words upper_words symbol_words"
).split()


def _byte_classes() -> np.ndarray:
    """Class number of every UTF-8 byte: the first eleven names of STRUCTURE; bytes of wide characters last."""
    table = np.full(256, STRUCTURE.index("symbol"), dtype=np.uint8)
    for name, members in {
        "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (9, 11, 12, 13, 32),
        "newline": (10,), "stop": b".?:;", "comma": b",", "bang": b"!", "bar": b"|", "wide": range(128, 256),
    }.items():
        table[list(members)] = STRUCTURE.index(name)
    return table


class Features:
    """Inputs of texts: flat word buckets, their number per text, and a row of structure values per text."""

    def __init__(self) -> None:
        self.classes = _byte_classes()
        self.buckets: dict[str, int] = {}

    def _words(self, words: set[str]) -> list[int]:
        seen = self.buckets
        if len(seen) > CACHE_WORDS:
            seen.clear()
        out = []
        for w in words:
            b = seen.get(w)
            if b is None:
                b = seen[w] = zlib.crc32(w.encode()) % WORD_BUCKETS
            out.append(b)
        return out

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dense = np.zeros((len(texts), len(STRUCTURE)), dtype=np.float32)
        flat: list[int] = []
        lengths = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            if not text:
                continue
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            words, lines = text.split(), text.split("\n")
            distinct = set(words)
            buckets = self._words(distinct)
            flat += buckets
            lengths[i] = len(buckets)
            n = max(1, len(distinct))
            plain = sum(map(str.isalnum, distinct))
            dense[i, :11] = np.bincount(self.classes[raw], minlength=11) / len(raw)
            dense[i, 11:] = (
                np.log1p(len(text)),
                np.log1p(len(words)),
                len(text) / max(1, len(words)),
                len(distinct) / max(1, len(words)),
                len(set(lines)) / len(lines),
                np.log1p(len(words) / len(lines)),
                sum(map(str.isupper, distinct)) / n,
                1 - plain / n,
            )
        return np.array(flat, dtype=np.int32), lengths, dense


@dataclass
class Machine:
    """Weights of word buckets, then of structure values; a vector for each; centre and scale of the latter."""

    bias: float
    weight: np.ndarray
    vector: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    #: False if there were no labels of both kinds to tell apart.
    fitted: bool = True

    def _inputs(self, words: np.ndarray, lengths: np.ndarray, dense: np.ndarray):
        """Owner, index and value of every input, structure values last."""
        n, d = dense.shape
        owner = np.concatenate([np.repeat(np.arange(n), lengths), np.repeat(np.arange(n), d)])
        index = np.concatenate([words, np.tile(np.arange(WORD_BUCKETS, WORD_BUCKETS + d), n)])
        shares = 1 / np.sqrt(np.maximum(lengths, 1))
        value = np.concatenate([np.repeat(shares, lengths), np.clip((dense - self.centre) / self.scale, -4, 4).ravel()])
        return owner, index, value.astype(np.float32)

    def raw(self, words: np.ndarray, lengths: np.ndarray, dense: np.ndarray):
        """Log-odds, and what training needs of them."""
        owner, index, value = self._inputs(words, lengths, dense)
        n = len(dense)
        linear = np.bincount(owner, self.weight[index] * value, n)
        v = self.vector[index] * value[:, None]
        total = np.stack([np.bincount(owner, v[:, f], n) for f in range(RANK)], axis=1)
        squares = np.bincount(owner, np.einsum("ij,ij->i", v, v), n)
        return self.bias + linear + 0.5 * ((total**2).sum(axis=1) - squares), (owner, index, value, total)

    def score(self, words: np.ndarray, lengths: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(words, lengths, dense)[0], -30, 30)))


def train(
    words: np.ndarray, lengths: np.ndarray, dense: np.ndarray, label: np.ndarray,
    epochs: int = 12, batch: int = 128, rate: float = 0.05, decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """Fits a machine by logistic loss and AdaGrad; without labels of both kinds it gives the (smoothed) share of ones."""
    rng = np.random.default_rng(seed)
    size, d = WORD_BUCKETS + len(STRUCTURE), len(STRUCTURE)
    share = (label.sum() + 1) / (len(label) + 2)
    centre = dense.mean(axis=0) if len(dense) else np.zeros(d)
    scale = (dense.std(axis=0) if len(dense) else np.zeros(d)) + 1e-3
    m = Machine(
        float(np.log(share / (1 - share))), np.zeros(size, np.float32),
        rng.normal(0, 0.02, (size, RANK)).astype(np.float32), centre.astype(np.float32), scale.astype(np.float32),
    )
    if not 0 < label.sum() < len(label):
        m.vector[:] = 0
        m.fitted = False
        return m
    starts = np.concatenate([[0], np.cumsum(lengths)])
    seen_w, seen_v, seen_b = np.full(size, 1e-2, np.float32), np.full((size, RANK), 1e-2, np.float32), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            own = np.concatenate([words[starts[r] : starts[r + 1]] for r in rows])
            z, (owner, index, value, total) = m.raw(own, lengths[rows], dense[rows])
            slope = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]) / len(rows)).astype(np.float32)
            push = slope[owner] * value
            used, place = np.unique(index, return_inverse=True)
            grad_w = np.bincount(place, push, len(used)) + decay * m.weight[used]
            pull = push[:, None] * (total[owner] - m.vector[index] * value[:, None])
            grad_v = np.stack([np.bincount(place, pull[:, f], len(used)) for f in range(RANK)], axis=1) + decay * m.vector[used]
            grad_b = float(slope.sum())
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            seen_b += grad_b**2
            m.weight[used] -= rate * grad_w / np.sqrt(seen_w[used])
            m.vector[used] -= rate * grad_v / np.sqrt(seen_v[used])
            m.bias -= rate * grad_b / np.sqrt(seen_b)
    return m


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_labelled: int = MAX_LABELLED) -> Machine:
    """Fits a machine on at most ``max_labelled`` labelled rows for which ``learn`` (over doc_id) holds.

    Rows with null ids or labels are left out; a document labelled twice counts with its lower
    label.  Only the inputs of the sample reach the driver, as arrays.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn)
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("_label"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)

    def make():
        features = Features()

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            flat, lengths, dense = features(batch.column("text").to_pylist())
            wide = np.full(len(dense), dense.shape[1])
            return [list_array(flat, lengths, pa.int32()), list_array(dense.ravel(), wide, pa.float32())]

        return run

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    outputs = [("_words", T.ArrayType(T.IntegerType())), ("_dense", T.ArrayType(T.FloatType()))]
    got = map_arrow(texts, outputs, make, drop=("text",)).toArrow().sort_by("doc_id")
    words = got["_words"].combine_chunks()
    if not got.num_rows:
        empty = np.zeros(0)
        return train(empty.astype(np.int32), empty.astype(np.int64), np.zeros((0, len(STRUCTURE)), np.float32), empty)
    lengths = np.diff(np.asarray(words.offsets))
    flat = np.asarray(words.flatten())
    dense = np.asarray(got["_dense"].combine_chunks().flatten()).reshape(-1, len(STRUCTURE))
    return train(flat, lengths, dense, (got["_label"].to_numpy() > 0).astype(np.float64))


def score(docs: DataFrame, machine: Machine, threshold: float, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Adds ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``threshold`` on) to every row.

    A null text is scored as an empty one.  Repeated rows have equal scores; an empty table gives
    an empty one.  Columns named like an output are replaced; the text goes unless ``keep_text``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        features, m = Features(), shared.value

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            values = np.concatenate(
                [m.score(*features(batch.column(text).slice(i, 500).to_pylist())) for i in range(0, batch.num_rows, 500)]
                or [np.zeros(0)]
            )
            return [pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32), pa.int32())]

        return run

    return map_arrow(docs, [("score", T.DoubleType()), ("predicted", T.IntegerType())], make, drop=() if keep_text else (text,))
