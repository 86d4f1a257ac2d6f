"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation (operator 7).

The model predicts a token's symbol from the two symbols before it: frequent words are symbols of
their own, all other words share symbols by their ending, and the word within such a symbol follows
its count.  Both kinds of symbols grow with the distinct words of the corpus (``symbol_numbers``), and
every word has its count, so any word of any corpus gets a normalised probability.  Training goes
over all training texts: every task trains a copy on its part, and the copies are averaged by the
tokens they saw.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollstate.session import scratch_dir

from .common import bound_batches

#: Words that are symbols of their own, and symbols that the other words share, at least; and the
#: power of the distinct words at which both grow.
HEAD, CLASSES, GROWTH = 383, 128, 0.4
#: Most frequent words whose counts every task holds; other counts are joined.
HELD_WORDS = 50_000
SIZE = 24
NOISE, STEP, RATE, CALM, ROUNDS, SEED = 48, 512, 0.08, 1e-5, 2, 5
#: Normalisers below this are summed anew, as products of exponentials may have underflowed.
TINY = 1e-200
#: Bytes of text scored together, and words counted together.
GROUP_BYTES, COUNTER_WORDS = 6 << 20, 300_000
#: Bytes of a group's texts whose arrays are in memory at a time (one text at least).
PIECE_BYTES = 3 << 20
END = b""  # the end of a text; words are never empty


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of texts, the place among them of each of their ``tokens``, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    words, lengths = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    there = pc.greater(pc.binary_length(words), 0)  # an empty text has one part, which is no word
    kept = there.to_numpy(zero_copy_only=False)
    if not kept.all():
        ends = np.concatenate([[0], np.cumsum(kept)])[np.cumsum(lengths)]
        words, lengths = words.filter(there), np.diff(ends, prepend=0)
    codes = words.dictionary_encode()
    return codes.dictionary.cast(pa.binary()), codes.indices.to_numpy().astype(np.int64), lengths


def numbered(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """As ``coded``, with the words as a list."""
    words, places, lengths = coded(texts)
    return words.to_pylist(), places, lengths


def pieces(texts: pa.ChunkedArray, size: int) -> Iterator[pa.Array]:
    """Texts in order, as many together as have ``size`` bytes (one at least)."""
    for chunk in texts.chunks:
        ends = np.cumsum(pc.fill_null(pc.binary_length(chunk), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(chunk):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield chunk.slice(at, upto - at)
            at = upto


def symbol_numbers(distinct: int) -> tuple[int, int]:
    """Words that are symbols of their own (beside the end), and shared symbols, of a vocabulary."""
    grown = int(distinct**GROWTH)
    return max(HEAD, grown), max(CLASSES, grown // 3)


def ending(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


def word_symbols(words: pa.Array, head: pa.Array, classes: int) -> np.ndarray:
    """The symbol of each word: its place in ``head``, or one that all other words of its ending share."""
    own = pc.index_in(words, value_set=head)
    ends = pc.binary_slice(words, -2).dictionary_encode()
    shared = np.array([len(head) + ending(e, classes) for e in ends.dictionary.to_pylist()], np.int64)
    return np.where(own.is_null(), shared[ends.indices], own.fill_null(0)).astype(np.int64)


def known_counts(words: pa.Array, known: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The count of each word, by the ``counts`` of ``known`` words; 0 for others."""
    at = pc.index_in(words, value_set=known).fill_null(len(known)).to_numpy()
    return np.append(counts, 0)[at]


@dataclass
class Counts:
    """Of the training tokens: their number, how many differ, the most frequent words and the mass of each ending."""

    total: int
    distinct: int
    held: dict[bytes, int]
    head: list[bytes]
    mass: np.ndarray  # of each shared symbol: sum of count + 0.5 over its words, and 0.5 for one unseen

    def noise(self) -> np.ndarray:
        """Smoothed share of each symbol."""
        share = np.concatenate([[self.held.get(w, 0) + 0.5 for w in self.head], self.mass])
        return share / share.sum()


@dataclass
class Model:
    context: np.ndarray
    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, noise: np.ndarray) -> Model:
        rng, n = np.random.default_rng(SEED), len(noise)
        small = lambda: rng.normal(0, 0.1, (n, SIZE)).astype(np.float32)
        return cls(small(), np.ones(SIZE, np.float32), np.full(SIZE, 0.5, np.float32), small(), np.log(noise).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.near, self.far, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def from_flat(self, values: np.ndarray) -> Model:
        ends = np.cumsum([p.size for p in self.parts()])[:-1]
        return Model(*[v.reshape(p.shape).astype(np.float32) for v, p in zip(np.split(values, ends), self.parts(), strict=True)])

    def predicted(self, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return self.context[before] * self.near + self.context[earlier] * self.far

    def scorer(self) -> Scorer:
        """Tables of the normalised log-probabilities.

        What a symbol gets from the two before it is a sum of one value for each of them, so the
        exponentials of all contexts are products, and one matrix product gives every normaliser.
        """
        near = (self.context * self.near) @ self.target.T
        far = (self.context * self.far) @ self.target.T + self.bias
        tops = [t.max(axis=1).astype(np.float64) for t in (near, far)]
        apart = [np.exp(t - top[:, None]) for t, top in zip((near, far), tops, strict=True)]
        sums = apart[0] @ apart[1].T
        norm = np.log(np.maximum(sums, TINY)) + tops[0][:, None] + tops[1]
        for b, e in np.argwhere(~(sums > TINY)):
            z = near[b].astype(np.float64) + far[e]
            norm[b, e] = z.max() + np.log(np.exp(z - z.max()).sum())
        return Scorer(near.astype(np.float32), far.astype(np.float32), norm.astype(np.float32))

    def log_probabilities(self, symbols: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return self.scorer().log_probabilities(symbols, before, earlier)


@dataclass
class Scorer:
    """By symbol before (``near``) or earlier (``far``) and symbol; normalisers by both."""

    near: np.ndarray
    far: np.ndarray
    norm: np.ndarray

    def log_probabilities(self, symbols: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """Normalised log-probability of each symbol after the two before it."""
        return self.near[before, symbols].astype(np.float64) + self.far[earlier, symbols] - self.norm[before, earlier]


class Trainer:
    """Noise-contrastive training of a copy of the model by AdaGrad."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        # What moves together is one table: the weights of both symbols before, and targets with their biases.
        mix, ends = np.stack([model.near, model.far]), np.column_stack([model.target, model.bias])
        self.tables = [model.context.copy(), mix, ends]
        self.m = Model(self.tables[0], mix[0], mix[1], ends[:, :SIZE], ends[:, SIZE])
        self.rng = np.random.default_rng(seed)
        self.cumulative = np.cumsum(noise)
        self.offset = np.log(NOISE * noise).astype(np.float32)
        self.seen = [np.full(t.shape, CALM, np.float32) for t in self.tables]

    @staticmethod
    def _sums(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray | slice, np.ndarray]:
        """The sum of the values of each of ``n`` rows; of large models, only of rows that occur, and which these are."""
        width = values.shape[1]
        if n <= len(rows):  # a row that does not occur gets no gradient, and stays
            there, held, at = slice(None), n, rows
        else:
            there = np.flatnonzero(np.bincount(rows, minlength=n))
            place, held = np.empty(n, np.int64), len(there)
            place[there] = np.arange(held)
            at = place[rows]
        cells = _cells(1 << (held - 1).bit_length(), width).take(at, axis=0)
        return there, np.bincount(cells.ravel(), values.ravel(), held * width).reshape(-1, width)

    def _descend(self, table: int, at: np.ndarray | slice, grad: np.ndarray) -> None:
        """One AdaGrad step of some rows of a table; others have no gradient.  Overwrites ``grad``."""
        values, seen = self.tables[table], self.seen[table]
        squares = grad * grad
        squares += seen[at]
        now = squares.astype(np.float32, copy=False)
        seen[at] = now
        grad *= RATE
        grad /= np.sqrt(now, out=now)
        if isinstance(at, slice):
            np.subtract(values, grad, out=values, casting="same_kind")
        else:
            values[at] -= grad

    def step(self, symbols: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> None:
        (context, mix, ends), size, n = self.tables, len(symbols), len(self.offset)
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), n - 1)
        pairs = np.stack([before, earlier], axis=1).ravel()
        # Rows of both symbols before, side by side.
        both = context.take(pairs, axis=0).reshape(size, 2 * SIZE)
        weights = mix.ravel()
        weighed = both * weights
        ahead = weighed[:, :SIZE] + weighed[:, SIZE:]
        targets = np.concatenate([symbols, drawn])
        wanted = ends.take(targets, axis=0)
        bias = wanted[:, SIZE] - self.offset.take(targets)
        wanted, other = wanted[:size, :SIZE], np.ascontiguousarray(wanted[size:, :SIZE])
        true = np.einsum("ij,ij->i", ahead, wanted)
        true += bias[:size]
        false = ahead @ other.T
        false += bias[size:]
        push, pull = _sigmoid(true) - 1, _sigmoid(false)
        share = np.float32(1 / size)
        to_ahead = push[:, None] * wanted
        to_ahead += pull @ other
        to_ahead *= share
        # Gradients of the targets, with those of their biases as the last column.
        to_target = np.empty((size + NOISE, SIZE + 1), np.float32)
        np.multiply(push[:, None], ahead, out=to_target[:size, :SIZE])
        to_target[:size, SIZE] = push
        np.matmul(pull.T, ahead, out=to_target[size:, :SIZE])
        to_target[size:, SIZE] = pull.sum(axis=0)
        to_target *= share
        to_context = np.concatenate([to_ahead, to_ahead], axis=1)
        to_mix = np.einsum("ij,ij->j", to_context, both).reshape(2, SIZE)
        to_context *= weights
        targets, to_target = self._sums(targets, to_target, n)
        contexts, to_context = self._sums(pairs, to_context.reshape(-1, SIZE), n)
        for table, (at, grad) in enumerate(((contexts, to_context), (slice(None), to_mix), (targets, to_target))):
            self._descend(table, at, grad)


@functools.cache
def _cells(rows: int, width: int) -> np.ndarray:
    """The numbers of the cells of each row of a table; asked for by powers of two."""
    return np.arange(rows * width).reshape(rows, width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.divide(1, x, out=x)


def sequences(symbols: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of texts, each with its end, and the two symbols before each (the end's, before a text)."""
    ended = with_ends(symbols, lengths, end)
    return ended, *preceding(ended, lengths, end)


def with_ends(symbols: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    return np.insert(symbols, np.cumsum(lengths), end)


def preceding(ended: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum(lengths + 1)[:-1]
    before = np.concatenate([[end], ended[:-1]])
    before[starts] = end
    earlier = np.concatenate([[end], before[:-1]])
    earlier[starts] = end
    return before, earlier


def with_end(words: pa.Array) -> pa.Array:
    return pa.concat_arrays([words, pa.array([END], pa.binary())])


def gathered(tables: Iterable[pa.Table], words: int) -> Iterator[pa.Table]:
    """Rows of tables of words, together until they are more than twice as many as ``words``."""
    kept: list[pa.Table] = []
    rows = 0
    for t in tables:
        kept.append(t)
        rows += len(t)
        if rows > 2 * words:
            yield pa.concat_tables(kept)
            kept, rows = [], 0
    if kept:
        yield pa.concat_tables(kept)


def count(texts: DataFrame, folder: str) -> tuple[DataFrame, Counts]:
    """Counts the words and ends of all ``_text`` rows; the counts are written to ``folder``."""
    spark = texts.sparkSession
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts_of() -> Iterator[pa.Table]:
            for b in batches:
                words, places, lengths = coded(b.column(0))
                times = np.append(np.bincount(places, minlength=len(words)), len(lengths))
                yield pa.table({"_word": with_end(words), "_n": pa.array(times, pa.int64())})

        for rows in gathered(counts_of(), COUNTER_WORDS):
            yield from rows.group_by("_word", use_threads=False).aggregate([("_n", "sum")]).rename_columns(["_word", "_n"]).to_batches()

    counted = texts.select("_text").mapInArrow(run, "_word binary, _n long").groupBy("_word").agg(F.sum("_n").alias("_n"))
    counted.write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    total, distinct = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("_n"), "_word").limit(max(HELD_WORDS, symbol_numbers(distinct)[0])).collect()
    held = {bytes(r._word): r._n for r in top}
    # The end is a symbol however many words are more frequent.
    ends = counts.filter(F.octet_length("_word") == 0).first()
    held[END] = ends._n if ends else 0
    own, classes = symbol_numbers(distinct)
    head = [END, *[w for w in held if w != END]][: own + 1]
    shared = counts.join(F.broadcast(spark.createDataFrame([(w,) for w in head], "_word binary")), "_word", "left_anti")
    by_ending = shared.groupBy((F.crc32(F.substring("_word", -2, 2)) % classes).cast("int").alias("c")).agg(F.sum(F.col("_n") + 0.5).alias("m"))
    mass = np.full(classes, 0.5)
    for r in by_ending.collect():
        mass[r.c] += r.m
    return counts, Counts(total, distinct, held, head, mass)


def train(texts: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """Trains on all ``_text`` rows, a share of them (by ``_part``) in each round.

    A task's copy goes out as one row per parameter, weighted by its tokens; the sums are
    pre-aggregated, so the driver gets one row per parameter however many tasks there are.
    """
    spark = texts.sparkSession
    noise = counts.noise()
    model = Model.start(noise)
    for r in range(rounds):
        shared = spark.sparkContext.broadcast((model, noise, pa.array(counts.head, pa.binary()), len(counts.mass)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, share, head, classes = shared.value
            trainer, weight = None, 0
            for b in batches:
                words, places, lengths = coded(b.column(0))
                symbols, before, earlier = sequences(word_symbols(words, head, classes)[places], lengths, 0)
                trainer = trainer or Trainer(start, share, SEED + len(symbols))
                order = trainer.rng.permutation(len(symbols))
                mixed = [x[order] for x in (symbols, before, earlier)]
                for at in range(0, len(order), STEP):
                    trainer.step(*(x[at : at + STEP] for x in mixed))
                weight += len(symbols)
            if weight:
                values = np.concatenate([[1.0], trainer.m.flat()]) * weight
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values, pa.float64())], names=["i", "v"])

        part = texts.filter(F.col("_part") % rounds == r).select("_text")
        rows = part.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        if rows:
            sums = np.array([v for _, v in sorted((x.i, x.v) for x in rows)])
            model = model.from_flat(sums[1:] / sums[0])
        shared.unpersist()
    return model


def score_texts(df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row.

    Learns counts and model from all rows that are not held out.  A null text counts as empty and
    has one token, the end.  Repeated rows are learned from and scored each; a null key is scored
    too; an empty table gives an empty result.
    """
    spark = df.sparkSession
    bound_batches(spark)
    folder = scratch_dir(spark, "lm")
    rows = df.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"), held_out.alias("_held_out"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Rows are numbered and dealt once, when they are written: no key sets the size of a group.
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    groups = 1 + int(size // GROUP_BYTES)
    part = F.xxhash64("_row")
    rows = rows.select("_key", "_text", "_held_out", F.pmod(part, F.lit(groups)).cast("int").alias("_group"), F.pmod(F.shiftright(part, 32), F.lit(1 << 30)).alias("_part"))
    # As many files as groups, so that every later pass has tasks for all cores.
    rows.repartition(groups, "_group").write.parquet(f"{folder}/texts")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/texts")
    learned = rows.filter(~F.col("_held_out"))
    counts, stats = count(learned, folder)
    model = train(learned, stats)
    held = pa.array(list(stats.held), pa.binary()), np.array(list(stats.held.values()), np.int64)
    shared = spark.sparkContext.broadcast((stats, model.scorer(), *held))
    dealt = rows.select("_key", "_text", "_held_out", "_group")

    def words_needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of each group whose counts are not held everywhere."""
        held = shared.value[2]

        def words_of() -> Iterator[pa.Table]:
            for b in batches:
                words, places, lengths = coded(b.column("_text"))
                numbers, at = np.unique(b.column("_group").to_numpy(), return_inverse=True)
                there = np.zeros((len(numbers), len(words)), bool)
                there[np.repeat(at, lengths), places] = True
                there[:, pc.is_in(words, value_set=held).to_numpy(zero_copy_only=False)] = False
                group, word = np.nonzero(there)
                yield pa.table({"_group": pa.array(numbers[group], pa.int32()), "_word": words.take(pa.array(word))})

        for rows in gathered(words_of(), COUNTER_WORDS):
            yield from rows.group_by(["_group", "_word"], use_threads=False).aggregate([]).to_batches()

    # Where several tasks read texts of a group its words come more than once, with the same count.
    needed = dealt.mapInArrow(words_needed, "_group int, _word binary").join(counts, "_word")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        stats, scorer, held, held_counts = shared.value
        known = pa.concat_arrays([held, *right["_word"].chunks])
        numbers = np.concatenate([held_counts, right["_n"].to_numpy()])
        every = stats.total + 0.5 * (stats.distinct + 1)
        own, head = len(stats.head), pa.array(stats.head, pa.binary())
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        texts = [coded(piece) for piece in pieces(left["_text"], PIECE_BYTES)]
        # One search for the words of all pieces.
        found = known_counts(pa.concat_arrays([with_end(words) for words, _, _ in texts]), known, numbers) if texts else np.zeros(0, np.int64)
        for words, places, lengths in texts:
            counts_, found = np.split(found, [len(words) + 1])
            symbol = word_symbols(with_end(words), head, len(stats.mass))
            mass = np.concatenate([np.ones(own), stats.mass])[symbol]
            within = np.where(symbol < own, 1.0, (counts_ + 0.5) / mass)
            places = with_ends(places, lengths, len(words))
            symbols = symbol[places]
            before, earlier = preceding(symbols, lengths, 0)
            n = len(lengths)
            owner = np.repeat(np.arange(n), lengths + 1)
            base = np.log10((counts_ + 0.5) / every)
            logs = scorer.log_probabilities(symbols, before, earlier) / np.log(10) + np.log10(within)[places]
            sums = [np.bincount(owner, v, n) for v in ((counts_ > 0)[places], base[places], logs)]
            out.append((lengths + 1, *sums))
        n_tokens, n_known, base_score, score_ = (np.concatenate([o[i] for o in out] or [np.zeros(0)]) for i in range(4))
        return pa.table(
            {
                key: left["_key"],
                "held_out": left["_held_out"],
                "n_tokens": pa.array(n_tokens.astype(np.int64)),
                "n_known": pa.array(n_known.astype(np.int64)),
                "train_tokens": pa.array(np.full(len(n_tokens), stats.total), pa.int64()),
                "base_score": pa.array(base_score, pa.float64()),
                "score": pa.array(score_, pa.float64()),
            }
        )

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("_group").cogroup(needed.groupBy("_group")).applyInArrow(score, schema)
