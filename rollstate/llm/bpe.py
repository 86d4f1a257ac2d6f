"""Byte-level BPE encoding and decoding by DuckDB recursive queries in every partition (operator 1).

A worker holds the merge table in an in-process DuckDB.  Words not seen before become rows
(word, position, token); a recursive query joins neighbouring rows with the merge table and
contracts each word's leftmost pair of minimum rank, until no word has a pair left.  Decoding
joins token rows with the vocabulary and aggregates their bytes in order.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import chunks
from .common import list_array, map_arrow

#: Chunks a worker remembers; beyond it keeps the more used half, which costs time only.
CACHE_CHUNKS = 600_000
#: State rows that one recursive query may make; longer work goes on from where it stopped.
STATE_ROWS = 3_000_000
#: Bytes of words in one query, and tokens in one decoding query.
QUERY_BYTES, QUERY_TOKENS = 400_000, 500_000
#: Words up to this many bytes contract one pair a round; in longer ones all occurrences of the
#: minimum pair contract at once where that gives the same result.
SHORT_BYTES = 64
LOW = 0x7FFFFFFF

# state: key = word << 31 | position.  ``linked`` sees each token's neighbours, ``ranked`` the rank
# of the pair with the next one, ``best`` each word's least (rank, position).
_ONE_PAIR = f"""
WITH RECURSIVE state(key, tok, lvl) AS (
  SELECT key, tok, 0 FROM start
  UNION ALL
  (WITH linked AS (
     SELECT key, tok, lvl, lead(key) OVER x AS nk, lead(tok) OVER x AS nt, lag(key) OVER x AS pk
     FROM state WHERE lvl < $rounds WINDOW x AS (ORDER BY key)),
   ranked AS (
     SELECT p.key, p.tok, p.lvl, p.pk, k.m FROM linked p
     LEFT JOIN merges k ON k.pair = (p.tok::BIGINT << 20) + p.nt AND p.key >> 31 = p.nk >> 31),
   best AS (SELECT key >> 31 AS w, min((m::BIGINT << 31) | (key & {LOW})) AS b FROM ranked WHERE m IS NOT NULL GROUP BY 1)
   SELECT r.key, CASE WHEN (r.key & {LOW}) = (b.b & {LOW}) THEN (b.b >> 31)::INTEGER ELSE r.tok END, r.lvl + 1
   FROM ranked r JOIN best b ON b.w = r.key >> 31
   WHERE r.pk IS NULL OR r.pk <> ((b.w << 31) | (b.b & {LOW})))
), last AS (SELECT key >> 31 AS w, max(lvl) AS lvl FROM state GROUP BY 1)
SELECT s.key >> 31 AS w, any_value(s.lvl) AS lvl, list(s.tok ORDER BY s.key) AS toks
FROM state s JOIN last l ON l.w = s.key >> 31 AND l.lvl = s.lvl GROUP BY 1
"""

# As above; ``hits`` are all occurrences of the word's minimum pair that do not overlap, counted
# from the left.  Only where the merged token starts no earlier merge: else the leftmost alone.
_ALL_PAIRS = f"""
WITH RECURSIVE state(key, tok, lvl) AS (
  SELECT key, tok, 0 FROM start
  UNION ALL
  (WITH linked AS (
     SELECT key, tok, lvl, lead(key) OVER x AS nk, lead(tok) OVER x AS nt, lag(key) OVER x AS pk, row_number() OVER x AS i
     FROM state WHERE lvl < $rounds WINDOW x AS (ORDER BY key)),
   ranked AS (
     SELECT p.*, k.m, k.calm FROM linked p
     LEFT JOIN merges k ON k.pair = (p.tok::BIGINT << 20) + p.nt AND p.key >> 31 = p.nk >> 31),
   best AS (SELECT key >> 31 AS w, min((m::BIGINT << 31) | (key & {LOW})) AS b FROM ranked WHERE m IS NOT NULL GROUP BY 1),
   least AS (
     SELECT r.key, r.i, r.i - row_number() OVER (PARTITION BY b.w ORDER BY r.key) AS run
     FROM ranked r JOIN best b ON b.w = r.key >> 31 AND r.m = b.b >> 31
     WHERE r.calm OR (r.key & {LOW}) = (b.b & {LOW})),
   hits AS (SELECT key FROM (SELECT key, row_number() OVER (PARTITION BY key >> 31, run ORDER BY key) AS n FROM least) WHERE n % 2 = 1)
   SELECT r.key, CASE WHEN h.key IS NULL THEN r.tok ELSE r.m END, r.lvl + 1
   FROM ranked r JOIN best b ON b.w = r.key >> 31 LEFT JOIN hits h ON h.key = r.key
   WHERE r.pk IS NULL OR r.pk NOT IN (SELECT key FROM hits))
), last AS (SELECT key >> 31 AS w, max(lvl) AS lvl FROM state GROUP BY 1)
SELECT s.key >> 31 AS w, any_value(s.lvl) AS lvl, list(s.tok ORDER BY s.key) AS toks
FROM state s JOIN last l ON l.w = s.key >> 31 AND l.lvl = s.lvl GROUP BY 1
"""

_DECODE = """
SELECT t.run, string_agg(v.hex, '' ORDER BY t.pos) AS hex
FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY t.run
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` numbered by ``order``, one after the other, and their lengths."""
    n = lengths[order]
    first = starts[order] - np.concatenate([[0], np.cumsum(n)[:-1]])[: len(n)]
    return values[np.repeat(first, n) + np.arange(n.sum())], n


class DuckBPE:
    """One worker's DuckDB with merge table and vocabulary, and the chunks encoded so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        self.ranks = load_ranks(path)
        self.pieces = chunks.Pieces(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.con = duckdb.connect(
            ":memory:", config={"threads": 1, "memory_limit": "256MB", "preserve_insertion_order": False}
        )
        pairs, merged, early = [], [], set()
        for tok, m in self.ranks.items():
            for i in range(1, len(tok)):
                a, b = self.ranks.get(tok[:i]), self.ranks.get(tok[i:])
                if a is not None and b is not None:
                    pairs.append((a << 20) + b)
                    merged.append(m)
                    early.update(x for x in (a, b) if x > m)  # tokens that start a merge ranked before them
        self._table("merges", pair=pa.array(pairs, pa.int64()), m=pa.array(merged, pa.int32()), calm=[m not in early for m in merged])
        self._table(
            "vocabulary",
            id=pa.array(list(self.ranks.values()), pa.int32()),
            hex=[tok.hex() for tok in self.ranks],
        )
        self._forget()

    def _table(self, name: str, **columns) -> None:
        self.con.register("source", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM source")
        self.con.unregister("source")

    def _forget(self) -> None:
        #: Chunk -> its number.  Chunks follow a space; one that starts a text is entered with a
        #: space before it, which no other chunk has.
        self.known: dict[str, int] = {}
        self.ends = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)
        self.uses = np.zeros(0, dtype=np.int64)

    def _forget_rare(self) -> None:
        """Keeps the chunks used more than once, at most half as many as are remembered."""
        least = max(2, int(np.partition(self.uses, -(CACHE_CHUNKS // 2))[-(CACHE_CHUNKS // 2)]) + 1)
        kept = np.flatnonzero(self.uses >= least)
        place = np.full(len(self.uses), -1)
        place[kept] = np.arange(len(kept))
        self.known = {c: int(place[n]) for c, n in self.known.items() if place[n] >= 0}
        self.ids, lengths = _gather(self.ids, self.ends[:-1], np.diff(self.ends), kept)
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        self.uses = np.ones(len(kept), dtype=np.int64)

    # -------------------------------------------------------------------------------- words

    def _contract(self, sql: str, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words given as byte tokens, one word after the other, and each word's number of them."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        number = np.arange(len(lengths))
        while len(number):
            places = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            rounds = max(4, STATE_ROWS // len(tokens))
            self.con.register("start", pa.table({"key": (np.repeat(number, lengths) << 31) | places, "tok": tokens.astype(np.int32)}))
            found = self.con.sql(sql, params={"rounds": rounds}).to_arrow_table().combine_chunks()
            self.con.unregister("start")
            lists = found["toks"].chunk(0)
            w, values, counts = np.asarray(found["w"]), np.asarray(lists.values), np.diff(np.asarray(lists.offsets))
            more = np.asarray(found["lvl"]) >= rounds  # not known to be done: on from here
            done.append((w[~more], counts[~more], values[np.repeat(~more, counts)]))
            number, lengths, tokens = w[more], counts[more], values[np.repeat(more, counts)]
        w, lengths, values = (np.concatenate([d[i] for d in done]) for i in range(3))
        return _gather(values, np.cumsum(lengths) - lengths, lengths, np.argsort(w))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct matches of the pattern, one after the other, and each one's number of them."""
        raw = [p.encode() for p in pieces]
        ranks = np.fromiter((self.ranks.get(r, -1) for r in raw), np.int32, len(raw))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        whole = np.flatnonzero(ranks >= 0)
        at, ids, lengths = [whole], [ranks[whole]], [np.ones(len(whole), dtype=np.int64)]
        for sql, some in ((_ONE_PAIR, size <= SHORT_BYTES), (_ALL_PAIRS, size > SHORT_BYTES)):
            words = np.flatnonzero(some & (ranks < 0))
            borders = np.flatnonzero(np.diff(np.cumsum(size[words]) // QUERY_BYTES)) + 1
            for part in np.split(words, borders) if len(words) else []:
                tokens = self.byte_ids[np.frombuffer(b"".join([raw[i] for i in part]), dtype=np.uint8)]
                values, counts = self._contract(sql, tokens, size[part])
                at.append(part)
                ids.append(values)
                lengths.append(counts)
        n = np.concatenate(lengths)
        return _gather(np.concatenate(ids), np.cumsum(n) - n, n, np.argsort(np.concatenate(at)))

    # -------------------------------------------------------------------------------- texts

    def _learn(self, new: list[str]) -> None:
        """Encodes chunks not seen before."""
        find, number, parts, places = self.pieces, {}, [], []
        for chunk in new:
            text = chunk[1:] if chunk[:1] == " " else " " + chunk
            found = (text,) if chunk.isalpha() else find(text)
            parts.append(len(found))
            places += [number.setdefault(p, len(number)) for p in found]
        ids, lengths = self.encode_pieces(list(number))
        values, counts = _gather(ids, np.cumsum(lengths) - lengths, lengths, np.array(places, dtype=np.int64))
        sums = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(parts, dtype=np.int64)])]
        self.known.update(zip(new, range(len(self.ends) - 1, len(self.ends) - 1 + len(new)), strict=True))
        self.ends = np.concatenate([self.ends, self.ends[-1] + sums[1:]])
        self.ids = np.concatenate([self.ids, values])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids of the texts, one after the other, and each text's number of them."""
        if len(self.known) > CACHE_CHUNKS:
            self._forget_rare()
        cut = [chunks.cut(t) if t else [] for t in texts]
        new: set[str] = set()
        for c in cut:
            if c:
                c[0] = " " + c[0]
                new.update(c)
        new -= self.known.keys()
        if new:
            self._learn(list(new))
        look = self.known.__getitem__
        numbers: list[int] = []
        for c in cut:
            numbers.extend(map(look, c))
        per_text = np.cumsum([0, *map(len, cut)])
        order = np.array(numbers, dtype=np.int64)
        self.uses += np.bincount(order, minlength=len(self.uses))
        ids, lengths = _gather(self.ids, self.ends[:-1], np.diff(self.ends), order)
        return ids, np.diff(np.concatenate([[0], np.cumsum(lengths)])[per_text])

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Bytes of consecutive runs of token ids; ids outside the vocabulary give no bytes."""
        out = [bytearray() for _ in lengths]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        for at in range(0, len(ids), QUERY_TOKENS):
            run = owner[at : at + QUERY_TOKENS].astype(np.int32)
            part = pa.table({"run": run, "pos": np.arange(len(run), dtype=np.int32), "id": ids[at : at + QUERY_TOKENS].astype(np.int32)})
            self.con.register("tokens", part)
            for r, text in self.con.execute(_DECODE).fetchall():
                out[r] += bytes.fromhex(text)
            self.con.unregister("tokens")
        return [bytes(o) for o in out]


_WORKERS: dict[tuple[str, str], DuckBPE] = {}


def worker(path: str, pattern: str) -> DuckBPE:
    """One DuckDB per worker process and vocabulary."""
    if (path, pattern) not in _WORKERS:
        _WORKERS[path, pattern] = DuckBPE(path, pattern)
    return _WORKERS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Replaces ``text`` by its token ids (array of int); with ``decoded``, also adds the bytes that those ids decode to.

    A null or empty text gives an empty array and no bytes.  Every match of ``pattern`` is encoded
    by itself and no string is special.  Repeated rows give repeated results, an empty table an
    empty one; columns named like an output are replaced.
    """

    def make():
        bpe = worker(path, pattern)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            values, lengths = bpe.encode(batch.column(text).to_pylist())
            arrays: list[pa.Array] = [list_array(values, lengths, pa.int32())]
            if decoded:
                arrays.append(pa.array(bpe.decode(values, lengths), pa.binary()))
            return arrays

        return run

    outputs: list[tuple[str, T.DataType]] = [(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        outputs.append((decoded, T.BinaryType()))
    return map_arrow(df, outputs, make, drop=(text,))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes that each row's token ids decode to; null ids give no bytes, ids outside the vocabulary none."""

    def make():
        bpe = worker(path, pattern)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            lists = [[i for i in row or [] if i is not None] for row in batch.column(ids).to_pylist()]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for row in lists for i in row), np.int64, int(lengths.sum()))
            return [pa.array(bpe.decode(flat, lengths), pa.binary())]

        return run

    return map_arrow(df, [(decoded, T.BinaryType())], make)
