"""Exact token counts by dynamic programming over prefixes (operator 10).

A byte-pair encoding is valid exactly if every two neighbouring tokens are: none of the merges
that would cross their border comes before the merges that built them.  So the encoding of a
prefix that ends in token ``t`` is the encoding of the prefix before ``t``, followed by ``t``, and
one pass over a piece gives the token count at *every* prefix of it.  Those counts answer how long
a text is, whether it is over a limit, and where to cut it for a budget, without encoding again.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import chunks
from .common import map_arrow

#: Chunks whose counts a worker remembers; beyond it starts afresh, which costs time only.
CACHE_CHUNKS = 400_000
#: Pairs of tokens remembered, likewise.
CACHE_PAIRS = 1_000_000
NEVER = 1 << 60
SPACES = regex.compile(r"\s{2,}")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary file writes for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Merges:
    """Tokens by their bytes; for each token the rank of the merge that makes it and its two parts."""

    ids: dict[bytes, int]
    rank: list[int]
    left: list[int]
    right: list[int]
    pairs: dict[tuple[int, int], int]
    special: list[str]

    @classmethod
    def load(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = {tok: bytes(letters[c] for c in tok) for tok in spec["model"]["vocab"] if all(c in letters for c in tok)}
        vocab = {tok: i for tok, i in spec["model"]["vocab"].items() if tok in raw}
        size = max(vocab.values()) + 1
        rank, left, right = [NEVER] * size, [-1] * size, [-1] * size
        for tok, i in vocab.items():
            if len(raw[tok]) == 1:
                rank[i] = -1
        pairs: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            i, ia, ib = vocab[a + b], vocab[a], vocab[b]
            pairs[ia, ib] = r
            if rank[i] == NEVER:
                rank[i], left[i], right[i] = r, ia, ib
            if max(rank[ia], rank[ib]) >= r:
                raise ValueError("a merge comes before its parts; prefix counts need an ordered merge list")
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        whole = cls({}, rank, left, right, pairs, special)
        sound = [False] * size
        for tok, i in sorted(vocab.items(), key=lambda kv: rank[kv[1]]):
            if rank[i] == -1:
                sound[i] = True
            elif rank[i] < NEVER:
                a, b = left[i], right[i]
                sound[i] = sound[a] and sound[b] and whole.apart(a, b, rank[i])
        whole.ids = {raw[tok]: i for tok, i in vocab.items() if sound[i]}
        return whole

    def apart(self, x: int, y: int, until: int = NEVER) -> bool:
        """True if no merge ranked before ``until`` joins tokens ``x`` and ``y`` or parts of them across their border.

        Walks back in time: undo the later of the two merges, see whether the two symbols then at
        the border would have merged before the merges that replaced them.
        """
        rank, left, right, pairs = self.rank, self.left, self.right, self.pairs
        end_x = end_y = until  # when the merge that swallows x (or y) comes
        while True:
            m = pairs.get((x, y))
            if m is not None and m < end_x and (m < end_y or (m == end_y and m < until)):
                return False
            rx, ry = rank[x], rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                end_x, x = rx, right[x]
            else:  # of equal merges the left one comes first, so the right one is undone first
                end_y, y = ry, left[y]


class PrefixCounter:
    """Counts at prefixes of texts; remembers chunks seen before."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges.load(path)
        #: Byte -> (the node it leads to, the token that ends there or -1).
        self.trie: dict = {}
        for tok, i in self.merges.ids.items():
            node = self.trie
            for byte in tok[:-1]:
                node = node.setdefault(byte, ({}, -1))[0]
            node[tok[-1]] = (node.get(tok[-1], ({}, -1))[0], i)
        self.apart_before: dict[int, bool] = {}
        self.pieces = chunks.Pieces(pattern)
        self.seen: dict[str, int] = {}
        self.seen_pieces: dict[str, int] = {}

    def piece(self, b: bytes) -> list[int]:
        """Token count at each byte prefix of one match of the pattern (0 first)."""
        root, pairs, apart, apart_before = self.trie, self.merges.pairs, self.merges.apart, self.apart_before
        n = len(b)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            before, c, j, node = last[i], count[i] + 1, i, root
            for byte in b[i:] if i else b:
                step = node.get(byte)
                if step is None:
                    break
                node, t = step
                j += 1
                if t < 0 or last[j] >= 0:
                    continue
                if i:
                    key = before << 20 | t
                    ok = apart_before.get(key)
                    if ok is None:
                        ok = apart_before[key] = (before, t) not in pairs and apart(before, t)
                    if not ok:
                        continue
                last[j], count[j] = t, c
        return count

    def chunk(self, text: str) -> int:
        seen = self.seen_pieces
        if len(seen) > CACHE_CHUNKS:
            seen.clear()
        total = 0
        if len(self.apart_before) > CACHE_PAIRS:
            self.apart_before.clear()
        for p in self.pieces(text):
            n = seen.get(p)
            if n is None:
                n = seen[p] = self.piece(p.encode())[-1]
            total += n
        return total

    def counts(self, parts: list[str]) -> list[int]:
        """Counts of a text's chunks."""
        seen = self.seen
        if len(seen) > CACHE_CHUNKS:
            seen.clear()
        out = [seen.get(p, -1) for p in parts]
        out[0] = self.chunk(parts[0])
        if -1 in out:
            for i, p in enumerate(parts):
                if out[i] < 0:
                    n = seen.get(p)
                    if n is None:
                        n = seen[p] = self.chunk(" " + p)
                    out[i] = n
        return out

    def special_parts(self, text: str) -> list[str]:
        """The text between special tokens; each border is one token."""
        parts = [text]
        for s in self.merges.special:
            if s in text:
                parts = [q for p in parts for q in p.split(s)]
        return parts

    def chunked(self, text: str) -> list[tuple[list[str], list[int]]]:
        """Chunks and their counts, for each part between special tokens."""
        cut = [chunks.cut(p) if p else [] for p in self.special_parts(text)]
        return [(pieces, self.counts(pieces) if pieces else []) for pieces in cut]

    def total(self, text: str) -> int:
        return total(self.chunked(text))

    def prefixes(self, text: str) -> np.ndarray:
        """Exact token count of ``text[:i]`` at every ``i``, for text without special tokens."""
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = whole = 0
        for p in self.pieces(text):
            chars = np.cumsum([0, *(len(c.encode()) for c in p)])
            count = self.piece(p.encode())
            here = whole + np.asarray(count)[chars]
            if len(p) > 2 and p[0] == "'" and p[1].isalpha():  # cut short, it is a sign and letters
                here[2:-1] = whole + 2
            out[at : at + len(p) + 1] = here
            at, whole = at + len(p), whole + count[-1]
        # A prefix that ends in white space takes the run up to there as one match.
        for m in SPACES.finditer(text):
            count = self.piece(m[0].encode())
            ends = np.cumsum([len(c.encode()) for c in m[0]])
            out[m.start() + 1 : m.end() + 1] = out[m.start()] + np.asarray(count)[ends]
        return out

    def fit(self, chunked: list[tuple[list[str], list[int]]], budget: int) -> int:
        """Length of the longest prefix all of whose prefixes have at most ``budget`` tokens."""
        done = at = 0
        for k, (pieces, counts) in enumerate(chunked):
            if k:
                if done + 1 > budget:
                    return at
                done, at = done + 1, at + len(self.merges.special[0])
            if not pieces:
                continue
            # A cut chunk has at most as many tokens as bytes: whole chunks safely below are skipped.
            ends = list(accumulate(counts, initial=done))
            first = bisect_right(ends, budget - 4 * max(map(len, pieces)) - 1)
            first = max(0, first - 1)
            done, at = ends[first], at + sum(map(len, pieces[:first])) + first - (first > 0)
            for i in range(first, len(pieces)):
                shown = (" " if i else "") + pieces[i]
                if done + len(shown.encode()) > budget:
                    over = np.flatnonzero(done + self.prefixes(shown) > budget)
                    if len(over):
                        return at + int(over[0]) - 1
                done, at = done + counts[i], at + len(shown)
        return at


def total(chunked: list[tuple[list[str], list[int]]]) -> int:
    return len(chunked) - 1 + sum(sum(counts) for _, counts in chunked)


_COUNTERS: dict[tuple[str, str], PrefixCounter] = {}


def counter(path: str, pattern: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = PrefixCounter(path, pattern)
    return _COUNTERS[path, pattern]


def count_tokens(df: DataFrame, path: str, pattern: str, budget: int, text: str = "text") -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``fit_chars`` to every row; all other columns but the text are kept.

    ``fit_chars`` is the length in code points of the longest prefix that stays within ``budget``.
    A null text counts as empty (0, 0, 0).  Repeated rows give repeated results; an empty table
    an empty one.  Columns named like an output are replaced.
    """

    def make():
        c = counter(path, pattern)

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            n_bytes, n_tokens, fit = [], [], []
            for value in batch.column(text).to_pylist():
                value = value or ""
                parts = c.chunked(value)
                n_bytes.append(len(value.encode()))
                n_tokens.append(total(parts))
                fit.append(len(value) if n_bytes[-1] <= budget else c.fit(parts, budget))
            return [pa.array(x, pa.int64()) for x in (n_bytes, n_tokens, fit)]

        return run

    return map_arrow(
        df, [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("fit_chars", T.LongType())], make, drop=(text,)
    )
