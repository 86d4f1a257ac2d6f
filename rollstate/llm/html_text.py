"""Main text of web pages by boosted trees over DOM blocks (operator 3).

Boosted trees give every block the odds of being article, page furniture or mere wrapping, from
its subtree's size and densities, its attribute tokens, depth and siblings.  Decoding then picks the
most likely labels of the whole tree under the rule that nothing inside furniture is kept and that
inside an article there is only article and furniture, so no choice contradicts one above it.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import dom, page_templates
from .common import map_arrow

LABELS = (page_templates.KEEP, page_templates.DROP, page_templates.PASS)
KEEP, DROP, PASS = range(3)
TRAINING_PAGES, TRAINING_SEED = 700, 11
ROUNDS, DEPTH, BINS, RATE = 60, 4, 32, 0.2


@dataclass
class Trees:
    """Boosted symmetric trees: each level of a tree asks one question of all rows."""

    feature: np.ndarray  # round, class, level
    above: np.ndarray  # round, class, level
    value: np.ndarray  # round, class, leaf
    tag_odds: dict[str, float]
    token_odds: dict[str, float]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-probabilities of the three labels, by row."""
        z = np.zeros((len(x), len(LABELS)), dtype=np.float32)
        columns = np.ascontiguousarray(x.T)
        for r in range(len(self.feature)):
            for c in range(len(LABELS)):
                leaf = np.zeros(len(x), dtype=np.int64)
                for level in range(DEPTH):
                    leaf |= (columns[self.feature[r, c, level]] > self.above[r, c, level]).astype(np.int64) << level
                z[:, c] += self.value[r, c][leaf]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _grow(bins: np.ndarray, edges: np.ndarray, gradient: np.ndarray, weight: np.ndarray):
    """One symmetric tree: on each level the question with the largest gain over all leaves."""
    leaf = np.zeros(bins.shape[1], dtype=np.int64)
    chosen, borders = [], []
    for level in range(DEPTH):
        best, pick = -1.0, (0, 0)
        for f in range(len(bins)):
            place = leaf * BINS + bins[f]
            shape = ((1 << level), BINS)
            g = np.bincount(place, gradient, shape[0] * BINS).reshape(shape).cumsum(axis=1)
            h = np.bincount(place, weight, shape[0] * BINS).reshape(shape).cumsum(axis=1)
            low = g**2 / (h + 1.0)
            high = (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1.0)
            gain = (low + high).sum(axis=0)[:-1]
            at = int(gain.argmax())
            if gain[at] > best:
                best, pick = float(gain[at]), (f, at)
        f, at = pick
        leaf |= (bins[f] > at).astype(np.int64) << level
        chosen.append(f)
        borders.append(edges[f, at])
    g = np.bincount(leaf, gradient, 1 << DEPTH)
    h = np.bincount(leaf, weight, 1 << DEPTH)
    return chosen, borders, -RATE * g / (h + 1.0), leaf


def _odds(seen: list[tuple[str, int]]) -> dict[str, float]:
    kept, dropped = Counter(t for t, y in seen if y == KEEP), Counter(t for t, y in seen if y == DROP)
    passed = Counter(t for t, y in seen if y == PASS)
    return {t: math.log((kept[t] + 0.5 * passed[t] + 1) / (dropped[t] + 0.5 * passed[t] + 1)) for t in kept | dropped | passed}


@lru_cache(maxsize=1)
def train() -> Trees:
    """Fits the trees on labelled template pages (the same for every input)."""
    parsed = [(dom.parse(source), [LABELS.index(y) for y in labels]) for source, labels in page_templates.pages(TRAINING_PAGES, TRAINING_SEED)]
    tag_odds = _odds([(t, y) for p, labels in parsed for t, y in zip(p.tags, labels, strict=True)])
    token_odds = _odds([(t, y) for p, labels in parsed for tokens, y in zip(p.tokens, labels, strict=True) for t in tokens])
    x = np.concatenate([dom.features(p, tag_odds, token_odds) for p, _ in parsed])
    y = np.concatenate([labels for _, labels in parsed])
    # Token odds are seen without the page itself now and then, so that size and density count too.
    hide = np.random.default_rng(TRAINING_SEED).random(len(x)) < 0.15
    for name in ("token_least", "token_most", "tokens"):
        x[hide, dom.FEATURES.index(name)] = 0
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.astype(np.float32)
    bins = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(x.shape[1])])
    z = np.zeros((len(x), len(LABELS)))
    feature = np.zeros((ROUNDS, len(LABELS), DEPTH), dtype=np.int64)
    above = np.zeros((ROUNDS, len(LABELS), DEPTH), dtype=np.float32)
    value = np.zeros((ROUNDS, len(LABELS), 1 << DEPTH), dtype=np.float32)
    for r in range(ROUNDS):
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for c in range(len(LABELS)):
            feature[r, c], above[r, c], value[r, c], leaf = _grow(bins, edges, p[:, c] - (y == c), p[:, c] * (1 - p[:, c]))
            z[:, c] += value[r, c][leaf]
    return Trees(feature, above, value, tag_odds, token_odds)


def decode(parents: list[int], scores: np.ndarray) -> list[int]:
    """Labels of greatest total score such that furniture holds only furniture, and an article no wrapping."""
    n = len(parents)
    total = scores.astype(float).tolist()
    for i in range(n - 1, 0, -1):
        keep, drop, wrap = total[i]
        up = total[parents[i]]
        up[KEEP] += max(keep, drop)
        up[DROP] += drop
        up[PASS] += max(keep, drop, wrap)
    labels = [PASS] * n
    for i in range(1, n):
        keep, drop, wrap = total[i]
        above = labels[parents[i]]
        if above == DROP or (drop >= keep and (above == KEEP or drop >= wrap)):
            labels[i] = DROP
        else:
            labels[i] = KEEP if above == KEEP or keep >= wrap else PASS
    return labels


def main_texts(sources: list[str | None], trees: Trees) -> list[str]:
    """Main text of each page: its article's blocks in order, one to a line."""
    pages = [dom.parse(s or "") for s in sources]
    if not pages:
        return []
    scores = trees.log_odds(np.concatenate([dom.features(p, trees.tag_odds, trees.token_odds) for p in pages]))
    out, at = [], 0
    for p in pages:
        labels = decode(p.parents, scores[at : at + len(p.tags)])
        at += len(p.tags)
        kept = {p.parents[i] for i, y in enumerate(labels) if y == KEEP}
        # Text directly in a wrapper belongs to the article whose blocks stand beside it; where a page
        # has no such block at all (plain text, spans, lines between breaks) it is the article.
        beside = {i for i, y in enumerate(labels) if y == PASS and (i in kept or not kept)}
        out.append("\n".join(shown for node, shown in p.runs if labels[node] == KEEP or node in beside))
    return out


def extract(df: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """Replaces the html by ``text``, the page's main text, and ``n_chars``, its code points.

    Text outside all blocks, or directly in a wrapper, counts as article where article blocks stand
    beside it or the page has none.  A null or empty page, and one with furniture alone, gives an
    empty text and 0.  Repeated rows
    give repeated results, an empty table an empty one; columns named like an output are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(train())

    def make():
        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(source)
            texts = [t for i in range(0, batch.num_rows, 200) for t in main_texts(column.slice(i, 200).to_pylist(), shared.value)]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return run

    return map_arrow(df, [(text, T.StringType()), ("n_chars", T.LongType())], make, drop=(source,))
