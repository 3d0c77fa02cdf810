"""Document quality by histogram gradient-boosted trees.

Each text gives a row of statistics (sizes, character classes, repetition,
line shapes). Trees are grown level by level on binned statistics of a bounded
labelled sample, then flattened into arrays with one row a tree; a batch of
documents goes down all trees at once, one numpy step a level.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, map_texts
from quarry.llm.labelled import held_out, sample

SAMPLE = 24_000  # labelled documents to learn from, at most
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 80, 5, 64, 0.15, 2.0, 20
CUT = 0.3  # scores from here on are predicted 1

_CLASSES = ("lower", "upper", "digit", "blank", "stop", "pipe", "bang", "symbol", "quote", "beyond")
_TABLE = np.zeros((256, len(_CLASSES)))
for _i in range(256):
    _c = chr(_i)
    _k = ("beyond" if _i > 127 else "lower" if "a" <= _c <= "z" else "upper" if "A" <= _c <= "Z" else "digit" if _c.isdigit()
          else "blank" if _c.isspace() else "stop" if _c in ".,;:" else "pipe" if _c == "|" else "bang" if _c in "!?" else "quote" if _c in "'\"()-" else "symbol")
    _TABLE[_i, _CLASSES.index(_k)] = 1

STATISTICS = ("chars", "words", "word_length", "longest_word", "distinct_words", "top_word", "stutter", "short_words", "lines", "distinct_lines",
              "line_words", "stops_a_word", "capital_words", *(f"share_{c}" for c in _CLASSES))


def statistics(text: str | None) -> list[float]:
    """The statistics of a text; all but none are shares, so long texts compare."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(raw, minlength=256) @ _TABLE
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    n, k = max(1, len(words)), max(1, len(lines))
    counts = Counter(words)
    lengths = list(map(len, words))
    return [np.log1p(len(text)), np.log1p(len(words)), sum(lengths) / n, np.log1p(max(lengths, default=0)), len(counts) / n, max(counts.values(), default=0) / n,
            sum(map(str.__eq__, words, words[1:])) / n, sum(map((4).__gt__, lengths)) / n, np.log1p(len(lines)), len(set(lines)) / k, np.log1p(n / k),
            kinds[4] / n, sum(map(str.isupper, counts)) / max(1, len(counts)), *(kinds / max(1, len(raw)))]


@dataclass
class Trees:
    """Complete binary trees: inner nodes in level order, then leaf values."""

    feature: np.ndarray  # (trees, 2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2^depth)
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        tree = np.arange(len(self.feature))
        node = np.zeros((len(x), len(tree)), np.int64)
        for _ in range(self.leaf.shape[1].bit_length() - 1):
            right = np.take_along_axis(x, self.feature[tree, node], axis=1) > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - self.feature.shape[1]].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boost logistic loss with second-order gains on histograms of quantile bins."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)  # x <= edge k falls in bin k
    share = np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4)
    out = Trees(np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)), float(np.log(share / (1 - share))))
    margin = np.full(n, out.base)
    offset = np.arange(m) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            k = 2**level
            cell = ((node * m * bins)[:, None] + offset + code).ravel()
            hists = [np.bincount(cell, np.repeat(w, m), k * m * bins).reshape(k, m, bins).cumsum(axis=2) for w in (grad, hess, np.ones(n))]
            g, h, c = hists
            tg, th, tc = (a[:, :1, -1:] for a in hists)
            gain = g**2 / (h + RIDGE) + (tg - g) ** 2 / (th - h + RIDGE) - tg**2 / (th + RIDGE)
            gain[(c < LEAST) | (tc - c < LEAST)] = -1
            best = gain.reshape(k, -1).argmax(axis=1)
            won = gain.reshape(k, -1)[np.arange(k), best] > 1e-6
            feature, cut = best // bins, best % bins
            at = k - 1 + np.arange(k)
            for i in np.flatnonzero(won):
                out.feature[t, at[i]], out.threshold[t, at[i]] = feature[i], edges[feature[i]][cut[i]]
            node = 2 * node + (won[node] & (code[np.arange(n), feature[node]] > cut[node]))
        leaf_g, leaf_h = np.bincount(node, grad, 2**depth), np.bincount(node, hess, 2**depth)
        out.leaf[t] = -rate * leaf_g / (leaf_h + RIDGE)
        margin += out.leaf[t][node]
    return out


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, size: int = SAMPLE) -> Trees:
    """Learn from at most ``size`` labelled rows that are not held out. Their
    statistics are computed on the executors. Without labels every score is one
    half; with one class only, near that class."""
    rows = sample(docs, labels, "quality", size, scratch)
    got = map_texts(rows.select("label", "weight", "text"), lambda texts: {"x": [statistics(t) for t in texts]}, "x array<double>").collect()
    scratch.drop(rows)
    if not got:
        return Trees(np.zeros((1, 1), np.int64), np.full((1, 1), np.inf), np.zeros((1, 2)), 0.0)
    return grow(np.array([r.x for r in got]), np.array([float(r.label) for r in got]), np.array([r.weight for r in got]))


def with_score(docs: DataFrame, model: Trees, text: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with ``text`` replaced by ``score`` and ``predicted``. A null
    text is scored as the empty one; null ids and repeated rows stay; columns of
    the made names are replaced; an empty table gives no rows. Nothing but the text enters a score."""

    def make(texts: list) -> dict:
        score = model.score(np.array([statistics(t) for t in texts]))
        return {"score": score, "predicted": (score >= cut).astype(np.int32)}

    return map_texts(docs, make, "score double, predicted int", text)


def scored(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, the model learnt from
    the labelled rows of the other folds."""
    model = fit(docs, labels, scratch)
    return with_score(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
