"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity has the grades 0 (clean), 1 and 2. The model is the proportional-odds
one: P(grade > k) = 1 / (1 + exp(threshold_k - w . x)), one weight vector for
all thresholds, which are kept in order. The score is the expected severity,
the sum of these probabilities; a document is rejected if P(grade > 0) is at
least ``REJECT``. Toxic documents are rare, so the thresholds start far from
zero and a single strong word in a long text stays below one half, while clean
documents stay near their base rate of 0.01; 0.2 lies between.

Features are words of four letters or more and word beginnings of four to six
letters (stems, in languages that join words); a value is 1 + log(1 + 1000 x
occurrences / words), so one hit counts in a long text and density adds to it.
The labels say whether a document is toxic; how severe it is follows from how dense
it is in features that its language's clean documents hardly have: toxic
documents below the median density have grade 1, the others 2. If all are
equally dense, the sample does not tell severe ones apart: all have grade 1, and
the upper threshold is out of reach.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, map_texts
from quarry.llm.labelled import sample

SAMPLE = 12_000  # labelled documents to learn from, at most
FEATURES = 3_000  # chosen by chi-square
MIN_DOCS = 5
STEMS = (4, 5, 6)
MIN_CHI = 30.0  # chi-square of a feature that is worth a weight
PER = 1000.0
GRADES = 3
UNREACHED = 50.0  # distance of a threshold that no document passes
REJECT = 0.2
EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_/\\"


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def features(counts: Counter) -> Counter:
    """Occurrences of each word and each stem (marked with a ``^``)."""
    out: Counter = Counter()
    for w, n in counts.items():
        for f in _features_of(w.strip(EDGE)):
            out[f] += n
    return out


def _features_of(w: str) -> list[str]:
    return [w, *("^" + w[:k] for k in STEMS if len(w) >= k)] if len(w) >= STEMS[0] else []


def value(n: int, total: int) -> float:
    return 1 + math.log1p(PER * n / total)


@dataclass
class Ordinal:
    """A fitted model: weights of the features and ordered thresholds."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def __post_init__(self):
        self.starts = {f.lstrip("^")[: STEMS[0]] for f in self.weights}

    def linear(self, text: str | None) -> float:
        """w . x of a text."""
        cut = words(text)
        found: dict[str, int] = {}
        weights, starts, first = self.weights, self.starts, STEMS[0]
        for w, n in Counter(cut).items():
            if w[:first] in starts or w[0] in EDGE and w.strip(EDGE)[:first] in starts:
                for f in _features_of(w.strip(EDGE)):
                    if f in weights:
                        found[f] = found.get(f, 0) + n
        return sum(weights[f] * value(n, len(cut)) for f, n in found.items())

    def above(self, linear: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and threshold k; it falls with k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - np.asarray(linear)[:, None], -500, 500)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, weight: np.ndarray,
                n_features: int, grades: int = GRADES, ridge: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest weighted likelihood less a ridge
    penalty, by Adam on the whole sparse sample. Gaps between thresholds are
    exponentials, so they stay in order."""
    total = weight.sum()
    share = np.array([(weight * (grade <= k)).sum() for k in range(grades - 1)]) / total
    start = np.log(np.clip(share, 1e-4, 1 - 1e-4) / (1 - np.clip(share, 1e-4, 1 - 1e-4)))
    p = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        w, cut = p[:n_features], p[n_features:]
        theta = cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])
        s = np.bincount(rows, values * w[cols], len(grade))
        ends = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = _sigmoid(ends[grade + 1] - s), _sigmoid(ends[grade] - s)
        prob = np.maximum(hi - lo, 1e-12)
        ds = (hi + lo - 1) * weight / total  # of the log likelihood
        g = np.empty_like(p)
        g[:n_features] = np.bincount(cols, values * ds[rows], n_features) - ridge * w
        dhi, dlo = hi * (1 - hi) / prob * weight / total, lo * (1 - lo) / prob * weight / total
        d_theta = np.array([dhi[grade == k].sum() - dlo[grade == k + 1].sum() for k in range(grades - 1)])
        g[n_features] = d_theta.sum()
        g[n_features + 1:] = np.cumsum(d_theta[::-1])[::-1][1:] * np.exp(cut[1:])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    cut = p[n_features:]
    return p[:n_features], cut[0] + np.concatenate([[0.0], np.cumsum(np.exp(cut[1:]))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, size: int = SAMPLE, n_features: int = FEATURES) -> Ordinal:
    """Learn from at most ``size`` labelled rows that are not held out.

    Document frequencies are counted and features chosen in Spark; the driver
    gets the chosen ones and the sample's sparse rows. Without a row of either
    class the model has no weights and rejects nothing.
    """
    rows = sample(docs, labels, "toxic", size, scratch)
    n = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        scratch.drop(rows)
        return Ordinal({}, np.array([50.0, 51.0]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[label].update(features(Counter(words(text))).keys())
        both = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(both), 50_000):
            part = both[i: i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([c[f] for f in part], pa.int64()) for c in seen)], names=["feature", "clean", "toxic"])

    counted = rows.select("label", "text").mapInArrow(count, "feature string, clean bigint, toxic bigint")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("clean") + F.col("toxic") >= MIN_DOCS)
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    c, d = n[1] - a, n[0] - b
    chi = F.pow(a * d - b * c, F.lit(2.0)) / ((a + b) * (c + d + 1) * float(n[0]) * float(n[1]))
    chosen = counted.withColumn("chi", chi).where(F.col("chi") > MIN_CHI / (n[0] + n[1])).orderBy(F.col("chi").desc(), "feature").limit(n_features).collect()
    at = {r.feature: i for i, r in enumerate(chosen)}
    marker = {r.feature for r in chosen if r.toxic * n[0] > 20 * (r.clean + 1) * n[1]}

    def vectors(texts: list) -> dict:
        cols, vals, dense = [], [], []
        for t in texts:
            cut = words(t)
            f = {k: v for k, v in features(Counter(cut)).items() if k in at}
            cols.append([at[k] for k in f])
            vals.append([value(v, len(cut)) for v in f.values()])
            hits = sum(n for w, n in Counter(cut).items() if not marker.isdisjoint(_features_of(w.strip(EDGE))))
            dense.append(hits / max(1, len(cut)))
        return {"cols": cols, "vals": vals, "dense": dense}

    got = map_texts(rows, vectors, "cols array<int>, vals array<double>, dense double").collect()
    got.sort(key=lambda r: r.doc_id)  # sums do not follow the order in which tasks end
    scratch.drop(rows)
    label, weight, dense = np.array([r.label for r in got]), np.array([r.weight for r in got]), np.array([r.dense for r in got])
    middle = np.median(dense[label == 1])
    grade = np.where(label == 0, 0, np.where(dense < middle, 1, 2))
    grades = GRADES if (grade == 1).any() and (grade == 2).any() else 2
    grade = np.minimum(grade, grades - 1)
    r = np.repeat(np.arange(len(got)), [len(x.cols) for x in got])
    w, theta = fit_ordinal(r, np.concatenate([np.array(x.cols, np.int64) for x in got]), np.concatenate([np.array(x.vals) for x in got]), grade, weight, len(at), grades)
    if grades < GRADES:
        theta = np.append(theta, theta[-1] + UNREACHED)
    return Ordinal({f: float(w[i]) for f, i in at.items() if abs(w[i]) > 1e-4}, theta)


def with_severity(docs: DataFrame, model: Ordinal, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``text`` replaced by ``severity`` (expected grade, 0 to 2),
    ``p_toxic`` and ``p_severe``, the probabilities of grades above 0 and 1, and
    ``toxic``, whether it is rejected.

    A null or empty text has no features; its score is that of the thresholds.
    Null ids and repeated rows stay; columns of the made names are replaced; an
    empty table gives no rows.
    """

    def make(texts: list) -> dict:
        p = model.above(np.array([model.linear(t) for t in texts]))
        out = {"severity": p.sum(axis=1), "p_toxic": p[:, 0], "p_severe": p[:, -1], "toxic": p[:, 0] >= REJECT}
        return {text: texts} | out if keep_text else out

    made = "severity double, p_toxic double, p_severe double, toxic boolean"
    return map_texts(docs, make, f"`{text}` string, {made}" if keep_text else made, text)


def clean(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, columns as they were."""
    names = [f"__c{i}" for i in range(len(docs.columns))]  # no clash with the scores
    rows = with_severity(docs.toDF(*names), model, names[docs.columns.index(text)], keep_text=True)
    return rows.where("not toxic").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
