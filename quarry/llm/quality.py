"""Quality classifier: ordinal cumulative-link regression on graded ratings (operator 2).

P(grade <= k) = sigmoid(threshold_k - w.x), with one weight vector over hashed text features for all grades and ordered
thresholds. It gives the expected grade and the probability of a high grade, by which documents are selected.
The fit reads a bounded sample of the labelled rows; gradients are summed over partitions and iterated from the driver, which
holds the weights only. Scoring is one pass over the texts, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, free_name, map_arrow, struct

DIMS = 1 << 15
#: At most about this many labelled rows are fitted on (a fraction by hash of the id, so the bound holds in expectation).
SAMPLE = 12_000
MOST_GRADES = 16
TOKEN = re.compile(r"\w+|[^\w\s]+")
FEATURES = struct(("at", "array<int>"), ("value", "array<float>"), ("grade", "double"))


class Featurizer:
    """Hashed features of a text: root shares of words and of runs of other signs, of repeats, capitals and digits, and steps of vocabulary richness and length."""

    def __init__(self, dims: int = DIMS, most: int = 100_000):
        self.dims, self.most, self.known = dims, most, {}

    def slot(self, token: str) -> int:
        at = self.known.get(token)
        if at is None:
            if len(self.known) >= self.most:
                self.known.clear()
            at = self.known[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.dims
        return at

    def __call__(self, text: str | None) -> tuple[list[int], list[float]]:
        tokens = TOKEN.findall(text or "")
        counts = Counter(tokens)
        n = len(tokens)
        shares: Counter = Counter()
        for token, count in counts.items():
            shares[self.slot(token.lower())] += count
            if token.isupper() and len(token) > 1:
                shares[self.slot("\0upper")] += count
            elif token.isdigit():
                shares[self.slot("\0digit")] += count
            elif not token[0].isalnum():
                shares[self.slot("\0sign")] += count
        shares[self.slot("\0repeat")] += sum(map(str.__eq__, tokens, tokens[1:]))
        at, value = list(shares), [(c / n) ** 0.5 if n else 0.0 for c in shares.values()]
        for name, step in (("rich", int(10 * len(counts) / n) if n else -1), ("length", n.bit_length())):
            at.append(self.slot(f"\0{name}{step}"))
            value.append(0.25)
        return at, value


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class OrdinalModel:
    """weights and rising thresholds; grades in order, one more than thresholds."""

    grades: list[float]
    weights: np.ndarray = field(repr=False)
    thresholds: np.ndarray

    def below(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every k but the last: one row per score."""
        return sigmoid(self.thresholds[None, :] - score[:, None])

    def expected(self, score: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades))
        return self.grades[0] + ((1 - self.below(score)) * steps[None, :]).sum(1)

    def tail(self, score: np.ndarray, grade: float) -> np.ndarray:
        """P(grade at least this)."""
        k = next((i for i, g in enumerate(self.grades) if g >= grade), len(self.grades))
        if k == 0:
            return np.ones(len(score))
        return np.zeros(len(score)) if k == len(self.grades) else 1 - self.below(score)[:, k - 1]


def labelled_features(docs: DataFrame, labels: DataFrame, grade_col: str, sample: int, dims: int) -> DataFrame:
    """at, value, grade of a bounded sample of labelled documents."""
    rated = labels.filter(F.col(grade_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(grade_col).alias("grade"))
    share = sample / max(1, rated.count())
    if share < 1:
        rated = rated.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000))
    # the sample's bound is the bound of what is broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer(dims)
        for batch in batches:
            found = [featurize(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32())), batch.column("grade").cast(pa.float64())], FEATURES.names)

    return map_arrow(chosen.select("text", "grade"), run, FEATURES)


def binned(counts: list[tuple[float, int]], most: int = MOST_GRADES) -> list[tuple[float, int]]:
    """Grades and their rows, at most `most` of them: the lowest, the highest and those at even quantiles between; the rows of others count with the nearest, as gradient does."""
    if len(counts) <= most:
        return counts
    grades, n = np.array([g for g, _ in counts]), np.array([c for _, c in counts])
    at = np.searchsorted(np.cumsum(n), np.linspace(0, 1, most) * n.sum())
    kept = grades[np.unique(np.concatenate([[0, len(grades) - 1], np.minimum(at, len(grades) - 1)]))]
    nearest = np.abs(grades[:, None] - kept[None]).argmin(1)
    return [(float(g), int(n[nearest == i].sum())) for i, g in enumerate(kept)]


def fit(docs: DataFrame, labels: DataFrame, grade_col: str = "quality", sample: int = SAMPLE, dims: int = DIMS, steps: int = 40, ridge: float = 1e-4) -> OrdinalModel:
    """Fits on documents that have a grade. Several ratings of a document are averaged and rounded to the next grade that occurs.

    More than MOST_GRADES grades are binned at quantiles, the lowest and the highest kept. Without labelled rows all weights are zero and the only grade is 1; with a single grade every document gets it.
    """
    rows = cut(labelled_features(docs, labels, grade_col, sample, dims), "rated").coalesce(8)  # after the cut: the texts are read by as many tasks as they have parts
    # the sample is bounded, so its distinct grades are
    counts = binned(sorted((r["grade"], r["count"]) for r in rows.groupBy("grade").count().collect()))
    grades = [g for g, _ in counts] or [1.0]
    if len(grades) < 2:
        return OrdinalModel(grades, np.zeros(dims), np.zeros(0))
    share = np.cumsum([c for _, c in counts])[:-1] / sum(c for _, c in counts)
    thresholds, weights = np.log(share / (1 - share)), np.zeros(dims)
    # Adam on the mean loss; first threshold and log gaps are free, so thresholds stay in order
    free = np.concatenate([weights, [thresholds[0]], np.log(np.maximum(np.diff(thresholds), 1e-3))])
    m, v = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, steps + 1):
        model = OrdinalModel(grades, free[:dims], np.cumsum(np.concatenate([free[dims : dims + 1], np.exp(free[dims + 1 :])])))
        g, n = gradient(rows, model)
        slope = np.concatenate([g[:dims] + ridge * n * free[:dims], [g[dims:].sum()], [g[dims + 1 + j :].sum() * np.exp(free[dims + 1 + j]) for j in range(len(grades) - 2)]]) / n
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        free = free - 0.5 / (1 + step / 20) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return OrdinalModel(grades, free[:dims], np.cumsum(np.concatenate([free[dims : dims + 1], np.exp(free[dims + 1 :])])))


def gradient(rows: DataFrame, model: OrdinalModel) -> tuple[np.ndarray, int]:
    """Of the negative log likelihood, over weights and thresholds; and the number of rows. One vector per partition (eight at most) comes back."""
    grades, dims = np.array(model.grades), len(model.weights)
    weights, cuts = model.weights.astype(np.float32), np.concatenate([[-np.inf], model.thresholds, [np.inf]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims + len(grades) - 1), 0
        for batch in batches:
            at, value = batch.column("at"), batch.column("value")
            sizes = np.diff(at.offsets.to_numpy())
            slots, values = at.flatten().to_numpy(), value.flatten().to_numpy()
            doc = np.repeat(np.arange(len(sizes)), sizes)
            score = np.bincount(doc, weights[slots] * values, len(sizes))
            y = np.abs(batch.column("grade").to_numpy()[:, None] - grades[None, :]).argmin(1)
            upper, lower = sigmoid(cuts[y + 1] - score), sigmoid(cuts[y] - score)
            p = np.maximum(upper - lower, 1e-12)
            du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p  # of log p, by each of the two thresholds
            total[:dims] += np.bincount(slots, (du - dl)[doc] * values, dims)
            inner = y < len(grades) - 1
            total[dims:] -= np.bincount(y[inner], du[inner], len(grades) - 1)
            inner = y > 0
            total[dims:] += np.bincount(y[inner] - 1, dl[inner], len(grades) - 1)
            n += len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary()), pa.array([n], pa.int64())], ["total", "n"])

    parts = map_arrow(rows, run, struct(("total", "binary"), ("n", "bigint"))).collect()
    return sum(np.frombuffer(r["total"], "<f8") for r in parts), sum(r["n"] for r in parts)


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text", grade: float | None = None, expected_col: str = "expected_grade", tail_col: str = "tail_probability") -> DataFrame:
    """docs with the expected grade and P(grade >= `grade`; the highest, if not given) of each text. Null texts count as empty; all rows and columns stay."""
    at_least = model.grades[-1] if grade is None else grade
    names = docs.columns
    out = T.StructType([*docs.schema.fields, *struct((expected_col, "double"), (tail_col, "double")).fields])
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer(len(model.weights))
        for batch in batches:
            found = [featurize(t) for t in batch.column(place).to_pylist()]
            sizes = np.fromiter((len(f[0]) for f in found), np.int64, len(found))
            slots, values = np.array([x for f in found for x in f[0]], np.int64), np.array([x for f in found for x in f[1]])
            scores = np.bincount(np.repeat(np.arange(len(sizes)), sizes), model.weights[slots] * values, len(sizes))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.expected(scores)), pa.array(model.tail(scores, at_least))], [*names, expected_col, tail_col])

    return map_arrow(docs, run, out)


def select_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, grade_col: str = "quality") -> DataFrame:
    """docs whose probability of the highest grade is at least `least`; columns as they were, whatever their names.

    Null texts count as empty and are judged; equal texts are judged alike, so copies stay or go together. Null ids are judged, but teach nothing. Without labels, or with one grade, every row stays; an empty table stays one.
    """
    a, b = free_name(docs, "q_expected"), free_name(docs, "q_tail")
    scored = score(docs, fit(docs, labels, grade_col), expected_col=a, tail_col=b)
    return scored.filter(F.col(b) >= least).select(*docs.columns)
