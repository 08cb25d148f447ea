"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

The counts of ``docstats`` become a vector of ratios per document.  Random
Fourier features approximate a Gaussian kernel over the standardised vectors;
each partition sums its part of the normal equations, the sums are added up in
a tree, and the driver solves one small system per fold.  Scores that each fold
gives the rows of the other one are binned and made monotone (pool adjacent
violators), which turns ridge scores into probabilities.

All labelled rows that may be learnt from are used; sizes on the driver depend
only on ``FEATURES`` and ``BINS``.

Defined cases: null, empty and blank texts have all-zero counts and are scored
like any text; without labels of both kinds every score is the share of label 1
(0.5 without labels); several labels of one id count as their maximum; repeated
rows and null ids give a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, materialize, remainder, tree_sum
from ledgerloom.llm.docstats import Stats
from ledgerloom.llm.textcodes import Chunk, chunks

#: Random Fourier features.
FEATURES = 256
#: Ridge penalty per row.
RIDGE = 1e-5
#: Bins of ridge scores for the calibration.
BINS = 1024
_LOW, _HIGH = -0.5, 1.5

RATIOS = ("log_words", "word_chars", "word_spread", "symbols", "upper", "digits", "punct", "bangs", "wide",
          "repeats", "distinct", "stutter", "short", "dup_lines", "line_words", "log_lines")


def ratios(chunk: Chunk) -> np.ndarray:
    """One row of ``RATIOS`` per document."""
    s = Stats(chunk)
    n = s.get("n_words").astype(float)
    words, bytes_, rows = np.maximum(n, 1), np.maximum(np.diff(chunk.offsets), 1), s.get("n_lines")
    mean = s.get("word_chars") / words
    spread = np.sqrt(np.maximum(s.get("word_bytes_squared") / words - mean**2, 0))
    upper = s.get("n_upper")
    columns = (np.log1p(n), np.minimum(mean, 40), np.minimum(spread, 40), s.get("n_symbols") / words,
               upper / np.maximum(upper + s.get("n_lower"), 1), s.get("n_digits") / bytes_, s.get("n_punct") / words,
               s.get("n_bangs") / words, s.get("n_wide") / bytes_, s.get("n_repeat_words") / words,
               s.get("n_distinct_words") / words, s.get("n_stutter") / words, s.get("n_short_words") / words,
               s.get("n_dup_lines") / np.maximum(rows, 1), np.log1p(n / np.maximum(rows, 1)), np.log1p(rows))
    return np.stack([np.minimum(c, 50.0) for c in columns], axis=1)


def describe(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, ratios as packed float64) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in chunks(b.column(1)):
                x = ratios(chunk)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(chunk.first, chunk.n),
                                                  pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=[id_column, "ratios"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, column).mapInArrow(run, f"`{id_column}` {kind}, ratios binary")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The non-decreasing fit of bin means under their weights (pool adjacent violators)."""
    blocks: list[list[float]] = []  # weight, mean, bins
    for w, m in zip(weight, mean):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, k2 = blocks.pop()
            w1, m1, k1 = blocks[-1]
            total = w1 + w2
            blocks[-1] = [total, (w1 * m1 + w2 * m2) / total if total else max(m1, m2), k1 + k2]
    return np.concatenate([np.full(k, m) for _, m, k in blocks])


@dataclass
class Model:
    """Everything that scoring needs; ``steps`` maps the bin of a ridge score to a probability."""

    mean: np.ndarray
    spread: np.ndarray
    direction: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    steps: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.spread
        z = np.cos(np.clip(z, -8, 8) @ self.direction + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.steps[bins(self.features(x) @ self.weight)]


def bins(score: np.ndarray) -> np.ndarray:
    return np.clip((score - _LOW) / (_HIGH - _LOW) * BINS, 0, BINS - 1).astype(np.int64)


def fit(labelled: DataFrame, seed: int = 11) -> Model:
    """Fit (ratios, label 0/1, fold 0/1) rows; label and fold are doubles."""
    width = len(RATIOS)
    rng = np.random.default_rng(seed)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = _matrix(b.column(0), width), np.asarray(b.column(1))
            total = np.concatenate([x.sum(0), (x**2).sum(0), [len(x), y.sum()]])
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    sums = tree_sum(labelled.mapInArrow(moments, "sums binary"), "sums")
    n, ones = (sums[-2], sums[-1]) if sums is not None else (0.0, 0.0)
    rate = ones / n if n else 0.5
    mean = sums[:width] / n if n else np.zeros(width)
    spread = np.sqrt(np.maximum(sums[width:2 * width] / n - mean**2, 0)) if n else np.ones(width)
    model = Model(mean, np.maximum(spread, 1e-3), rng.normal(size=(width, FEATURES)) / np.sqrt(width),
                  rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.full(BINS, rate))
    if not 0 < ones < n:
        return model

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, FEATURES + 1, FEATURES + 2))
        for b in batches:
            z, y, fold = model.features(_matrix(b.column(0), width)), np.asarray(b.column(1)), np.asarray(b.column(2))
            for f in (0, 1):
                total[f] += z[fold == f].T @ np.hstack([z[fold == f], y[fold == f, None]])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    total = tree_sum(labelled.mapInArrow(equations, "sums binary"), "sums").reshape(2, FEATURES + 1, FEATURES + 2)

    def solve(t: np.ndarray) -> np.ndarray:
        return np.linalg.solve(t[:, :-1] + (RIDGE * n + 1e-6) * np.eye(FEATURES + 1), t[:, -1])

    other = np.stack([solve(total[1]), solve(total[0])])  # the weights that did not see the fold
    model.weight = solve(total.sum(0))

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BINS))
        for b in batches:
            z, y, fold = model.features(_matrix(b.column(0), width)), np.asarray(b.column(1)), np.asarray(b.column(2))
            at = bins(np.einsum("ij,ij->i", z, other[fold.astype(int)]))
            found += [np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)]
        yield pa.RecordBatch.from_pydict({"sums": pa.array([found.tobytes()], pa.binary())})

    count, positive = tree_sum(labelled.mapInArrow(spread_out, "sums binary"), "sums").reshape(2, BINS)
    filled = np.flatnonzero(count)
    level = isotonic(count[filled], positive[filled] / count[filled])
    model.steps = np.clip(np.interp(np.arange(BINS), filled, level), 0, 1)
    return model


def score(described: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1), len(RATIOS))))],
                                             names=[id_column, "score"])

    kind = described.schema[id_column].dataType.simpleString()
    return described.select(id_column, "ratios").mapInArrow(run, f"`{id_column}` {kind}, score double")


def train(described: DataFrame, labels: DataFrame, learn: Column, label: str = "quality",
          id_column: str = "doc_id") -> Model:
    """Fit on the described rows whose id has a label and for which ``learn`` (over the id) holds."""
    own = labels.where(learn & F.col(label).isNotNull()).groupBy(id_column).agg(
        F.max(F.col(label).cast("double")).alias(fresh(described, "y")))
    rows = described.join(own, id_column)
    fold = F.pmod(F.xxhash64(F.col(id_column)), F.lit(2)).cast("double")
    return fit(rows.select("ratios", F.col(own.columns[1]).alias("y"), fold.alias("fold")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    described = materialize(describe(docs), "ratios")
    model = train(described, labels.select("doc_id", "quality"), ~held_out)
    return score(described, model).select("doc_id", held_out.alias("held_out"), "score",
                                          (F.col("score") >= 0.3).cast("int").alias("predicted"))
