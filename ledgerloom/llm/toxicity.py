"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A bag holds the byte n-grams (3 to 5, word edges included) of up to
``BAG_WORDS`` neighbouring words.  Each n-gram has an embedding in a hashed
table; a bag is the average of its embeddings, and a linear softmax over that
average gives its class.  Embeddings and softmax are trained together, so a
misspelling that was never seen shares the vectors of the n-grams it kept.

A document is as toxic as its most toxic bag.  Labels are per document, so
training first takes every bag of a toxic document as toxic and then, as the
model sharpens, only the bags that look toxic.  A part of the sample that
training does not see calibrates the scores.

Training takes at most ``TRAIN_DOCS`` labelled documents of each class, drawn
by a hash of the id among the labelled ids that have a document; scoring reads whole texts of all rows.

Defined cases: texts without a word (null, empty, blank) have no bag and get the
lowest score the calibration gives; without labels of both classes every score
is the share of label 1 (0 without labels); several labels of one id count as
their maximum, and of several texts of one id the least is learnt from; repeated rows and null ids give a row each; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, remainder
from ledgerloom.llm.textcodes import IS_WORD, LOWER, Chunk, chunks

#: Labelled documents that training may take: toxic, clean.
TRAIN_DOCS = (1000, 2500)
BAG_WORDS = 4
SIZES = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 8
EPOCHS = 8
_NO_BAG = -50.0
_K = np.uint32(0x01000193)


def grams(chunk: Chunk) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """N-gram buckets with the bag of each, per size; and the document of each bag."""
    # Texts side by side with one blank around each; all white space is a blank.
    n = len(chunk.data)
    doc = np.repeat(np.arange(chunk.n), np.diff(chunk.offsets))
    padded = np.full(n + chunk.n + 1, 32, np.uint8)
    place = np.arange(n) + doc + 1
    padded[place] = np.where(IS_WORD[chunk.data], LOWER[chunk.data], 32)
    filled = padded != 32
    begins = filled.copy()
    begins[1:] &= ~filled[:-1]
    starts = np.flatnonzero(begins)
    word = np.cumsum(begins) - 1
    # Bags: BAG_WORDS words in a row, anew in each document.
    doc_of_word = np.searchsorted(chunk.offsets[1:] + np.arange(1, chunk.n + 1), starts, side="right")
    counts = np.bincount(doc_of_word, minlength=chunk.n)
    rank = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    bags = -(-counts // BAG_WORDS)
    bag_of_word = np.repeat(np.cumsum(bags) - bags, counts) + rank // BAG_WORDS
    out = []
    code = padded.astype(np.uint32)
    for size in SIZES:
        m = len(padded) - size + 1
        if m <= 0:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.int64)))
            continue
        inner = filled[1:m + 1].copy()
        for k in range(2, size - 1):
            inner &= filled[k:m + k]
        at = np.flatnonzero(inner)
        h = np.full(len(at), 2166136261 + size, np.uint32)
        for k in range(size):
            h = (h ^ code[at + k]) * _K
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out.append(((h & np.uint32(BUCKETS - 1)).astype(np.int32), bag_of_word[word[at + 1]]))
    return out, np.repeat(np.arange(chunk.n), bags)


@dataclass
class Model:
    """``weight``: what an n-gram adds to the log-odds of its bag, before averaging."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    rate: float

    def bag_logits(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        found, doc = grams(chunk)
        total, count = np.zeros(len(doc)), np.zeros(len(doc))
        for bucket, bag in found:
            total += np.bincount(bag, weights=self.weight[bucket], minlength=len(doc))
            count += np.bincount(bag, minlength=len(doc))
        return total / np.maximum(count, 1) + self.bias, doc

    def logits(self, chunk: Chunk) -> np.ndarray:
        """Of each document: that of its most toxic bag."""
        logit, doc = self.bag_logits(chunk)
        out = np.full(chunk.n, _NO_BAG)
        np.maximum.at(out, doc, logit)
        return out

    def score(self, chunk: Chunk) -> np.ndarray:
        if not self.slope:
            return np.full(chunk.n, self.rate)
        return _sigmoid(self.slope * np.maximum(self.logits(chunk), _NO_BAG) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _train_bags(bucket: np.ndarray, first: np.ndarray, label: np.ndarray, doc: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Joint training of embeddings and softmax on bags; ``bucket`` holds the n-grams bag after bag."""
    rng = np.random.default_rng(seed)
    table = (rng.normal(size=(BUCKETS, DIM)) / DIM).astype(np.float32)
    soft = np.zeros((DIM, 2), np.float32)
    soft[:, 1] = rng.normal(size=DIM) / DIM
    bias = np.zeros(2, np.float32)
    seen_t, seen_s, seen_b = (np.full(x.shape, 1e-6, np.float32) for x in (table, soft, bias))
    size = np.diff(first)
    weight = np.ones(len(label), np.float32)
    batch = 512
    for epoch in range(EPOCHS):
        order = rng.permutation(len(label))
        for k in range(0, len(order), batch):
            rows = order[k:k + batch]
            rows = rows[(weight[rows] > 0) & (size[rows] > 0)]
            if not len(rows):
                continue
            ends = np.cumsum(size[rows])
            ids = bucket[np.arange(ends[-1]) + np.repeat(first[rows] - (ends - size[rows]), size[rows])]
            mean = np.add.reduceat(table[ids], ends - size[rows], axis=0) / size[rows, None]
            logit = mean @ soft + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            p *= (weight[rows] / weight[rows].sum())[:, None]
            to_mean = (p @ soft.T) / size[rows, None]
            to_soft, to_bias = mean.T @ p, p.sum(0)
            spread = np.repeat(to_mean, size[rows], axis=0)
            for d in range(DIM):
                g = np.bincount(ids, weights=spread[:, d], minlength=BUCKETS).astype(np.float32)
                seen_t[:, d] += g * g
                table[:, d] -= 0.5 * g / np.sqrt(seen_t[:, d])
            seen_s += to_soft**2
            soft -= 0.1 * to_soft / np.sqrt(seen_s)
            seen_b += to_bias**2
            bias -= 0.1 * to_bias / np.sqrt(seen_b)
        if epoch >= 1:  # of a toxic document, go on with the bags that look toxic
            w = table @ (soft[:, 1] - soft[:, 0])
            logit = np.full(len(size), _NO_BAG)
            for k in range(0, len(size), 1 << 15):
                part = size[k:k + (1 << 15)]
                of = np.repeat(np.arange(len(part)), part)
                logit[k:k + len(part)] = np.bincount(of, weights=w[bucket[first[k]:first[k + len(part)]]], minlength=len(part))
            logit = np.where(size > 0, logit / np.maximum(size, 1), _NO_BAG) + bias[1] - bias[0]
            top = np.full(doc.max() + 1, -np.inf)
            np.maximum.at(top, doc, logit)
            weight = np.where(label == 0, 1.0, (logit >= top[doc]) | (logit > 2.0)).astype(np.float32)
            weight[label == 1] *= (label == 0).sum() / max(weight[label == 1].sum(), 1) * 0.5
    return table @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0])


def _as_chunks(texts: list[str]) -> Iterator[Chunk]:
    yield from chunks(pa.array(texts, pa.large_string()))


def fit(texts: list[str], labels: np.ndarray, share: float, seed: int = 5) -> Model:
    """A model from sampled texts; ``share``: of label 1 among all labelled rows."""
    labels = np.asarray(labels)
    if not 0 < labels.sum() < len(labels):
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 0.0, share)
    rng = np.random.default_rng(seed)
    aside = rng.random(len(texts)) < 0.25
    for c in (0, 1):  # both parts need both classes
        own = np.flatnonzero(labels == c)
        aside[own[:1]] = len(own) == 1
        if len(own) > 1:
            aside[own[0]], aside[own[1]] = True, False
    learn = np.flatnonzero(~aside)
    if len(set(labels[learn])) < 2:
        learn = np.arange(len(texts))
    buckets, sizes, doc = [], [], []
    chunk_start = 0
    for chunk in _as_chunks([texts[i] for i in learn]):
        found, doc_of_bag = grams(chunk)
        bucket, bag = (np.concatenate(x) for x in zip(*found))
        buckets.append(bucket[np.argsort(bag, kind="stable")])
        sizes.append(np.bincount(bag, minlength=len(doc_of_bag)))
        doc.append(doc_of_bag + chunk_start)
        chunk_start += chunk.n
    doc = np.concatenate(doc)
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    bucket = np.empty(int(first[-1]), np.int32)
    for k, part in zip(np.cumsum([0, *map(len, buckets)]), list(buckets)):
        bucket[k:k + len(part)] = part
        buckets.pop(0)
    weight, bias = _train_bags(bucket, first, labels[learn][doc], doc, seed)
    model = Model(weight.astype(np.float32), bias, 1.0, 0.0, share)
    # Platt calibration on the part set aside, at the true share of the classes.
    rest = np.flatnonzero(aside) if aside.any() else learn
    x = np.concatenate([model.logits(c) for c in _as_chunks([texts[i] for i in rest])])
    y = labels[rest].astype(float)
    w = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    x, limit = np.clip(x, -30, 30), 0.5 / len(y)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps, with a small pull towards slope 1
        p = np.clip(_sigmoid(slope * x + shift), limit, 1 - limit)
        g = np.array([(w * (p - y) * x).sum() + (slope - 1) * 0.1, (w * (p - y)).sum() + shift * 0.01])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        slope, shift = slope - step[0], shift - step[1]
    model.slope, model.shift = max(float(slope), 1e-3), float(shift)
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", id_column: str = "doc_id",
          column: str = "text", train_docs: tuple[int, int] = TRAIN_DOCS) -> Model:
    """Fit on a sample of the rows whose id is labelled and for which ``learn`` (over the id) holds."""
    own = labels.where(learn & F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        (F.max(label) > 0).cast("int").alias("label"))
    own = materialize(own.join(docs.select(id_column).distinct(), id_column, "left_semi"), "labelled")
    sizes = {r[0]: r[1] for r in own.groupBy("label").count().collect()}
    total = sum(sizes.values())
    if not total:
        return fit([], np.zeros(0), 0.0)
    # The sample holds at most train_docs ids of each class, so it has a fixed size and is broadcast.
    drawn = None
    for c in sorted(sizes):
        part = own.where(F.col("label") == c).orderBy(F.xxhash64(id_column), id_column).limit(train_docs[0] if c else train_docs[1])
        drawn = part if drawn is None else drawn.union(part)
    drawn = drawn.select(F.col(id_column).alias("sampled_id"), "label")
    rows = (docs.select(id_column, column).join(F.broadcast(drawn), F.col(id_column) == F.col("sampled_id"))
            .groupBy(id_column).agg(F.min(F.coalesce(column, F.lit(""))).alias("text"), F.max("label").alias("label")).collect())
    rows.sort(key=lambda r: r[0])
    return fit([r[1] for r in rows], np.array([int(r[2] > 0) for r in rows]), sum(n for c, n in sizes.items() if c > 0) / total)


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(chunk.first, chunk.n),
                                                  pa.array(shared.value.score(chunk))], names=[id_column, "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, column).mapInArrow(run, f"`{id_column}` {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = train(docs, labels.select("doc_id", "toxic"), ~held_out)
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                       (F.col("score") >= 0.7).cast("int").alias("predicted"))
