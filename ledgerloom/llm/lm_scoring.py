"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Tokens are lower-cased words and one end per text.  Corpus counts cover every
training token.  The ``WORD_UNITS`` most frequent words and the end are units of
the neural model; any other word is a member of one of ``CLASSES`` units chosen
by its last two bytes.  The model predicts the next unit from the last two,

    s(u | u1, u2) = b[u] + q[u] . (c1[u1] + c2[u2]),

and is trained on all training tokens: each partition runs noise-contrastive
estimation in numpy from shared parameters, and the partitions' parameters are
averaged, in ``ROUNDS`` over disjoint parts of the corpus.  Because s is a sum of
a (u1, u) and a (u2, u) term, two matrix products give all terms and a third,
exp(S1) exp(S2)', gives the normaliser of every context: log-probabilities are
normalised exactly, not assumed to be.

Within a class a word seen in training has its share of the class's tokens, and
the words never seen share the class's Good-Turing mass.  So probabilities of
the seen words and of one unseen word per class add up to one.

The counts of the most frequent words (at most ``TOP_WORDS``, a fixed bound) go
to every task; all rarer words are joined with the count table.

Defined cases: a null text is empty and has its end only; with an empty training
part every word is unseen; repeated rows and null ids give a row each; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, remainder, tree_sum
from ledgerloom.llm.textcodes import LOWER, Chunk, Words, chunks

WORD_UNITS = 959
CLASSES = 64
UNITS = 1 + WORD_UNITS + CLASSES  # unit 0: end, and the context before a text
#: Bound on the words whose counts are sent to every task.
TOP_WORDS = 1 << 19
DIM = 16
NOISE = 64
#: Parts (of 8, by a hash of the text) of the corpus that each round of training takes.
ROUNDS = ((0,), (1, 2, 3), (4, 5, 6, 7))
BATCH = 2048
RATE = 0.1

_CLASS = np.random.default_rng(77).integers(0, CLASSES, 1 << 16).astype(np.int16)


def tokens(chunk: Chunk) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their hashes (as signed longs) and their classes."""
    words = Words(chunk)
    last = LOWER[chunk.data[words.ends - 1]].astype(np.int64)
    before = np.where(words.ends - words.starts > 1, LOWER[chunk.data[words.ends - 2]], 0).astype(np.int64)
    return words, words.hashes().view(np.int64), _CLASS[before * 256 + last]


def count_words(docs: DataFrame, column: str = "text") -> DataFrame:
    """(h, cls, n): how often each word occurs, added up per task before the shuffle."""

    def merge(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, cls, n = (np.concatenate(x) for x in zip(*held))
        found, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        return found, cls[first], np.bincount(inverse, weights=n).astype(np.int64)

    def emit(held: list) -> pa.RecordBatch:
        h, cls, n = merge(held)
        return pa.RecordBatch.from_pydict({"h": h, "cls": pa.array(cls, pa.int16()), "n": n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = limit = 0
        for b in batches:
            for chunk in chunks(b.column(0)):
                _, h, cls = tokens(chunk)
                found, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((found, cls[first], n))
                size += len(found)
                if size > max(2 * limit, 1 << 20):
                    held = [merge(held)]
                    size = limit = len(held[0][0])
                    if limit > 1 << 21:
                        yield emit(held)
                        held, size, limit = [], 0, 0
        if held:
            yield emit(held)

    return (docs.select(column).mapInArrow(run, "h long, cls short, n long").groupBy("h")
            .agg(F.max("cls").alias("cls"), F.sum("n").alias("n")))


@dataclass
class Vocabulary:
    """What every task knows of the corpus; its size has a fixed bound."""

    top: np.ndarray  # hashes, ascending
    count: np.ndarray  # of each in training
    unit: np.ndarray  # of each; 0: none of its own
    ends: int
    tokens: int
    types: int
    class_tokens: np.ndarray
    class_unseen: np.ndarray  # share of a class that belongs to unseen words

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Place in ``top``, or -1."""
        if not len(self.top):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.top, h), len(self.top) - 1)
        return np.where(self.top[at] == h, at, -1)

    def units(self, place: np.ndarray, cls: np.ndarray) -> np.ndarray:
        own = self.unit[place] if len(self.unit) else np.zeros(len(place), np.int64)
        return np.where((place >= 0) & (own > 0), own, 1 + WORD_UNITS + cls)

    def base(self, count) -> np.ndarray:
        return np.log10((np.asarray(count) + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def vocabulary(counts: DataFrame, ends: int) -> tuple[Vocabulary, int]:
    """The bounded part of the counts, and the count from which on words are in it."""
    sizes = {r[0]: (r[1], r[2]) for r in counts.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(
        F.count("*"), F.sum(F.col("n"))).collect()}
    least, held = 1, 0
    for n in sorted(sizes, reverse=True):
        held += sizes[n][0]
        if held > TOP_WORDS:
            least = n + 1
            break
    rows = counts.where(F.col("n") >= least).toArrow()
    h, n, cls = (np.asarray(rows[c].combine_chunks()) for c in ("h", "n", "cls"))
    order = np.argsort(h)
    h, n, cls = h[order], n[order], cls[order]
    unit = np.zeros(len(h), np.int64)
    frequent = np.lexsort((h, -n))[:WORD_UNITS]
    unit[frequent] = np.arange(1, len(frequent) + 1)
    per_class = {r[0]: (r[1], r[2]) for r in counts.groupBy("cls").agg(
        F.sum("n"), F.sum((F.col("n") == 1).cast("long"))).collect()}
    all_ = np.array([per_class.get(k, (0, 0)) for k in range(CLASSES)], float).reshape(CLASSES, 2)
    all_[:, 0] -= np.bincount(cls[frequent], weights=n[frequent], minlength=CLASSES)
    all_[:, 1] -= np.bincount(cls[frequent], weights=n[frequent] == 1, minlength=CLASSES)
    unseen = np.where(all_[:, 0] > 0, (all_[:, 1] + 0.5) / (all_[:, 0] + 1), 1.0)
    total = int(sum(v[1] for v in sizes.values()) + ends)
    types = int(sum(v[0] for v in sizes.values()) + (ends > 0))
    return Vocabulary(h, n, unit, ends, total, types, all_[:, 0], unseen), least


class Parameters:
    """b, q, c1, c2 in one float64 vector, so that partitions' parameters can be added up."""

    SIZE = UNITS * (1 + 3 * DIM)

    def __init__(self, vector: np.ndarray):
        self.vector = vector
        self.b = vector[:UNITS]
        self.q, self.c1, self.c2 = vector[UNITS:].reshape(3, UNITS, DIM)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """S1, S2 and N with log p(u | u1, u2) = S1[u1, u] + S2[u2, u] - N[u1, u2]."""
        s1, s2 = self.c1 @ self.q.T + self.b, self.c2 @ self.q.T
        m1, m2 = s1.max(1, keepdims=True), s2.max(1, keepdims=True)
        norm = np.log(np.exp(s1 - m1) @ np.exp(s2 - m2).T) + m1 + m2.T
        return s1, s2, norm


def start(share: np.ndarray, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([np.log(share), rng.normal(size=3 * UNITS * DIM) * 0.1 / np.sqrt(DIM)])


def contrast(vector: np.ndarray, share: np.ndarray, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]],
             seed: int) -> tuple[np.ndarray, int]:
    """Noise-contrastive estimation over (u1, u2, u) arrays; the new parameters and the tokens seen."""
    p = Parameters(vector.astype(np.float64).copy())
    b, q, c1, c2 = (x.astype(np.float32) for x in (p.b, p.q, p.c1, p.c2))
    seen = [np.full(x.shape, 1.0, np.float32) for x in (b, q, c1, c2)]
    rng = np.random.default_rng(seed)
    cumulative = np.cumsum(share)
    log_noise = np.log(NOISE * share).astype(np.float32)
    total = 0

    def step(x: np.ndarray, s: np.ndarray, g: np.ndarray) -> None:
        s += g * g
        x -= RATE * g / np.sqrt(s)

    def scatter(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(at, weights=rows[:, d], minlength=UNITS) for d in range(DIM)], 1).astype(np.float32)

    for u1, u2, u in batches:
        for k in range(0, len(u), BATCH):
            x1, x2, y = u1[k:k + BATCH], u2[k:k + BATCH], u[k:k + BATCH]
            total += len(y)
            noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), UNITS - 1)
            context = c1[x1] + c2[x2]
            qy, qn = q[y], q[noise]
            real = np.einsum("ij,ij->i", context, qy) + b[y] - log_noise[y]
            fake = context @ qn.T + (b[noise] - log_noise[noise])
            g_real = -1 / (1 + np.exp(np.clip(real, -30, 30)))  # sigmoid(real) - 1
            g_fake = 1 / (1 + np.exp(-np.clip(fake, -30, 30)))
            g_context = g_real[:, None] * qy + g_fake @ qn
            g_q = scatter(y, g_real[:, None] * context)
            np.add.at(g_q, noise, g_fake.T @ context)
            g_b = np.bincount(y, weights=g_real, minlength=UNITS).astype(np.float32)
            np.add.at(g_b, noise, g_fake.sum(0))
            for x, s, g in zip((b, q, c1, c2), seen, (g_b, g_q, scatter(x1, g_context), scatter(x2, g_context))):
                step(x, s, g)
    return np.concatenate([x.ravel() for x in (b, q, c1, c2)]).astype(np.float64), total


def sequences(chunk: Chunk, units: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u1, u2, u) of all tokens of a chunk, ends included; ``counts``: words per document."""
    sizes = counts + 1
    u = np.zeros(int(sizes.sum()), np.int64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(u), bool)
    inner[ends] = False
    u[inner] = units
    first = ends - counts
    u1, u2 = np.zeros_like(u), np.zeros_like(u)
    u1[1:], u2[2:] = u[:-1], u[:-2]
    u1[first] = u2[first] = 0
    second = (first + 1)[counts > 0]
    u2[second] = 0
    return u1, u2, u


def train(docs: DataFrame, vocab: Vocabulary, column: str = "text") -> Parameters:
    """Parameters from all texts of ``docs``: one noise-contrastive pass, averaged after each round."""
    share = np.zeros(UNITS)
    share[0] = vocab.ends
    np.add.at(share, vocab.unit[vocab.unit > 0], vocab.count[vocab.unit > 0])
    share[1 + WORD_UNITS:] = vocab.class_tokens
    share = (share + 0.5) / (share + 0.5).sum()
    vector = start(share)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    own = vocab.unit > 0
    hashes, unit = vocab.top[own], vocab.unit[own]
    for number, part in enumerate(ROUNDS):
        now = docs.sparkSession.sparkContext.broadcast(vector)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def arrays() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
                for b in batches:
                    for chunk in chunks(b.column(0)):
                        words, h, cls = tokens(chunk)
                        units = (1 + WORD_UNITS + cls).astype(np.int64)
                        if len(hashes):
                            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                            units = np.where(hashes[at] == h, unit[at], units)
                        yield sequences(chunk, units, words.counts)

            out, n = contrast(now.value, share, arrays(), 1000 + number)
            yield pa.RecordBatch.from_pydict({"sums": pa.array([np.append(out * n, n).tobytes()], pa.binary())})

        chosen = docs.where(F.pmod(F.xxhash64(column), F.lit(8)).isin(*part)).select(column)
        sums = tree_sum(chosen.mapInArrow(run, "sums binary"), "sums")
        if sums is not None and sums[-1]:
            vector = sums[:-1] / sums[-1]
        now.unpersist()
    shared.unpersist()
    return Parameters(vector)


def score_texts(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, least: int, parameters: Parameters,
                id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every whole text."""
    log10 = np.log(10.0)
    seen_share = np.log10(np.maximum(1 - vocab.class_unseen, 1e-300) / np.maximum(vocab.class_tokens, 1))
    unseen_share = np.log10(vocab.class_unseen)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, parameters.vector))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vector = shared.value
        s1, s2, norm = Parameters(vector).tables()
        top_base = known.base(known.count)
        for b in batches:
            for chunk in chunks(b.column(1)):
                words, h, cls = tokens(chunk)
                place = known.look_up(h)
                units = known.units(place, cls)
                u1, u2, u = sequences(chunk, units, words.counts)
                logp = (s1[u1, u] + s2[u2, u] - norm[u1, u2]) / log10
                n = chunk.n
                doc = np.repeat(np.arange(n), words.counts)
                score = np.bincount(np.repeat(np.arange(n), words.counts + 1), weights=logp, minlength=n)
                top = place >= 0
                member = top & (units > WORD_UNITS)  # a counted word inside a class
                inside = np.log10(known.count[place[member]]) + seen_share[cls[member]]
                score += np.bincount(doc[member], weights=inside, minlength=n)
                base = np.bincount(doc[top], weights=top_base[place[top]], minlength=n) + known.base(known.ends)
                n_known = np.bincount(doc[top], minlength=n) + (known.ends > 0)
                rows = np.asarray(b.column(0))[chunk.first:chunk.first + n]
                # Rarer words: one row per document and word, to be joined with the count table.
                rare = np.flatnonzero(~top)
                order = rare[np.lexsort((doc[rare], h[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                times = np.diff(np.append(np.flatnonzero(new), len(order)))
                order = order[new]
                k = len(order)
                none = np.zeros(k)
                yield pa.RecordBatch.from_pydict({
                    "row": np.concatenate([rows, rows[doc[order]]]), "h": np.concatenate([rows, h[order]]),
                    "cls": pa.array(np.concatenate([np.full(n, -1), cls[order]]), pa.int16()),
                    "times": np.concatenate([words.counts + 1, times]).astype(np.int64),
                    "known": np.concatenate([n_known, none]).astype(np.int64),
                    "base": np.concatenate([base, none]), "score": np.concatenate([score, none]),
                    "id": pa.concat_arrays([b.column(2).slice(chunk.first, n), pa.nulls(k, b.column(2).type)])})

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), column, id_column)
    kind = docs.schema[id_column].dataType.simpleString()
    parts = numbered.mapInArrow(
        run, f"row long, h long, cls short, times long, known long, base double, score double, id {kind}")
    rarer = counts.where(F.col("n") < least).select(F.col("h").alias("rare_h"), F.col("n").alias("c"))
    joined = parts.join(rarer, (F.col("h") == F.col("rare_h")) & (F.col("cls") >= 0), "left")
    own, c = F.col("cls") >= 0, F.coalesce("c", F.lit(0))
    at = F.greatest(F.col("cls"), F.lit(0)).cast("int")
    pick = lambda values: F.array(*(F.lit(float(v)) for v in values))[at]
    per_base = F.log10((c + 0.1) / float(vocab.tokens + 0.1 * (vocab.types + 1)))
    per_score = F.when(c > 0, F.log10(F.greatest(c, F.lit(1))) + pick(seen_share)).otherwise(pick(unseen_share))
    sums = joined.groupBy("row").agg(
        F.sum(F.when(own, 0).otherwise(F.col("times"))).alias("n_tokens"),
        F.sum(F.when(own, F.when(c > 0, F.col("times")).otherwise(0)).otherwise(F.col("known"))).alias("n_known"),
        F.sum(F.when(own, F.col("times") * per_base).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(own, F.col("times") * per_score).otherwise(F.col("score"))).alias("score"),
        F.max("id").alias(id_column))
    return sums.select(id_column, "n_tokens", "n_known", "base_score", "score")


def lm_scores(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 10) == 0
    learn = docs.where(~held_out).select("text")
    counts = materialize(count_words(learn), "word-counts")
    vocab, least = vocabulary(counts, learn.count())
    found = score_texts(docs, counts, vocab, least, train(learn, vocab))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                        F.lit(vocab.tokens).cast("long").alias("train_tokens"), "base_score", "score")
