"""Language identification by prediction by partial matching over bytes.

For each language a context tree of order ``ORDER`` counts which byte follows
which bytes.  A byte's probability is read at the longest context that the
language has seen; a byte new to a context escapes to the next shorter one
(escape estimate C: distinct / (total + distinct), with the bytes of the longer
context excluded), down to the uniform distribution over all 256 bytes.  The
counts are frozen after training, so code lengths of a text are sums of table
entries and are exact.  The language with the shortest code wins.

Learning takes the texts of at most about ``TRAIN_DOCS`` labelled documents per
language, drawn at random with a fixed seed; scoring reads whole texts of all rows.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is everything when no labelled text exists; ties go to the first language by
name; repeated rows and null ids give a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import remainder
from ledgerloom.llm.textcodes import Chunk, chunks

#: Bytes of context.
ORDER = 3
#: Labelled documents per language that the trees are learnt from (expected number; whole texts).
TRAIN_DOCS = 1000
_ROWS = 2048


def _contexts(chunk: Chunk, symbols: np.ndarray) -> list[np.ndarray]:
    """The symbol at 1, 2, ... ORDER places before each byte; symbol 0 before a text begins."""
    size = np.diff(chunk.offsets)
    depth = np.arange(len(symbols)) - np.repeat(chunk.offsets[:-1], size)
    out = []
    for k in range(1, ORDER + 1):
        c = np.zeros_like(symbols)
        c[k:] = symbols[:-k]
        c[depth < k] = 0
        out.append(c)
    return out


@dataclass
class Trees:
    """Frozen trees of all languages as tables of code lengths in bits.

    ``symbol``: byte to symbol (0: before the text; 1: any byte never seen).
    ``row``: context of ORDER symbols to the row of its longest seen suffix.
    ``bits``: row, symbol, language.
    """

    languages: list[str]
    symbol: np.ndarray
    row: np.ndarray
    bits: np.ndarray

    def code_lengths(self, chunk: Chunk) -> np.ndarray:
        """Bits of each whole text (row) under each language (column)."""
        out = np.zeros((chunk.n, len(self.languages)))
        if not len(chunk.data):
            return out
        size = self.bits.shape[1]
        s = self.symbol[chunk.data].astype(np.int32)
        context = np.zeros(len(s), np.int64)
        for c in reversed(_contexts(chunk, s)):
            context = context * size + c
        cost = self.bits[self.row[context], s]
        filled = np.flatnonzero(np.diff(chunk.offsets) > 0)
        out[filled] = np.add.reduceat(cost, chunk.offsets[:-1][filled], axis=0, dtype=np.float64)
        return out

    def predict(self, chunk: Chunk, readable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language (-1: und) and its posterior under equal priors."""
        if not self.languages:
            return np.full(chunk.n, -1), np.zeros(chunk.n)
        bits = self.code_lengths(chunk)
        best = bits.argmin(axis=1)
        less = bits.min(axis=1, keepdims=True) - bits
        score = 1.0 / np.exp2(np.maximum(less, -1000.0)).sum(axis=1)
        return np.where(readable, best, -1), np.where(readable, score, 0.0)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): ORDER bytes of context and the byte that follows, as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(0).to_pylist()
            for chunk in chunks(b.column(1)):
                if not len(chunk.data):
                    continue
                s = chunk.data.astype(np.int64) + 2  # 0: before the text
                gram = np.zeros(len(s), np.int64)
                for c in reversed(_contexts(chunk, s)):
                    gram = gram * 512 + c
                gram = gram * 512 + s
                mine = langs[chunk.first:chunk.first + chunk.n]
                names = sorted(set(mine))
                code = np.array([names.index(x) for x in mine])
                for i, name in enumerate(names):
                    found, n = np.unique(gram[np.repeat(code, np.diff(chunk.offsets)) == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found),
                                                      pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    return docs.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build_trees(lang_names: list[str], gram: np.ndarray, n: np.ndarray) -> Trees:
    """Trees from parallel arrays (language, gram, count); everything that scoring needs, as tables."""
    languages = sorted(set(lang_names))
    if not languages:
        return Trees([], np.ones(256, np.int16), np.zeros(8, np.int32), np.zeros((1, 2, 0), np.float32))
    place = {name: i for i, name in enumerate(languages)}
    lang = np.array([place[x] for x in lang_names], np.int64)
    digits = np.stack([((gram >> (9 * k)) & 511).astype(np.int16) for k in range(ORDER, -1, -1)])  # oldest byte first
    seen = np.unique(digits[-1])
    symbol = np.ones(256, np.int16)
    symbol[seen - 2] = np.arange(2, len(seen) + 2)
    size = len(seen) + 2
    code = np.zeros(514, np.int64)
    code[seen] = np.arange(2, size)
    digits = code[digits]  # in symbols; 0 stays "before the text"
    unseen = 256 - len(seen)

    # Order -1: one row of equal probabilities.  p: row, symbol, language.
    levels = []
    lower = np.full((1, size, len(languages)), 1 / 256, np.float32)
    lower[:, 0] = 0.0
    lower_row = np.zeros(1, np.int64)  # row of the only context of order -1
    for order in range(ORDER + 1):
        context = np.zeros(digits.shape[1], np.int64)
        for d in digits[ORDER - order:ORDER]:
            context = context * size + d
        keys = np.unique(context)
        by = np.argsort(context, kind="stable")
        edge = np.searchsorted(context[by], keys)
        p = np.empty((len(keys), size, len(languages)), np.float32)
        for k in range(0, len(keys), _ROWS):  # in blocks of rows, to hold little at a time
            last = edge[k + _ROWS] if k + _ROWS < len(keys) else len(by)
            own = by[edge[k]:last]
            count = np.zeros(p[k:k + _ROWS].shape)
            np.add.at(count, (np.searchsorted(keys, context[own]) - k, digits[-1][own], lang[own]), n[own])
            before = lower[lower_row[keys[k:k + _ROWS] % size ** max(order - 1, 0)]] if order else lower
            before = np.broadcast_to(before, count.shape).astype(np.float64)
            total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
            left = 1.0 - np.where(count > 0, before, 0.0).sum(1, keepdims=True)
            escape = np.where(left > 1e-9, kinds / np.maximum(total + kinds, 1) / np.maximum(left, 1e-9), 0.0)
            here = np.where(count > 0, count / np.maximum(total + kinds, 1), escape * before)
            p[k:k + _ROWS] = np.where(total > 0, here, before)
        p[:, 0] = 0.0
        row_of = np.full(size ** order, -1, np.int64)
        row_of[keys] = np.arange(len(keys))
        levels.append((row_of, p))
        lower, lower_row = p, row_of  # the suffix of a counted context is counted itself
    # All contexts of full order, each pointing at the row of its longest seen suffix.
    starts = np.cumsum([0, *(len(p) for _, p in levels)])
    every = np.arange(size ** ORDER)
    row = np.full(size ** ORDER, -1, np.int64)
    for order in range(ORDER, -1, -1):
        found = levels[order][0][every % size ** order]
        row = np.where((row < 0) & (found >= 0), found + starts[order], row)
    bits = np.empty((starts[-1], size, len(languages)), np.float32)
    for at, (_, p) in zip(starts, levels):
        np.log2(np.maximum(p, 1e-30), out=bits[at:at + len(p)])
    np.negative(bits, out=bits)
    return Trees(languages, symbol, row.astype(np.int32), bits)


def train(docs: DataFrame, learn: Column, lang_column: str = "lang", column: str = "text",
          train_docs: int = TRAIN_DOCS, id_column: str = "doc_id") -> Trees:
    """Trees from the rows where ``learn`` holds and the language and text are known.

    Of a language with more than ``train_docs`` of them so many are drawn (expected number) by a
    hash of id and text: how the rows lie in files doesn't matter.
    """
    labelled = docs.where(learn & F.col(lang_column).isNotNull() & F.col(column).isNotNull()).select(
        F.col(lang_column).alias("lang"), F.col(column).alias("text"), F.xxhash64(id_column, column).alias("mark"))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    large = [(r[0], train_docs / r[1]) for r in sizes.where(F.col("n") > train_docs).collect()]
    share = F.lit(1.0)
    for name, part in large:
        share = F.when(F.col("lang") == F.lit(name), F.lit(part)).otherwise(share)
    rows = count_grams(labelled.where(F.pmod("mark", F.lit(1 << 30)) < share * float(1 << 30)).select("lang", "text")).toArrow()
    if not rows.num_rows:
        none = np.zeros(0, np.int64)
        return build_trees([], none, none)
    return build_trees(rows["lang"].to_pylist(), *(np.asarray(rows[c].combine_chunks()) for c in ("gram", "n")))


def readable(column: str = "text") -> Column:
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, trees: Trees, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.asarray(b.column(2))
            for chunk in chunks(b.column(1)):
                best, score = model.value.predict(chunk, ok[chunk.first:chunk.first + chunk.n])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(chunk.first, chunk.n),
                     pa.array([model.value.languages[k] if k >= 0 else "und" for k in best], pa.string()),
                     pa.array(score)], names=[id_column, "lang_pred", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, column, readable(column)).mapInArrow(
        run, f"`{id_column}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, trees: Trees, column: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text has a language: not ``und``, and with a posterior of ``least`` or more."""
    model = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.asarray(b.column(b.num_columns - 1))
            for chunk in chunks(b.column(at)):
                best, score = model.value.predict(chunk, ok[chunk.first:chunk.first + chunk.n])
                part = b.slice(chunk.first, chunk.n).filter(pa.array((best >= 0) & (score >= least)))
                yield pa.RecordBatch.from_arrays(part.columns[:-1], names=part.schema.names[:-1])

    return docs.select("*", readable(column)).mapInArrow(run, docs.schema)


def language_id(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 3) == 1
    trees = train(docs, ~held_out)
    return predict(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
