"""Near duplicates by SimHash with a generalised pigeonhole search.

A text's fingerprint has 64 bits; bit k is set if more than half of the text's
3-word shingles (lower-cased A-Z, repeats included, words joined by one space)
have bit k set in their XXH64 (UTF-8, seed 42).  A text of one or two words is
one shingle, a text without words has fingerprint zero.  Two fingerprints link if
they differ in at most ``MOST_BITS`` bits; a component is what links connect.

Method.  Equal fingerprints are one item.  The 64 bits are cut into ``m`` parts;
bits that are correlated over all items go to the same part, so that other parts
stay selective.  If thresholds t_1 .. t_m sum to MOST_BITS - m + 1, two linked
fingerprints differ in at most t_k bits of some part k (t_k = -1: the part isn't
searched).  Each item gets its own thresholds: for each part and threshold the
number of candidates is estimated from counts over all items (sub-parts of at most
``SUB_BITS`` bits, taken as independent), and a dynamic programme over the parts
finds the cheapest vector.  The item then probes every value within t_k bits of its
own in part k, and candidates are verified on all 64 bits.  ``m`` is the count
with the least estimated cost on ``SAMPLE`` items; it changes the work, not the result.

Skew.  A part value that more than ``BLOCK`` items have isn't joined: its items are
cut into blocks by a hash, each pair of blocks is a task, and a task returns a
spanning forest of its links.  Fingerprints of many documents are joined back by a
broadcast of at most ``skew.SHARE`` rows.

Rows: one for each row of ``docs``, with the id, ``fingerprint`` (16 hex digits) and
``component_id`` (least id of the component; null ids don't count, and a component
of null ids only has null).  Null texts count as empty: all texts without a word are
linked.  Repeated rows stay.  An empty table gives an empty result.  Other columns of
``docs`` aren't used.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import materialize, tree_sum
from ledgerloom.llm.grouping import components
from ledgerloom.llm.skew import join_by_weight
from ledgerloom.llm.textcodes import IS_WORD, chunks, release
from ledgerloom.llm.wordspans import Spans

BITS, MOST_BITS, SHINGLE, SEED = 64, 3, 3, 42
#: Numbers of parts to choose from.
PARTS = (2, 3, 4)
#: Bits of a sub-part whose values are counted.
SUB_BITS = 11
#: Items on which the number of parts is chosen (never what is linked).
SAMPLE = 1024
#: Items of a part value that are joined directly; more are compared block by block.
BLOCK = 512
#: Cost of sending one row, in verified candidates.
ROW_COST = 8.0
_STEP = 1 << 16


def _shingle_spans(spans: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every shingle."""
    count = np.diff(spans.offsets)
    n = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), n)
    first = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(spans.offsets[:-1], n)
    last = first + np.minimum(count, SHINGLE)[doc] - 1
    return spans.start[first], spans.end[last], doc


def simhashes(column: pa.Array) -> np.ndarray:
    """The fingerprint (uint64) of each text of an Arrow column."""
    out = []
    for chunk in chunks(column):
        spans = Spans(chunk, IS_WORD)
        start, end, doc = _shingle_spans(spans)
        raw = spans.buffer.tobytes()
        ones = np.zeros((chunk.n, BITS), np.int64)
        for at in range(0, len(start), _STEP):  # a long text in pieces: memory is bounded by the text, not its bits
            stop = min(at + _STEP, len(start))
            h = np.fromiter((xxhash.xxh64_intdigest(raw[s:e], SEED) for s, e in
                             zip(start[at:stop].tolist(), end[at:stop].tolist())), np.uint64, stop - at)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            who = doc[at:stop]
            begin = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            ones[who[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        total = np.bincount(doc, minlength=chunk.n)
        major = 2 * ones > total[:, None]
        out.append(np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp long) of every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(simhashes(b.column(1)).view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- parts of the bits

def _as_bits(x: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _vectors(items: DataFrame, count) -> np.ndarray | None:
    """The sum over all items of ``count`` (of a uint64 array, a float vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            v = count(np.asarray(b.column(0)).view(np.uint64))
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).tobytes()], pa.binary())], names=["v"])

    return tree_sum(items.select("fp").mapInArrow(run, "v binary"), "v")


def _together(x: np.ndarray) -> np.ndarray:
    """How often bits are set, alone (diagonal) and in pairs."""
    b = _as_bits(x).astype(np.float32)
    return (b.T @ b).astype(np.float64).ravel()


def correlated_parts(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """The bits in ``m`` parts of nearly equal size: each grown from its most correlated pair."""
    p = np.diag(together) / n
    cov = together / n - np.outer(p, p)
    scale = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(scale, scale))
    np.fill_diagonal(corr, -1.0)
    free, parts = list(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        inner = corr[np.ix_(free, free)]
        a, b = np.unravel_index(int(np.argmax(inner)), inner.shape)
        part = [free[a], free[b]]
        while len(part) < width:
            rest = [f for f in free if f not in part]
            part.append(max(rest, key=lambda f: (corr[f, part].mean(), -f)))
        parts.append(part)
        free = [f for f in free if f not in part]
    return parts


def _value(x: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of x at the given places as one number."""
    out = np.zeros(len(x), np.uint64)
    for j, b in enumerate(bits):
        out |= ((x >> np.uint64(b)) & np.uint64(1)) << np.uint64(j)
    return out


def _subparts(part: list[int]) -> list[list[int]]:
    pieces = -(-len(part) // SUB_BITS)
    edge = [len(part) * k // pieces for k in range(pieces + 1)]
    return [part[edge[k]:edge[k + 1]] for k in range(pieces)]


def masks(width: int, most: int) -> np.ndarray:
    """All numbers of ``width`` bits with at most ``most`` set; none below zero."""
    if most < 0:
        return np.zeros(0, np.uint64)
    return np.array([sum(1 << b for b in c) for d in range(most + 1) for c in itertools.combinations(range(width), d)], np.uint64)


class Cut:
    """The bits in parts, with what is needed to estimate candidates."""

    def __init__(self, parts: list[list[int]]):
        self.parts = parts
        self.subs = [_subparts(p) for p in parts]
        self.sizes = [1 << len(s) for subs in self.subs for s in subs]
        self.n = 0.0

    def counts(self, x: np.ndarray) -> np.ndarray:
        """How many of x have each value of each sub-part, one after the other."""
        return np.concatenate([np.bincount(_value(x, s).astype(np.int64), minlength=1 << len(s))
                               for subs in self.subs for s in subs])

    def learn(self, counts: np.ndarray, n: int) -> None:
        """From the counts of all items: the share of items at distance 0 .. MOST_BITS of each value."""
        self.n, self.near, at = float(n), [], 0
        for size in self.sizes:
            c, at = counts[at:at + size] / n, at + size
            width, value = size.bit_length() - 1, np.arange(size)
            near = np.zeros((size, MOST_BITS + 1))
            for mask in masks(width, min(MOST_BITS, width)).astype(np.int64):
                near[:, int(mask).bit_count()] += c[value ^ mask]
            self.near.append(near)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Estimated items within 0 .. MOST_BITS bits of each x in each part: (part, x, bits)."""
        out, k = [], 0
        for subs in self.subs:
            share = None
            for s in subs:
                near = self.near[k][_value(x, s).astype(np.int64)]
                k += 1
                if share is None:
                    share = near
                else:
                    share = np.stack([sum(share[:, i] * near[:, d - i] for i in range(d + 1))
                                      for d in range(MOST_BITS + 1)], axis=1)
            out.append(np.cumsum(share, axis=1) * self.n)
        return np.array(out)

    def thresholds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x the cheapest thresholds (x, part), and their cost: a dynamic programme over the parts."""
        m, found = len(self.parts), self.candidates(x)
        goal = MOST_BITS - m + 1
        best, taken = {0: np.zeros(len(x))}, []
        for k, part in enumerate(self.parts):
            rest = m - 1 - k
            step: dict[int, np.ndarray] = {}
            choice: dict[int, np.ndarray] = {}
            for s, cost in best.items():
                for t in range(-1, MOST_BITS + 1):
                    if not -rest <= goal - s - t <= MOST_BITS * rest:
                        continue
                    c = cost if t < 0 else cost + found[k][:, t] + ROW_COST * len(masks(len(part), t))
                    if s + t not in step:
                        step[s + t], choice[s + t] = c.copy(), np.full(len(x), t)
                    else:
                        better = c < step[s + t]
                        step[s + t][better], choice[s + t][better] = c[better], t
            best = step
            taken.append(choice)
        out = np.empty((len(x), m), np.int64)
        left = np.full(len(x), goal)
        for k in range(m - 1, -1, -1):
            for s, choice in taken[k].items():
                here = left == s
                out[here, k] = choice[here]
            left = left - out[:, k]
        return out, best[goal] + ROW_COST * m

    def probes(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(key, x) for every value that x looks for, a part and threshold at a time."""
        wanted, _ = self.thresholds(x)
        for k, part in enumerate(self.parts):
            value = _value(x, part)
            for t in range(MOST_BITS + 1):
                who = np.flatnonzero(wanted[:, k] == t)
                if len(who):
                    near = masks(len(part), t)
                    for some in np.array_split(who, -(-len(who) * len(near) // _STEP)):
                        yield _key(k, value[some][:, None] ^ near[None, :]).ravel(), np.repeat(x[some], len(near))

    def entries(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k, part in enumerate(self.parts):
            yield _key(k, _value(x, part)), x


def _key(part: int, value: np.ndarray) -> np.ndarray:
    return value | np.uint64(part << 40)


def choose_cut(items: DataFrame) -> Cut | None:
    """The parts for these items (fp long, distinct); None for an empty table."""
    together = _vectors(items, _together)
    if together is None:
        return None
    n = items.count()
    cuts = [Cut(correlated_parts(together.reshape(BITS, BITS), n, m)) for m in PARTS]
    counts = _vectors(items, lambda x: np.concatenate([c.counts(x) for c in cuts]))
    sample = np.array([r[0] for r in items.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    costs, at = [], 0
    for cut in cuts:
        size = sum(cut.sizes)
        cut.learn(counts[at:at + size], n)
        at += size
        costs.append(cut.thresholds(sample)[1].mean())
    return cuts[int(np.argmin(costs))]


# ---------------------------------------------------------------- links

def _rows(items: DataFrame, cut: Cut, what: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(0)).view(np.uint64)
            for at in range(0, len(x), 2048):
                for key, fp in getattr(cut, what)(x[at:at + 2048]):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["key", name])

    return items.select("fp").mapInArrow(run, f"key long, {name} long")


def _forest_of(rows: pa.Table) -> pa.Table:
    """Spanning links of one unit: of its two blocks, or of one block with itself."""
    item, side = np.asarray(rows["item"]).view(np.uint64), np.asarray(rows["side"])
    item, first = item[np.argsort(side, kind="stable")], int((side == 0).sum())
    group, links = np.arange(len(item)), []
    for i in range(first):
        begin = first if first < len(item) else i + 1
        while True:  # joins a group at a time: at most one round for each item in all
            near = np.flatnonzero((np.bitwise_count(item[i] ^ item[begin:]) <= MOST_BITS) & (group[begin:] != group[i]))
            if not len(near):
                break
            j = begin + int(near[0])
            links.append((item[i], item[j]))
            group[group == group[j]] = group[i]
    release()
    a, b = (np.array([x[k] for x in links], np.uint64).view(np.int64) for k in (0, 1))
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _hot_links(members: DataFrame) -> DataFrame:
    """Links among the members (key, item) of hot keys, by pairs of blocks."""
    size = members.groupBy("key").agg(F.ceil(F.count("*") / F.lit(2 * BLOCK)).cast("int").alias("blocks"))
    placed = members.join(size, "key").withColumn("mine", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    unit = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = unit.select("key", "item", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
                       (F.col("mine") > F.col("other")).cast("int").alias("side"))
    return unit.groupBy("key", "x", "y").applyInArrow(_forest_of, "a long, b long")


def links(items: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect what links within MOST_BITS connect; ``items``: (fp long), distinct, a written table."""
    spark = items.sparkSession
    cut = choose_cut(items)
    if cut is None:
        return spark.createDataFrame([], "a long, b long")
    entries = materialize(_rows(items, cut, "entries", "fp"), "simhash-entries")
    hot = materialize(entries.groupBy("key").count().where(F.col("count") > BLOCK).select("key"), "simhash-hot")
    probes = _rows(items, cut, "probes", "q")
    if hot.isEmpty():
        cold, dense = entries, None
    else:
        probes = materialize(probes, "simhash-probes")
        cold = entries.join(hot, "key", "left_anti")
        members = (entries.withColumnRenamed("fp", "item").unionByName(probes.withColumnRenamed("q", "item"))
                   .join(hot, "key", "left_semi").distinct())
        dense = _hot_links(members)
    near = (cold["key"] == probes["key"]) & (probes["q"] < cold["fp"]) & (F.bit_count(cold["fp"].bitwiseXOR(probes["q"])) <= MOST_BITS)
    found = probes.join(cold, near).select(F.col("q").alias("a"), F.col("fp").alias("b"))
    return found if dense is None else found.unionByName(dense)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` and ``component_id``."""
    held = materialize(fingerprints(docs, id_column, text_column), "simhash")
    items = materialize(held.groupBy("fp").agg(F.count("*").alias("weight"), F.min("id").alias("least")), "simhash-items")
    found = components(links(items))
    total = int(items.agg(F.sum("weight")).first()[0] or 0)
    placed = materialize(items.join(found, items["fp"] == found["node"], "left")
                         .select("fp", "weight", "least", F.coalesce("component", "fp").alias("component")), "simhash-placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("weight").alias("rows"))
    # Of a component's fingerprints, at most its number of rows.
    named = materialize(join_by_weight(placed, least, ["component"], "rows", total).select("fp", "weight", "component_id"), "simhash-named")
    out = join_by_weight(held, named, ["fp"], "weight", total)
    return out.select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
