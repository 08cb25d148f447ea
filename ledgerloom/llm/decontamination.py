"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Items and documents are sequences of lower-cased words.  A document holds an
item when some passage of it is within ``EDITS`` (share of the item's words) of
the item, in insertions, deletions and replacements of words.

The windows searched have the size of an item and start at every word.  The CGK
embedding walks over a window: step j copies the current word and goes on to the
next one if a random bit of (j, word) says so, so that after an edit the walks of
two near sequences meet again and most of their outputs agree.  A repetition
samples ``SAMPLES`` outputs as its hash key.  Repetitions are added
until the share ``RECALL`` of the items, with random edits at the limit, has a key
in common with the passage that begins where the item does, and two standard
errors of that measurement are added to the share.
Windows that share a key with an item are verified by banded dynamic programming.

Items of fewer than ``LEAST_WORDS`` words match verbatim only, by the hash of the passage.
Items of more than ``LONG_WORDS`` words are cut into parts of at most ``PART_WORDS``: edits within the limit
of the whole leave some part within its own limit.  Around each part that is found, the whole item is
verified by dynamic programming over all starts, if the passage holds enough of its word pairs.

Before the walk, windows that cannot be near any item are passed over: an item of
W words within k edits shares at least W - 1 - 2k of its word pairs with the
passage, and nothing near an item fails this test.

Items go to the tasks in blocks of at most ``BLOCK_ITEMS``; every block is
searched against all documents.

Defined cases: null and empty texts hold nothing; items without a word are not
searched; ``clean`` takes items of fewer than ``EVIDENCE_WORDS`` words as no evidence (``find_items`` reports them); equal
items are found each under its id; repeated rows and null ids are searched like
others; an empty table on either side gives an empty result; other columns are
not read (``clean`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textcodes import Chunk, Words, chunks, fold, mix

EDITS = 0.15
RECALL = 0.98
#: Edited items on which the recall is measured, for each size.
TRIALS = 800
SAMPLES = 4
LEAST_WORDS, LONG_WORDS, PART_WORDS = 8, 128, 64
EVIDENCE_WORDS = 3
BLOCK_ITEMS = 2000
_PAD = np.uint64(0x5851F42D4C957F2D)
_TABLE_BITS = 20
_WINDOWS = 1 << 13  # walked together; bounds the working memory


def keys(rows: np.ndarray, size: int, repetition: int) -> np.ndarray:
    """The sampled CGK outputs of windows (rows of ``size`` word hashes, padded) as one hash each."""
    rng = np.random.default_rng([size, repetition])
    sample = set(rng.integers(0, 2 * size, SAMPLES).tolist())
    salts = rng.integers(0, 2**63, 2 * size // 64 + 1, dtype=np.uint64)
    rows = np.hstack([rows[:, :size], np.full((len(rows), 1), _PAD)])
    row = np.arange(len(rows))
    step = np.zeros(len(rows), np.int64)
    out = np.full(len(rows), size * 1000003 + repetition, np.uint64)
    for j in range(max(sample) + 1):
        if j % 64 == 0:
            coins = mix(rows ^ salts[j // 64])  # one bit for each of the next 64 steps
        if j in sample:
            out = fold([out, rows[row, step]], j)
        step = np.minimum(step + ((coins[row, step] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64), size)
    return out


def nearest_start(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between ``item`` and any passage of ``text``, and the first word of the first such passage."""
    back, place = text[::-1], np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)  # by reversed place: passages may end anywhere
    for i, word in enumerate(item[::-1], 1):
        new = np.empty_like(row)
        new[0] = i
        np.minimum(row[:-1] + (back != word), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - place) + place
    least = int(row.min())
    return least, len(text) - int(np.flatnonzero(row == least)[-1])


def distances(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Least edits between each row of ``a`` and a prefix of the same row of ``b``; limit + 1: more than limit."""
    n, size = a.shape
    band = 2 * limit + 1
    far = limit + 1
    # d[:, t]: distance of the first i words of a and the first i + t - limit words of b.
    shift = np.arange(band) - limit
    d = np.where(shift >= 0, shift, far)[None, :].repeat(n, 0)
    for i in range(1, size + 1):
        j = i + shift
        new = np.full_like(d, far)
        ok = (j >= 1) & (j <= b.shape[1])
        same = np.full((n, band), 1)
        same[:, ok] = b[:, j[ok] - 1] != a[:, i - 1:i]
        new[:, ok] = d[:, ok] + same[:, ok]
        zero = j == 0
        new[:, zero] = i
        new[:, :-1] = np.minimum(new[:, :-1], d[:, 1:] + 1)
        new[:, (j < 0) | (j > b.shape[1])] = far
        for t in range(1, band):
            if ok[t]:
                new[:, t] = np.minimum(new[:, t], new[:, t - 1] + 1)
        d = np.minimum(new, far)
    return d.min(1)


def _pairs(words: Words, hashes: np.ndarray) -> np.ndarray:
    """The table place of the word pair that begins at each word; -1 for the last word of a text."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    place = (fold([hashes, np.append(hashes[1:], _PAD)], 2) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
    place[words.offsets[1:][words.counts > 0] - 1] = -1
    return place


class Items:
    """A block of benchmark items with their keys; made on the driver, sent to every task."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        self.words: list[np.ndarray] = []
        pairs = []
        for chunk in chunks(pa.array(texts, pa.large_string())):
            words = Words(chunk)
            hashes = words.hashes()
            place = _pairs(words, hashes)
            for i in range(chunk.n):
                span = slice(words.offsets[i], words.offsets[i + 1])
                self.words.append(hashes[span])
                pairs.append(place[span][:-1])
        self.real = len(self.words)  # the parts of long items come after the items
        self.part_of: list[tuple[int, int]] = []
        self.pairs_of: dict[int, np.ndarray] = {}
        for i, w in enumerate(self.words[:self.real]):
            if len(w) > LONG_WORDS:
                self.pairs_of[i] = np.unique(pairs[i])
                cuts = -(-len(w) // PART_WORDS)
                edge = [len(w) * k // cuts for k in range(cuts + 1)]
                for low, high in zip(edge, edge[1:]):
                    self.words.append(w[low:high])
                    pairs.append(pairs[i][low:high - 1])
                    self.part_of.append((i, low))
        by_size: dict[int, list[int]] = {}
        brief: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if LEAST_WORDS <= len(w) <= LONG_WORDS:
                by_size.setdefault(len(w), []).append(i)
            elif 0 < len(w) < LEAST_WORDS:
                brief.setdefault(len(w), []).append(i)
        self.part_sizes = {len(w) for w in self.words[self.real:]}
        self.brief = {}
        for size, own in brief.items():
            k = fold([np.array([self.words[i][j] for i in own]) for j in range(size)], size)
            order = np.argsort(k, kind="stable")
            self.brief[size] = (k[order], np.array(own)[order])
        self.sizes = sorted(by_size)
        self.members = {s: np.array(by_size[s]) for s in self.sizes}
        self.repetitions = {s: self._repetitions(s) for s in self.sizes}
        # One table of bits for every 64 sizes: which sizes have an item with this word pair.
        self.pair_sizes = np.zeros((-(-len(self.sizes) // 64), 1 << _TABLE_BITS), np.uint64)
        self.keys = {}
        for c, s in enumerate(self.sizes):
            for i in self.members[s]:
                self.pair_sizes[c // 64, pairs[i]] |= np.uint64(1 << (c % 64))
            rows = np.stack([self.words[i] for i in self.members[s]])
            for r in range(self.repetitions[s]):
                k = keys(rows, s, r)
                order = np.argsort(k, kind="stable")
                self.keys[s, r] = (k[order], self.members[s][order])

    @staticmethod
    def limit(size: int) -> int:
        return int(EDITS * size)

    def _repetitions(self, size: int) -> int:
        """How many keys it takes until the share RECALL of items with edits at the limit has one in common with the plain item."""
        rng = np.random.default_rng(size)
        plain = [self.words[i] for i in rng.choice(self.members[size], TRIALS)]
        edited = np.full((len(plain), size), _PAD)
        for row, w in zip(edited, plain):
            w = list(w)
            for _ in range(self.limit(size)):
                kind, at = rng.integers(3), int(rng.integers(len(w)))
                new = [np.uint64(rng.integers(1, 2**63))] if kind < 2 else []
                w[at:at + (kind != 1)] = new  # replace, insert, delete
            row[:len(w)] = w[:size]
        plain = np.stack(plain)
        found, r = np.zeros(len(plain), bool), 0
        while found.mean() < RECALL + 2 * math.sqrt(RECALL * (1 - RECALL) / TRIALS):  # two standard errors beyond
            left = np.flatnonzero(~found)
            found[left] = keys(plain[left], size, r) == keys(edited[left], size, r)
            r += 1
        return r

    def verbatim(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Document, item, distance 0 and first word of the first place of each short item in a document."""
        for size, (table, members) in self.brief.items():
            doc_of, end = words.doc(), np.repeat(words.offsets[1:], words.counts)
            start = np.flatnonzero(end - np.arange(len(hashes)) >= size)
            if not len(start):
                continue
            k = fold([hashes[start + j] for j in range(size)], size)
            low, many = np.searchsorted(table, k, "left"), np.searchsorted(table, k, "right")
            many -= low
            at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            start, item = np.repeat(start, many), members[at]
            same = np.array([np.array_equal(hashes[s:s + size], self.words[i]) for s, i in zip(start.tolist(), item.tolist())], bool)
            start, item = start[same], item[same]
            _, first = np.unique(np.stack([doc_of[start], item]), axis=1, return_index=True)
            start, item = start[first], item[first]
            yield doc_of[start], item, np.zeros(len(item), np.int64), start - words.offsets[doc_of[start]]

    def whole(self, hits: list, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, distance, first word) of the long items that hold around their parts (document, part, first word)."""
        place = _pairs(words, hashes)
        around: dict[tuple[int, int], list[int]] = {}
        for doc, part, first in hits:
            item, offset = self.part_of[part - self.real]
            around.setdefault((doc, item), []).append(first - offset)
        for (doc, item), starts in around.items():
            size = len(self.words[item])
            limit, slack = self.limit(size), self.limit(size) + self.limit(PART_WORDS)
            begin, stop = words.offsets[doc], words.offsets[doc + 1]
            starts.sort()
            edge = [0, *(k for k in range(1, len(starts)) if starts[k] - starts[k - 1] > 2 * slack + size), len(starts)]
            best = None
            for low, high in zip(edge, edge[1:]):
                first = max(begin, begin + starts[low] - slack)
                last = min(stop, begin + starts[high - 1] + slack + size + limit)
                if np.isin(place[first:last - 1], self.pairs_of[item]).sum() < size - 1 - 2 * limit:
                    continue
                d, at = nearest_start(self.words[item], hashes[first:last])
                if d <= limit and (best is None or d < best[0]):
                    best = (d, int(first + at - begin))
            if best is not None:
                yield doc, item, *best

    def windows(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Size, document, first word and words of the windows that share enough word pairs with items of that size."""
        place = _pairs(words, hashes)
        doc_of, end = words.doc(), np.repeat(words.offsets[1:], words.counts)
        for group, table in enumerate(self.pair_sizes):
            mask = table[place]
            mask[place < 0] = 0
            at = np.flatnonzero(mask)
            mask = mask[at]
            for c, size in enumerate(self.sizes[group * 64:group * 64 + 64]):
                limit = self.limit(size)
                reach, need = size + limit, size - 1 - 2 * limit
                own = at[(mask >> np.uint64(c)) & np.uint64(1) > 0]
                if len(own) < need:
                    continue
                # Starts from which ``need`` pairs lie within reach: ranges that end at each pair.
                last = own[:len(own) - need + 1]
                low = own[need - 1:] - reach + 1
                low = np.maximum(low, np.append(-1, last[:-1]) + 1)
                n = np.maximum(last - np.maximum(low, 0) + 1, 0)
                start = np.repeat(last, n) - (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                start = np.unique(start)
                start = start[end[start] - start >= size - limit]
                for k in range(0, len(start), _WINDOWS):
                    s = start[k:k + _WINDOWS]
                    spot = s[:, None] + np.arange(reach)
                    inside = spot < end[s][:, None]
                    rows = np.where(inside, hashes[np.minimum(spot, len(hashes) - 1)], _PAD)
                    yield size, doc_of[s], s - words.offsets[doc_of[s]], rows

    def match(self, size: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, item and distance of the windows within the limit of an item they share a key with."""
        pairs = []
        for r in range(self.repetitions[size]):
            table, members = self.keys[size, r]
            k = keys(rows, size, r)
            low, high = np.searchsorted(table, k, "left"), np.searchsorted(table, k, "right")
            many = high - low
            at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            pairs.append(np.stack([np.repeat(np.arange(len(rows)), many), members[at]]))
        window, item = np.unique(np.concatenate(pairs, 1), axis=1)
        limit = self.limit(size)
        near = [distances(np.stack([self.words[i] for i in item[k:k + 4096]]), rows[window[k:k + 4096]], limit)
                for k in range(0, len(window), 4096)]
        d = np.concatenate(near) if near else np.zeros(0, np.int64)
        return window[d <= limit], item[d <= limit], d[d <= limit]

    def search(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, item (by place), distance and first word of every item found, the nearest passage each."""
        waiting: dict[int, list] = {}
        held: dict[int, int] = {}
        found, parts = [], []

        def flush(size: int) -> None:
            doc, first, rows = (np.concatenate(x) for x in zip(*waiting.pop(size)))
            window, item, d = self.match(size, rows)
            real = item < self.real
            found.append((doc[window][real], item[real], d[real], first[window][real]))
            parts.extend(zip(doc[window][~real].tolist(), item[~real].tolist(), first[window][~real].tolist()))
            held.pop(size)

        for chunk in chunks(column):
            words = Words(chunk)
            hashes = words.hashes()
            found += [(doc + chunk.first, *rest) for doc, *rest in self.verbatim(words, hashes)]
            for size, doc, first, rows in self.windows(words, hashes):
                waiting.setdefault(size, []).append((doc + chunk.first, first, rows))
                held[size] = held.get(size, 0) + len(rows)
                if held[size] > _WINDOWS:
                    flush(size)
            if self.part_sizes:  # parts are put together while their texts are at hand
                for size in self.part_sizes & set(waiting):
                    flush(size)
                here = [(doc - chunk.first, part, first) for doc, part, first in parts]
                parts.clear()
                rows = list(self.whole(here, words, hashes))
                if rows:
                    doc, item, d, first = (np.array(x, np.int64) for x in zip(*rows))
                    found.append((doc + chunk.first, item, d, first))
        for size in list(waiting):
            flush(size)
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        doc, item, d, first = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((first, d, item, doc))
        doc, item, d, first = (x[order] for x in (doc, item, d, first))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        return doc[new], item[new], d[new], first[new]


def item_blocks(items: DataFrame, id_column: str = "item_id", column: str = "text") -> Iterator[Items]:
    """The benchmark in blocks of a bounded number of items."""
    usable = items.where(F.col(column).isNotNull()).select(id_column, F.lower(column).alias(column))
    n = max(1, math.ceil(usable.count() / (BLOCK_ITEMS // 2)))
    for k in range(n):
        rows = usable.where(F.pmod(F.xxhash64(id_column, column), F.lit(n)) == k).collect()
        rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
        if rows:
            yield Items([r[0] for r in rows], [r[1] for r in rows])


def find_items(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", column: str = "text",
               item_id: str = "item_id", item_column: str = "text") -> DataFrame:
    """(id, item, edits, item_words, first_word): each item that a document holds, where it is nearest."""
    doc_kind = docs.schema[id_column].dataType.simpleString()
    item_kind = items.schema[item_id].dataType
    schema = f"`{id_column}` {doc_kind}, `{item_id}` {item_kind.simpleString()}, edits int, item_words int, first_word long"
    parts = []
    for block in item_blocks(items, item_id, item_column):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for b in batches:
                doc, item, distance, first = own.search(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), pa.array([own.ids[i] for i in item], _arrow(item_kind)),
                     pa.array(distance, pa.int32()), pa.array([len(own.words[i]) for i in item], pa.int32()),
                     pa.array(first, pa.int64())], names=[id_column, item_id, "edits", "item_words", "first_word"])

        parts.append(docs.select(id_column, F.lower(column)).mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def clean(docs: DataFrame, items: DataFrame, column: str = "text", item_id: str = "item_id",
          item_column: str = "text", least_words: int = EVIDENCE_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``least_words`` words or more, with all their columns."""
    items = items.where(F.size(F.filter(F.split(F.col(item_column), r"[\x20\x09-\x0D]+"), lambda w: w != "")) >= least_words)
    for block in item_blocks(items, item_id, item_column):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[shared.value.search(b.column(b.num_columns - 1))[0]] = False
                kept = b.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=kept.schema.names[:-1])

        docs = docs.select("*", F.lower(column)).mapInArrow(run, docs.schema)
    return docs


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    return find_items(docs, items)
