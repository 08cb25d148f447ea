"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set holds its distinct shingles of five lower-cased words.  Two
documents link when 100 * |intersection| >= 75 * |union|.  A partner of a set of
n shingles occurs in at least T = ceil(0.75 n) of the n inverted lists.

1. Documents with fewer than T shingles that any other document has are left
   out (``grouping.live_items``); equal sets become one item.
2. Over the rest, shingles are ordered by the length of their lists.  A partner
   occurs in one of the n - T + 1 shortest lists, so chains of items that share
   such a list bound the groups in which links can exist.
3. Inside a group each set is searched by DivideSkip: its short lists are merged,
   what occurs in at least T - L of them is looked up in the L long lists by
   binary search, and the exact overlap decides.

Groups go to tasks in blocks of bounded size, every pair of blocks meeting once,
and a task returns a spanning forest of its links and each item's number of
links, never the pairs.

Defined cases: a text of one to four words is one shingle; a null text or a text
without words has the empty set and links with nothing; equal texts link (also
under one id); null ids are left out of the least id of a component; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import grouping
from ledgerloom.llm.common import fresh, materialize, text_bytes
from ledgerloom.llm.textcodes import Chunk, Words, chunks, distinct_pairs, mix, windows

WORDS = 5
#: Similarity in percent.
SIMILARITY = 75
#: Text bytes for each bucket of the key space, and items of a block of a group (task sizes, not limits).
BUCKET_BYTES = 8 << 20
BLOCK_ITEMS = 1024
#: Weight of the merge against a probe in the choice of the number of long lists.
MU = 0.0085


class Sets:
    """Shingle sets of a chunk: ``keys`` by document, ascending, between ``offsets``; a digest of each set."""

    def __init__(self, chunk: Chunk):
        words = Words(chunk)
        shingle, doc, _ = windows(words.hashes(), words.offsets, WORDS)
        order = np.argsort(doc, kind="stable")
        keys, owner = distinct_pairs(shingle[order], doc[order])
        order = np.argsort(owner, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.sizes = np.bincount(self.owner, minlength=chunk.n)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        digest = np.zeros(chunk.n, np.uint64)
        filled = self.sizes > 0
        if filled.any():
            digest[filled] = np.add.reduceat(mix(self.keys + np.uint64(0xA5A5)), self.offsets[:-1][filled])
        self.digest = mix(digest + self.sizes.astype(np.uint64)).view(np.int64)


def least_overlap(n: np.ndarray) -> np.ndarray:
    return -(-SIMILARITY * n // 100)


def pack(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = grouping.Packer(buckets)
        for b in batches:
            for chunk in chunks(b.column(0)):
                s = Sets(chunk)
                _, first, item = np.unique(s.digest, return_index=True, return_inverse=True)
                leads = np.zeros(chunk.n, bool)  # one document of each set of the block
                leads[first] = True
                mine = leads[s.owner]
                yield from packer.add(s.keys[mine], item[s.owner[mine]], s.digest[first], least_overlap(s.sizes[first]))
        yield from packer.rest()

    return docs.mapInArrow(run, grouping.PACKED)


def sets(docs: DataFrame, sieve: grouping.Sieve, id_column: str, column: str) -> DataFrame:
    """(id, n_shingles, item, keys): the packed set only where the item passes the sieve."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = grouping.Sieve(shared.value)
        for b in batches:
            for chunk in chunks(b.column(1)):
                s = Sets(chunk)
                filled = s.sizes > 0
                keep = filled & passes.holds(s.digest)
                keys = [s.keys[s.offsets[i]:s.offsets[i + 1]].tobytes() if keep[i] else None for i in range(chunk.n)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(chunk.first, chunk.n), pa.array(s.sizes, pa.int64()),
                     pa.array(s.digest, pa.int64(), mask=~filled), pa.array(keys, pa.binary())],
                    names=[id_column, "n_shingles", "item", "keys"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, column).mapInArrow(run, f"`{id_column}` {kind}, n_shingles long, item long, keys binary")


def rare_keys(items: DataFrame) -> DataFrame:
    """(key, item): of each item the n - T + 1 keys with the shortest lists, where another item has them too."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [np.frombuffer(k, np.int64) for k in b.column(2).to_pylist()]
            for k in range(0, len(keys), 256):
                part = keys[k:k + 256]
                n = np.array([len(x) for x in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part)), pa.array(np.repeat(np.asarray(b.column(0))[k:k + 256], n)),
                     pa.array(np.repeat(np.asarray(b.column(1))[k:k + 256], n).astype(np.int32))], names=["key", "item", "n"])

    keyed = items.select("item", "n", "keys").mapInArrow(spread, "key long, item long, n int")
    shared = keyed.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    lists = keyed.join(shared, "key").groupBy("item").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("length", "key"))).alias("lists"))
    least = F.ceil(F.col("n") * SIMILARITY / 100).cast("int")
    spare = F.size("lists") - least + 1  # keys that no other item has are the shortest lists of all
    return lists.where(spare > 0).select("item", F.explode(F.slice("lists", 1, spare)).alias("l")).select("l.key", "item")


def search(keys: list[np.ndarray], side: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """DivideSkip over one unit: each set (by place) with the later sets that link to it.

    With two sides only sets of different sides are compared.
    """
    m = len(keys)
    sizes = np.array([len(k) for k in keys])
    _, code = np.unique(np.concatenate(keys), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(code, kind="stable")
    posting, listed = owner[order], code[order]  # inverted lists end to end, ascending inside a list
    begin = np.searchsorted(listed, np.arange(listed[-1] + 2))
    length = np.diff(begin)
    place = listed.astype(np.int64) * m + posting
    first = np.concatenate([[0], np.cumsum(sizes)])
    two = side.any() and not side.all()
    for q in range(m):
        own = code[first[q]:first[q + 1]]
        own = own[length[own] > 1]
        n, t = sizes[q], int(least_overlap(sizes[q]))
        if len(own) < t:
            continue
        own = own[np.argsort(length[own], kind="stable")]
        n_long = min(t - 1, int(t / (MU * np.log2(max(length[own[-1]], 2)) + 1)))
        short, long_ = own[:len(own) - n_long], own[len(own) - n_long:]
        size = length[short]
        at = np.repeat(begin[short], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        merged = np.sort(posting[at], kind="stable")  # a merge of sorted runs
        found, overlap = np.unique(merged, return_counts=True)
        fits = (found > q) & (overlap >= t - n_long)
        fits &= (100 * np.minimum(sizes[found], n) >= SIMILARITY * np.maximum(sizes[found], n))
        if two:
            fits &= side[found] != side[q]
        found, overlap = found[fits], overlap[fits]
        for k in range(0, len(long_) if len(found) else 0, 64):  # probe the long lists, a few at a time
            probe = long_[k:k + 64, None].astype(np.int64) * m + found[None, :]
            spot = np.minimum(np.searchsorted(place, probe), len(place) - 1)
            overlap = overlap + (place[spot] == probe).sum(0)
            still = overlap + max(len(long_) - k - 64, 0) >= t
            if not still.all():
                found, overlap = found[still], overlap[still]
                if not len(found):
                    break
        linked = 100 * overlap >= SIMILARITY * (n + sizes[found] - overlap)
        if linked.any():
            yield q, found[linked]


def _links(unit: pa.Table) -> pa.Table:
    """Of one unit: edges of a spanning forest (b) and numbers of links (n)."""
    item, side = np.asarray(unit["item"]), np.asarray(unit["side"])
    order = np.argsort(item)
    item, side = item[order], side[order]
    raw = unit["keys"].to_pylist()
    keys = [np.frombuffer(raw[i], np.uint64) for i in order]
    forest, count, edges = grouping.Forest(len(item)), np.zeros(len(item), np.int64), []
    for q, found in search(keys, side):
        count[q] += len(found)
        count[found] += 1
        edges += [(q, int(f)) for f in found if forest.join(q, int(f))]
    a = [item[x] for x, _ in edges]
    b = [item[y] for _, y in edges]
    linked = np.flatnonzero(count)
    return pa.table([pa.array([*a, *item[linked]], pa.int64()), pa.array([*b, *[None] * len(linked)], pa.int64()),
                     pa.array([*[0] * len(a), *count[linked]], pa.int64())], names=["a", "b", "n"])


def groups(docs: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, n_shingles, group, n_links) of every row; ``group``: null for the empty set."""
    texts = docs.select(column)
    packed = pack(texts, max(1, -(-text_bytes(texts, column) // BUCKET_BYTES)))
    live = materialize(grouping.live_items(packed), "live")
    rows = materialize(sets(docs, grouping.sieve_of(live), id_column, column), "sets")
    items = rows.where("keys is not null").select("item", F.col("n_shingles").alias("n"), "keys").dropDuplicates(["item"])
    clustered = materialize(grouping.clusters(materialize(rare_keys(items), "rare-keys")), "clusters")
    units = grouping.by_cluster(items.select("item", "keys"), clustered, BLOCK_ITEMS)
    links = materialize(units.groupBy("cluster", "x", "y").applyInArrow(_links, "a long, b long, n long"), "links")
    label = grouping.components(links.where("b is not null"))
    count = links.where("b is null").groupBy(F.col("a").alias("linked")).agg(F.sum("n").alias("n_links"))
    return (rows.drop("keys").join(label, F.col("item") == F.col("node"), "left")
            .join(count, F.col("item") == F.col("linked"), "left")
            .select(id_column, "n_shingles", F.coalesce("component", "item").alias("group"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def join(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, n_links) of every row; ``component_id``: the least id that links reach.

    ``n_links`` counts other sets (not their copies) that the row's set links to.
    """
    known = groups(docs, id_column, column)
    least = known.where("group is not null").groupBy(F.col("group").alias("of")).agg(F.min(id_column).alias("least"))
    own = F.when(F.col("group").isNull(), F.col(id_column)).otherwise(F.col("least"))
    return known.join(least, F.col("group") == F.col("of"), "left").select(
        id_column, "n_shingles", own.alias("component_id"), "n_links")


def keep_one(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component left: that of the least id (null ids last).

    Rows equal in id and text are one document, of which one row stays; documents
    with the empty set have no component and stay.
    """
    digest = F.xxhash64(id_column, column)
    name = fresh(docs, "digest")
    known = materialize(groups(docs.select(id_column, digest.alias("digest"), F.col(column).alias("body"))
                               .select(F.struct(F.col(id_column).isNull().alias("last"), F.col(id_column).alias("id"), "digest")
                                       .alias("row"), "body"), "row", "body"), "groups")
    first = known.where("group is not null").groupBy("group").agg(F.min("row").alias("row")).select("row.digest")
    keep = first.unionAll(known.where("group is null").select("row.digest")).distinct().select(F.col("digest").alias(name))
    return docs.join(keep, digest == F.col(name)).dropDuplicates([name]).select(*docs.columns)
