"""Groups of near-equal items: which items share keys, candidate clusters, components.

An item is a distinct text unit (a document's shingle set, a line) known by a
64-bit digest; its keys are what a possible partner must share with it (shingles,
MinHash bands).

``live_items`` finds the items with enough keys that some other item has too.
Key lists are packed: a block of documents sends each bucket of the key space
one binary of 32-bit key remainders, so the exchange moves about five bytes a
key.  A key that several items of one block have is settled there and sent
once, so a key list is never longer than the number of blocks, however many
items share the key.  (Remainders may collide; that can only let an item pass,
never drop one.)

``components`` labels connected components: edges are contracted within tasks, then
alternating large-star and small-star steps go on over an edge table written after
every round, until every component is a star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize
from ledgerloom.llm.skew import join_by_weight
from ledgerloom.llm.textcodes import distinct_pairs, mix, release

PACKED = "bucket int, block long, kind int, a binary, b binary, c binary"
_SEVERAL = np.uint32(0xFFFFFFFF)
_ENTRIES, _HEADER, _COUNTS = 0, 1, 2
#: As the number of keys an item needs: it is live whatever its keys are.
LIVE = -1
#: Keys that a block holds; bounds memory, and with it how many rows a bucket gets.
BLOCK_KEYS = 1 << 20


def _planes(x: np.ndarray) -> bytes:
    """The bytes of equal weight side by side: sorted numbers then compress well."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _unplanes(raw: bytes, kind=np.uint32) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Packer:
    """Packs the keys of blocks of items; one per task.

    Every block has a row in nearly every bucket, so what ``add`` gets is held until it fills a block.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.task = TaskContext.get().partitionId()
        self.blocks = 0
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, keys: np.ndarray, owner: np.ndarray, item: np.ndarray, need: np.ndarray) -> Iterator[pa.RecordBatch]:
        """As ``pack`` (``owner`` ascending, items distinct); an item that is added twice to a block is live."""
        self.held.append((keys, owner, item, need))
        self.size += len(keys)
        if self.size >= BLOCK_KEYS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        """The block of what is still held."""
        if not self.held:
            return
        counts = [len(x[2]) for x in self.held]
        keys, owner, item, need = (np.concatenate(x) for x in zip(*self.held))
        owner = owner + np.repeat(np.cumsum(counts) - counts, [len(x[0]) for x in self.held])
        self.held, self.size = [], 0
        _, first, place, times = np.unique(item, return_index=True, return_inverse=True, return_counts=True)
        leads = np.zeros(len(item), bool)
        leads[first] = True
        need = np.where((times[place] > 1) & (need != 0), LIVE, need)[leads]
        mine = leads[owner]
        yield self.pack(keys[mine], (np.cumsum(leads) - 1)[owner[mine]], item[leads], need)
        release()

    def pack(self, keys: np.ndarray, owner: np.ndarray, item: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
        """Rows of one block: ``keys`` with their ``owner`` (place in ``item``); ``need``: live keys an item must have, or LIVE."""
        block = (self.task << 32) + self.blocks
        self.blocks += 1
        h, o = distinct_pairs(keys, owner)
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(h)))
        alone = size == 1
        local = np.bincount(o[np.repeat(~alone, size)], minlength=len(item))
        h, who = h[first], np.where(alone, o[first], _SEVERAL).astype(np.uint32)
        p = np.uint64(self.buckets)
        high = (h >> np.uint64(32)) * p + (((h & np.uint64(0xFFFFFFFF)) * p) >> np.uint64(32))
        bucket, rest = (high >> np.uint64(32)).astype(np.int64), (high & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        edge = np.searchsorted(bucket, np.arange(self.buckets + 1))
        filled = np.flatnonzero(np.diff(edge))
        out = {"bucket": [*filled.tolist(), int(mix(np.array([block], np.uint64))[0] % p)],
               "kind": [_ENTRIES] * len(filled) + [_HEADER],
               "a": [_planes(rest[edge[k]:edge[k + 1]]) for k in filled] + [item.astype(np.int64).tobytes()],
               "b": [_planes(who[edge[k]:edge[k + 1]]) for k in filled] + [need.astype(np.int64).tobytes()],
               "c": [None] * len(filled) + [local.astype(np.int64).tobytes()]}
        n = len(filled) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(out["bucket"], pa.int32()), pa.array([block] * n, pa.int64()), pa.array(out["kind"], pa.int32()),
             *(pa.array(out[c], pa.binary()) for c in "abc")], names=["bucket", "block", "kind", "a", "b", "c"])


def _count_shared(rows: pa.Table) -> pa.Table:
    """Of one bucket: for each block, how many of each item's keys some other block or item has too."""
    kind = np.asarray(rows["kind"])
    a, b, blocks = rows["a"].to_pylist(), rows["b"].to_pylist(), np.asarray(rows["block"])
    entries = np.flatnonzero(kind == _ENTRIES)
    out = [(int(blocks[i]), _HEADER, a[i], b[i], c) for i, c in zip(np.flatnonzero(kind == _HEADER),
           (rows["c"][int(i)].as_py() for i in np.flatnonzero(kind == _HEADER)))]
    if len(entries):
        keys = [_unplanes(a[i]) for i in entries]
        sizes = [len(k) for k in keys]
        key, who = np.concatenate(keys), np.concatenate([_unplanes(b[i]) for i in entries])
        order = np.argsort(key)
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        run = np.diff(np.append(first, len(key)))
        several = np.add.reduceat((who[order] == _SEVERAL).astype(np.int64), first) > 0
        live = np.empty(len(key), bool)
        live[order] = np.repeat((run > 1) | several, run)
        live &= who != _SEVERAL
        at = 0
        for i, n in zip(entries, sizes):
            mine, count = np.unique(who[at:at + n][live[at:at + n]], return_counts=True)
            at += n
            if len(mine):
                out.append((int(blocks[i]), _COUNTS, _planes(mine), _planes(count.astype(np.uint32)), None))
    cols = list(zip(*out)) if out else [[]] * 5
    release()
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     *(pa.array(cols[k], pa.binary()) for k in (2, 3, 4))], names=["block", "kind", "a", "b", "c"])


def _live_of_block(rows: pa.Table) -> pa.Table:
    found = rows.to_pylist()
    header = next(r for r in found if r["kind"] == _HEADER)
    item, need, total = (np.frombuffer(header[c], np.int64) for c in "abc")
    total = total.copy()
    for r in found:
        if r["kind"] == _COUNTS:
            total[_unplanes(r["a"])] += _unplanes(r["b"]).astype(np.int64)
    return pa.table({"item": pa.array(item[(need == LIVE) | (total >= need) & (need > 0)], pa.int64())})


def live_items(packed: DataFrame) -> DataFrame:
    """The distinct items (long) that have at least ``need`` keys in common with others."""
    counted = packed.groupBy("bucket").applyInArrow(_count_shared, "block long, kind int, a binary, b binary, c binary")
    return counted.groupBy("block").applyInArrow(_live_of_block, "item long").distinct()


class Sieve:
    """A Bloom filter of 64-bit digests; its size is bounded, so beyond the bound it only passes more."""

    LARGEST = 1 << 27

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.size = np.uint64(len(bits) * 8)

    @staticmethod
    def _places(item: np.ndarray, size: np.uint64) -> list[np.ndarray]:
        x = item.view(np.uint64)
        return [mix(x + np.uint64(k)) % size for k in (1, 2, 3)]

    @classmethod
    def build(cls, items: DataFrame, n: int) -> "Sieve":
        size = min(cls.LARGEST, 1 << max(10, int(np.ceil(np.log2(max(n, 1) * 16)))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flags = np.zeros(size, bool)
            for b in batches:
                for place in cls._places(np.asarray(b.column(0)), np.uint64(size)):
                    flags[place] = True
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())],
                                             names=["bits"])

        def either(x: bytes, y: bytes) -> bytes:
            return (np.frombuffer(x, np.uint8) | np.frombuffer(y, np.uint8)).tobytes() if x and y else x or y

        bits = items.coalesce(8).mapInArrow(run, "bits binary").rdd.map(lambda r: bytes(r[0])).treeAggregate(
            b"", either, either)
        return cls(np.frombuffer(bits or bytes(size // 8), np.uint8))

    def holds(self, item: np.ndarray) -> np.ndarray:
        out = np.ones(len(item), bool)
        for place in self._places(item, self.size):
            out &= (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def sieve_of(items: DataFrame) -> Sieve:
    return Sieve.build(items, items.count())


#: Edges that a task contracts together, with a forest of up to twice as many.
FOREST_EDGES = 1 << 20


def least_nodes(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least node of the component of each of the nodes 0..n-1.

    Trees hook onto lower ones until no edge leaves a tree; trees are flat before each round.
    """
    label = np.arange(n)
    while True:
        x, y = label[u], label[v]
        apart = x != y
        if not apart.any():
            return label
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up


def _contracted(edges: DataFrame) -> tuple[DataFrame, bool]:
    """The same components with fewer edges (u, v), u > v, and whether each is a star around its least node.

    Tasks of about 2 * FOREST_EDGES edges keep an edge from every node to the least one it is
    connected with; a task whose forest outgrows that begins another one.
    """
    def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = least_nodes(place[:len(u)], place[len(u):], len(nodes))
        child = np.flatnonzero(root != np.arange(len(nodes)))
        return nodes[child], nodes[root[child]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        trees, held, n = (nothing, nothing), [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= FOREST_EDGES:
                trees, held, n = forest(*(np.concatenate([trees[k], *(np.asarray(x.column(k)) for x in held)]) for k in (0, 1))), [], 0
                if len(trees[0]) >= 2 * FOREST_EDGES:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in trees], names=["u", "v"])
                    trees = (nothing, nothing)
        trees = forest(*(np.concatenate([trees[k], *(np.asarray(x.column(k)) for x in held)]) for k in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in trees], names=["u", "v"])
        release()

    edges = materialize(edges.select("u", "v"), "edges")
    tasks = max(1, -(-edges.count() // (2 * FOREST_EDGES)))
    out = materialize(edges.coalesce(tasks).mapInArrow(run, "u long, v long"), "edges")
    return out, tasks == 1 or _stars(out)


def _stars(edges: DataFrame) -> bool:
    """Every node has one edge, to a node without one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    loose = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return loose.where((F.col("below") > 1) | (F.col("below") == 1) & (F.col("above") == 1)).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of an edge table (a long, b long); component: its least node.

    Edges are contracted task by task before each round.  A hub's edges are joined with
    its least neighbour through ``join_by_weight``: its degree is its weight.
    """
    edges, done = _contracted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v"))
    while not done:
        total = 2 * edges.count()
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("weight"))
        large = (join_by_weight(both, least, ["u"], "weight", total).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"))
        large = materialize(large.distinct(), "edges")
        # Small star: towards the least smaller neighbour; neighbours (and the node) then point to it.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("weight"))
        small = join_by_weight(large, low, ["u"], "weight", total).select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v"))).where("u != v")
        edges, done = _contracted(small.distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Union-find over 0..n-1, for the items of one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def roots(self) -> np.ndarray:
        p = np.array(self.parent, np.int64)
        while not np.array_equal(q := p[p], p):
            p = q
        return p

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def clusters(keyed: DataFrame) -> DataFrame:
    """(node, component): items that a chain of shared keys connects; ``keyed``: (key long, item long)."""
    least = keyed.groupBy("key").agg(F.min("item").alias("b"))
    return components(keyed.join(least, "key").select(F.col("item").alias("a"), "b").where("a != b").distinct())


#: A key of an item, or (without a key) an item and the least one it shares a key with.
KEYED = "key long, item long, least long"


def settled(key: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
    """KEYED rows of a block: each key once, with its least item, and a link to that one from the key's other items."""
    order = np.argsort(key)
    key, item = key[order], item[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    least = np.minimum.reduceat(item, first) if len(key) else item
    leads = np.repeat(least, np.diff(np.append(first, len(key))))
    tied = np.flatnonzero(item != leads)
    tied = tied[np.lexsort((leads[tied], item[tied]))]
    tied = tied[np.append(True, (item[tied[1:]] != item[tied[:-1]]) | (leads[tied[1:]] != leads[tied[:-1]]))[:len(tied)]]
    keyed = np.arange(len(first) + len(tied)) < len(first)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key[first], np.zeros(len(tied), np.int64)]), mask=~keyed), pa.array(np.concatenate([least, item[tied]])),
         pa.array(np.concatenate([least, leads[tied]]), mask=keyed)], names=["key", "item", "least"])


def settled_clusters(keyed: DataFrame) -> DataFrame:
    """As ``clusters``, of a written table of KEYED rows.

    A key has one row from each block at most, so its rows meet in one partition.
    """
    parts = max(1, -(-keyed.count() // BLOCK_KEYS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            out = settled(*(np.concatenate([np.asarray(b.column(k)) for b in held]) for k in (0, 1)))
            yield pa.RecordBatch.from_arrays([out.column(1), out.column(2)], names=["a", "b"])

    met = keyed.where("key is not null").select("key", "item").repartition(parts, "key").mapInArrow(run, "a long, b long")
    local = keyed.where("key is null").select(F.col("item").alias("a"), F.col("least").alias("b"))
    return components(met.where("b is not null").unionAll(local))


def by_cluster(items: DataFrame, clustered: DataFrame, most: int) -> DataFrame:
    """``items`` (with a column item) as work units (cluster, x, y) of at most about 2 * ``most`` items.

    A cluster of up to ``most`` items is one unit.  A larger one is cut into
    blocks by a hash, and each pair of blocks is a unit, so that every pair of
    items meets in exactly one unit; ``side`` tells the blocks apart.
    """
    size = clustered.groupBy("component").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"))
    placed = (items.join(clustered, F.col("item") == F.col("node")).drop("node").join(size, "component")
              .withColumn("mine", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")))
    unit = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return unit.select(*items.columns, F.col("component").alias("cluster"), F.least("mine", "other").alias("x"),
                       F.greatest("mine", "other").alias("y"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
