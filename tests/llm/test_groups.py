"""Operators that bring documents together: joins, lines, benchmark passages, mixtures."""

from __future__ import annotations

import collections
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, grouping, language_id, line_dedup, mixing, ngram_join, registry
from ledgerloom.llm.textcodes import chunks, stable_order

from .conftest import ITEM, NASTY, frame, words

DOC = "doc_id long, text string, source string"


def union_find(n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x, y):
        parent[max(find(x), find(y))] = min(find(x), find(y))

    return find, join


def variants(seed: int, n: int, edits: int, size: int = 60, families: int = 3) -> list[str]:
    """Texts in families of near copies, some equal, some just beyond the threshold."""
    rng = random.Random(seed)
    out = []
    for f in range(families):
        base = words(seed * 100 + f, size).split()
        for k in range(n):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out


# ---------------------------------------------------------------- components


def test_components_of_random_graphs(llm):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(70)]
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    find, join = union_find(len(nodes))
    for a, b in edges:
        join(at[a], at[b])
    got = {r.node: r.component for r in grouping.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: nodes[find(at[x])] for x in linked}
    assert grouping.components(llm.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("most", [4, 64])
def test_components_over_many_tasks(llm, monkeypatch, most):
    """Forests that outgrow a task, merged in rounds, give the least node of each component."""
    monkeypatch.setattr(grouping, "FOREST_EDGES", most)
    rng = random.Random(most)
    path = rng.sample(range(5000, 9000), 300)
    edges = [*zip(path, path[1:]), *((9500, k) for k in range(9501, 9600))] + [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    rng.shuffle(edges)
    nodes = sorted({x for a, b in edges for x in (a, b) if a != b})
    at = {x: i for i, x in enumerate(nodes)}
    find, join = union_find(len(nodes))
    for a, b in edges:
        if a != b:
            join(at[a], at[b])
    got = {r.node: r.component for r in grouping.components(llm.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {x: nodes[find(at[x])] for x in nodes}


def test_half_a_million_edges_are_contracted_at_once(llm, monkeypatch):
    """A path in random order: two written tables, whatever the edges' order."""
    written = []
    real = grouping.materialize
    monkeypatch.setattr(grouping, "materialize", lambda df, label: written.append(label) or real(df, label))
    n = 600_000
    place = lambda c: F.pmod(c * 387_421, F.lit(1_000_003))
    edges = llm.range(n, numPartitions=4).select(place(F.col("id")).alias("a"), place(F.col("id") + 1).alias("b"))
    assert grouping.components(edges).agg(F.count("*"), F.max("component")).first()[:] == (n + 1, 0)
    assert len(written) == 2


def test_least_nodes_of_paths_and_stars():
    rng = np.random.default_rng(3)
    order = rng.permutation(5000)
    assert not grouping.least_nodes(order[1:], order[:-1], 5000).any()
    assert not grouping.least_nodes(np.full(4999, 4999), np.arange(4999), 5000).any()
    assert grouping.least_nodes(np.array([3, 4]), np.array([1, 3]), 6).tolist() == [0, 1, 2, 1, 1, 5]


def test_order_of_equal_numbers_is_stable():
    rng = np.random.default_rng(4)
    for n, high in ((0, 1), (1, 1), (5000, 3), (5000, 10**9)):
        x = rng.integers(0, high, n).astype(np.uint64)
        assert np.array_equal(stable_order(x), np.argsort(x, kind="stable"))


def test_a_sieve_holds_what_it_was_built_of(llm):
    items = llm.range(5000).select((F.xxhash64("id")).alias("item"))
    sieve = grouping.sieve_of(items)
    own = np.array([r.item for r in items.collect()])
    others = np.array([r.item for r in llm.range(9000, 14000).select(F.xxhash64("id").alias("item")).collect()])
    assert sieve.holds(own).all() and sieve.holds(others).mean() < 0.1
    assert not grouping.sieve_of(items.limit(0)).holds(own).any()


# ---------------------------------------------------------------- the Jaccard join


def shingle_set(text) -> frozenset:
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, min(len(w), 1))))


def brute_join(rows: list[tuple]) -> list[tuple]:
    sets = [shingle_set(t) for _, t, *_ in rows]
    find, join = union_find(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                join(a, b)
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), (min(ids) if ids else None) if sets[k] else i))
    return out


KEY = lambda r: tuple((x is None, x) for x in r)


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()), key=KEY)


def test_join_of_nasty_rows(nasty, no_docs):
    assert joined(nasty) == sorted(brute_join(NASTY), key=KEY)
    assert joined(no_docs) == []


@pytest.mark.parametrize("block", [1024, 7])
def test_join_of_near_copies(llm, monkeypatch, block):
    """With small blocks a group is cut into pairs of blocks and must come out the same."""
    monkeypatch.setattr(ngram_join, "BLOCK_ITEMS", block)
    texts = variants(3, 16, 4) + variants(4, 10, 2, 25) + ["a b c d"] * 3 + ["A b C d", "a b c", "", None] + [words(9, 80)] * 5
    rows = [(k * 3 % 101, t, "s") for k, t in enumerate(texts)]
    assert joined(llm.createDataFrame(rows, DOC).repartition(5)) == sorted(brute_join(rows), key=KEY)


def test_search_finds_every_link_and_its_count():
    texts = variants(5, 14, 6, 40)
    sets_ = [shingle_set(t) for t in dict.fromkeys(texts)]
    keys = [np.sort(np.array([hash(x) & (2**63 - 1) for x in s], np.uint64)) for s in sets_]
    got = {(q, int(f)) for q, found in ngram_join.search(keys, np.zeros(len(keys), int)) for f in found}
    want = {(a, b) for b in range(len(sets_)) for a in range(b)
            if 100 * len(sets_[a] & sets_[b]) >= 75 * len(sets_[a] | sets_[b])}
    assert got == want


def test_number_of_links(llm):
    rows = [(k, t, "s") for k, t in enumerate(dict.fromkeys(variants(6, 9, 3)))]
    sets_ = [shingle_set(t) for _, t, _ in rows]
    want = {k: sum(100 * len(s & o) >= 75 * len(s | o) for o in sets_) - 1 for k, s in enumerate(sets_)}
    assert {r.doc_id: r.n_links for r in ngram_join.join(llm.createDataFrame(rows, DOC)).collect()} == want


def test_one_document_of_each_group_stays(nasty, no_docs, llm):
    kept = ngram_join.keep_one(nasty)
    assert kept.columns == nasty.columns
    best: dict = {}
    alone = set()
    for (i, t, *_), (_, n, component) in zip(NASTY, brute_join(NASTY)):
        if n:
            best[component] = min(best.get(component, (True, 0)), (i is None, i if i is not None else 0))
        else:
            alone.add((i, t))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=KEY)
    firsts = {i for _, i in best.values()}
    assert {i for i, _ in got} - {None} == (firsts | {i for i, _ in alone}) - {None}
    assert len(got) == len(best) + len(alone) and len(set(got)) == len(got)
    assert ngram_join.keep_one(no_docs).collect() == []


# ---------------------------------------------------------------- lines


def brute_lines(rows: list[tuple]) -> dict:
    """Lines that go, by (id, text)."""
    seen = dict.fromkeys((i, t) for i, t, *_ in rows)
    place = []
    for i, t in seen:
        for k, line in enumerate([] if t is None else t.split("\n")):
            if len(line) >= line_dedup.LEAST_CHARS:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
                place.append(((i is None, i if i is not None else 0), i, t, k,
                              frozenset(low[j:j + 8] for j in range(len(low) - 7))))
    find, join = union_find(len(place))
    for a in range(len(place)):
        for b in range(a):
            x, y = place[a][4], place[b][4]
            if 100 * len(x & y) >= 75 * len(x | y):
                join(a, b)
    groups = collections.defaultdict(list)
    for k, p in enumerate(place):
        groups[find(k)].append(p)
    gone = collections.defaultdict(set)
    for members in groups.values():
        for p in sorted(members, key=lambda p: (p[0], p[3]))[1:]:
            gone[p[1], p[2]].add(p[3])
    return gone


def without(text, gone):
    return None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def test_lines_of_near_copies(llm, monkeypatch):
    rng = random.Random(8)
    pool = [" ".join(words(700 + k, 14).split()) for k in range(12)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 5)):
            w = rng.choice(pool).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = "zq"
            lines.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
        lines += ["short", "", words(9000 + d, 12)]
        rng.shuffle(lines)
        rows.append((d, "\n".join(lines), "s"))
    rows += [(100, None, "s"), (None, rows[3][1], "s"), (101, "", "s"), rows[5]]
    gone = brute_lines(rows)
    want = sorted(((i, len(gone[i, t]), without(t, gone[i, t])) for i, t, _ in rows), key=KEY)
    for block in (1024, 5):
        monkeypatch.setattr(line_dedup, "BLOCK_ITEMS", block)
        got = line_dedup.line_report(llm.createDataFrame(rows, DOC).repartition(4))
        assert sorted(((r.doc_id, r.n_removed, r.text) for r in got.collect()), key=KEY) == want


def test_equal_lines_of_neighbours_whatever_the_batches(llm):
    """Batches are cut by bytes, elsewhere in each pass; a line of two neighbouring documents only must be found."""
    rows = [(d, f"{words(40000 + d, 30)}\n{words(50000 + d // 2, 14)}", "s") for d in range(240)]
    docs = llm.createDataFrame(rows, DOC).coalesce(1)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = llm.conf.get(name)
    try:
        llm.conf.set(name, "2500")
        assert {r.doc_id for r in line_dedup.line_report(docs).collect() if r.n_removed} == set(range(1, 240, 2))
    finally:
        llm.conf.set(name, before)


@pytest.mark.parametrize("module", [line_dedup, ngram_join])
def test_packed_rows_do_not_grow_with_the_batches(llm, module):
    """One block of one task has a row for each bucket and a header, however many batches it came in."""
    docs = llm.createDataFrame([(f"{words(70000 + d, 30)}\n{words(80000 + d, 14)}",) for d in range(240)], "text string").coalesce(1)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = llm.conf.get(name)
    try:
        llm.conf.set(name, "2500")
        packed = module.pack(docs, 64).collect()
    finally:
        llm.conf.set(name, before)
    assert len(packed) <= 65 and len({r.block for r in packed}) == 1


def test_a_key_of_many_lines_is_sent_once_by_a_block(llm):
    """Lines that differ in a character share most bands; a task sends each band once and links its lines itself."""
    base = words(71000, 40)
    items = llm.createDataFrame([(k, base[:k] + "#" + base[k + 1:]) for k in range(120)], "item long, text string").coalesce(1)
    keyed = line_dedup.band_keys(items).collect()
    keys = [r.key for r in keyed if r.key is not None]
    assert len(keys) == len(set(keys)) and all(r.least is None for r in keyed if r.key is not None)
    clustered = grouping.settled_clusters(line_dedup.band_keys(items.repartition(3)))
    got = {r.node: r.component for r in clustered.collect()}
    assert len(got) > 100 and set(got.values()) == {0}


def test_the_bound_on_common_shingles_drops_no_link():
    rng = random.Random(12)
    base = words(72000, 60)
    lines = [base] + ["".join(rng.choice("xyz") if rng.random() < p else c for c in base) for p in (0.005, 0.01, 0.02, 0.03, 0.05) for _ in range(8)]
    lines += [base * 3, "ab" * 400, "ab" * 500]
    sets = line_dedup.Sets(pa.array(lines))
    x, y = np.triu_indices(len(lines), 1)
    shingles = [{t[j:j + 8] for j in range(len(t) - 7)} for t in lines]
    want = [100 * len(shingles[a] & shingles[b]) >= 75 * len(shingles[a] | shingles[b]) for a, b in zip(x, y)]
    assert 20 < sum(want) < len(want) - 20 and sets.linked(x, y).tolist() == want


def test_short_lines_that_repeat_go(llm):
    """Too short for shingles, or under 30 characters; blank lines and indents stay."""
    own = [words(60000 + d, 12) for d in range(6)]
    rows = [(d, "\n".join(["  ", "Ab 1", own[d], "", "tel: 555-0100 ext 7", "ab 1" if d else f"x{d}", "-", "x"]), "s") for d in range(6)]
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.line_report(llm.createDataFrame(rows, DOC).repartition(3)).collect()}
    assert got[0] == (0, rows[0][1])
    assert all(got[d] == (5, "\n".join(["  ", own[d], ""])) for d in range(1, 6))


def test_lines_of_nasty_rows(nasty, no_docs):
    out = line_dedup.dedup_lines(nasty)
    assert out.columns == nasty.columns and out.schema["n_chars"].dataType == nasty.schema["n_chars"].dataType
    rows = out.collect()
    ids = collections.Counter(r.doc_id for r in rows)
    assert ids[6] == 1 and 7 not in ids and ids[1] == 2 and ids[2] == ids[3] == ids[4] == 1
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert line_dedup.dedup_lines(no_docs).collect() == [] and line_dedup.line_report(no_docs).collect() == []


def test_banding_finds_lines_at_the_threshold():
    rng = random.Random(11)
    hits = total = 0
    for k in range(250):
        w = words(k, 30).split()
        v = list(w)
        for _ in range(2):
            v[rng.randrange(len(v))] = words(rng.randrange(10**6), 1)
        for c in chunks(pa.array([" ".join(w), " ".join(v)])):
            own = line_dedup.Lines(c)
            h, owner = own.shingles(np.arange(2))
            a, b = set(h[owner == 0].tolist()), set(h[owner == 1].tolist())
            if len(a & b) >= 0.75 * len(a | b):
                keys = line_dedup.bands(h, owner, 2)
                total += 1
                hits += bool((keys[0] == keys[1]).any())
    assert total > 100 and hits / total > 0.98


# ---------------------------------------------------------------- benchmark passages


def edits(a: list, b: list) -> int:
    """Least edits between a and a prefix of b."""
    row = list(range(len(b) + 1))
    row = [0] * 1 + row[1:]
    for i in range(1, len(a) + 1):
        new = [i]
        for j in range(1, len(b) + 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a[i - 1] != b[j - 1])))
        row = new
    return min(row)


def test_distances_are_exact():
    rng = np.random.default_rng(3)
    for limit in (0, 1, 3):
        a = rng.integers(0, 3, (40, 9), dtype=np.uint64)
        b = rng.integers(0, 3, (40, 9 + limit), dtype=np.uint64)
        b[:20, :9] = a[:20]
        b[5:20, 4] = 7
        got = decontamination.distances(a, b, limit)
        want = [min(edits(x.tolist(), y.tolist()), limit + 1) for x, y in zip(a, b)]
        assert got.tolist() == want


def test_items_are_found_with_edits_and_only_then(llm):
    rng = random.Random(13)
    items = [(k, words(2000 + k, rng.randint(10, 45))) for k in range(30)]
    docs, truth = [], {}
    for k in range(240):
        item, text = items[k % 30]
        w = text.split()
        limit = int(decontamination.EDITS * len(w))
        for _ in range([0, limit, 3 * limit + 4][k % 3]):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at:at + (kind != 1)] = [f"n{rng.randrange(10**6)}"] if kind < 2 else []
        docs.append((k, f"{words(5000 + k, 25)} {' '.join(w).title()}\n{words(7000 + k, 9)}", "s"))
        truth[k] = (item, k % 3)
    found = decontamination.find_items(llm.createDataFrame(docs, DOC), llm.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert all((k, item) in got and got[k, item].edits == 0 for k, (item, kind) in truth.items() if kind == 0)
    near = [(k, item) for k, (item, kind) in truth.items() if kind == 1]
    assert np.mean([x in got for x in near]) >= 0.9
    body = {i: t.lower().split() for i, t, _ in docs}
    for (d, i), r in got.items():
        own = dict(items)[i].split()
        assert edits(own, body[d][r.first_word:r.first_word + len(own) + 20]) == r.edits <= decontamination.EDITS * len(own)


@pytest.mark.parametrize("size", [20, 40])
def test_items_with_edits_at_the_limit_are_found(size):
    rng = random.Random(size)
    items = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(size)) for _ in range(60)]
    docs = []
    for k in range(900):
        w = items[k % 60].split()
        for _ in range(int(decontamination.EDITS * size)):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at:at + (kind != 1)] = [f"n{rng.randrange(10**6)}"] if kind < 2 else []
        docs.append(f"{words(k, 12)} {' '.join(w)} {words(k + 5000, 20)}")
    row, item, _, _ = decontamination.Items(list(range(60)), items).search(pa.array(docs, pa.large_string()))
    assert np.sum(item == row % 60) / len(docs) >= decontamination.RECALL


@pytest.mark.parametrize("size", [1, 3, 7])
def test_short_items_are_found_verbatim(size):
    items = [" ".join(f"w{size}x{k}y{j}" for j in range(size)) for k in range(5)] + ["W1a w1b", "w1a  W1B"]
    docs = [words(1, 30), f"{words(2, 5)} {items[1].upper()} {items[3]} {items[1]}", items[2], " ".join(items[4].split()[:-1]) + "x", "q w1a w1b", None, ""]
    row, item, d, first = decontamination.Items(list(range(7)), [i.lower() for i in items]).search(
        pa.array([None if t is None else t.lower() for t in docs], pa.large_string()))
    assert sorted(zip(row.tolist(), item.tolist(), d.tolist(), first.tolist())) == [
        (1, 1, 0, 5), (1, 3, 0, 5 + size), (2, 2, 0, 0), (4, 5, 0, 1), (4, 6, 0, 1)]


@pytest.mark.parametrize("size", [129, 1000, 10_000])
def test_long_items_are_found_by_their_parts(size):
    """Spread edits just within the limit, edits crowded in one place, one edit too many, and a part alone."""
    rng = random.Random(size)
    item = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    limit = int(decontamination.EDITS * size)

    def edited(places):
        w = list(item)
        for p in sorted(places, reverse=True):
            w[p:p + 1] = [] if p % 3 == 0 else [f"n{p}"] if p % 3 == 1 else [f"n{p}", w[p]]
        return w

    spread = edited(rng.sample(range(size), limit))
    crowd = edited(range(size // 3, size // 3 + limit))
    beyond = [f"n{k}" if k < limit + 1 else w for k, w in enumerate(item)]
    docs = [" ".join(x) for x in ([*words(1, 9).split(), *spread, *words(2, 50).split()], crowd, beyond, item[:80], words(3, 400).split(), [*words(4, 3).split(), *item])]
    row, found, d, first = decontamination.Items([0, 1], [" ".join(item), words(9, 20)]).search(pa.array(docs, pa.large_string()))
    got = {r: (e, f) for r, i, e, f in zip(row.tolist(), found.tolist(), d.tolist(), first.tolist()) if i == 0}
    assert set(got) == {0, 1, 5} and got[5] == (0, 3) and got[1][0] <= limit and got[0][0] <= limit
    if size < 2000:
        for r, (e, f) in got.items():
            assert edits(item, docs[r].split()[f:f + size + limit + 1]) == e


def test_nearest_start_is_the_least_over_all_passages():
    rng = np.random.default_rng(4)
    for _ in range(40):
        item, text = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 25))
        best = min((edits(item.tolist(), text[k:].tolist()), k) for k in range(len(text) + 1))
        assert decontamination.nearest_start(item.astype(np.uint64), text.astype(np.uint64))[0] == best[0]


def test_passages_of_nasty_rows(nasty, no_docs, benchmark_items, no_items):
    rows = decontamination.find_items(nasty, benchmark_items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(9, 1), (9, 5)}
    brief = benchmark_items.sparkSession.createDataFrame([(7, "Word"), (8, "four five"), (9, "two three four")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_items(nasty, brief).collect()} == {(5, 7), (12, 8), (12, 9), (13, 8), (13, 9)}
    assert {r.doc_id for r in nasty.collect()} - {r.doc_id for r in decontamination.clean(nasty, brief).collect()} == {12, 13}
    kept = decontamination.clean(nasty, benchmark_items)
    assert kept.columns == nasty.columns and len(kept.collect()) == len(NASTY) - 1
    assert decontamination.find_items(nasty, no_items).collect() == []
    assert decontamination.find_items(no_docs, benchmark_items).collect() == []
    assert decontamination.clean(nasty, no_items).count() == len(NASTY)
    assert ITEM.split()[0] in next(t for i, t, *_ in NASTY if i == 9)


def test_blocks_of_items_change_nothing(llm, nasty, benchmark_items, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 2)
    rows = decontamination.find_items(nasty, benchmark_items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(9, 1), (9, 5)}


# ---------------------------------------------------------------- mixtures


def test_mixture_of_nasty_rows_is_that_of_sql(nasty, no_docs):
    con = duckdb.connect()
    con.register("documents", nasty.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    columns = ["doc_id", "source", "n_tokens", "epoch", "block", "block_start", "source_budget"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({mixing.SQL})").fetchall()
    want = [tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r) for r in want]
    got = [tuple(r[c] for c in columns) for r in mixing.mixed_sources(nasty).collect()]
    assert sorted(got, key=KEY) == sorted(want, key=KEY)
    assert mixing.mix(no_docs).collect() == []
    assert mixing.mix(nasty).columns[:len(nasty.columns)] == nasty.columns


def test_mixture_meets_its_targets(llm, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 64)
    monkeypatch.setattr(mixing, "_BUCKET_BLOCKS", 4)
    rng = random.Random(5)
    rows = [(k, words(k, rng.randint(5, 30)), rng.choice("aaaaaaaabbbc")) for k in range(900)]
    docs = llm.createDataFrame(rows, DOC)
    total = collections.Counter()
    for _, t, s in rows:
        total[s] += len(t.split())
    for options in ({"max_repetition": 2.0}, {"max_repetition": None, "target_entropy": 0.9},
                    {"max_repetition": 3.0, "budget": 4000}):
        out = mixing.mix(docs, **options).collect()
        taken = collections.Counter()
        for r in out:
            taken[r.source] += r.n_tokens
        for s in total:
            budget = next(r.source_budget for r in out if r.source == s)
            assert budget <= taken[s] <= budget + 64 + 200  # the last block may cross the budget
            per_pass = collections.defaultdict(list)
            for r in out:
                if r.source == s:
                    per_pass[r.epoch].append(r.doc_id)
            for e in range(budget // total[s]):
                assert sorted(per_pass[e]) == sorted(k for k, _, x in rows if x == s)
        share = {s: next(r.source_budget for r in out if r.source == s) for s in total}
        if options.get("max_repetition"):
            assert max(share[s] / total[s] for s in total) <= options["max_repetition"] * 1.001 + 0.01
        if options.get("target_entropy"):
            p = [x / sum(share.values()) for x in share.values()]
            assert abs(-sum(x * math.log(x) for x in p) - options["target_entropy"]) < 1e-2
        if options.get("budget"):
            assert abs(sum(share.values()) - options["budget"]) <= len(share)


def test_passes_have_their_own_order(llm, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 32)
    rows = [(k, words(k, 12), "ab"[k % 9 == 0]) for k in range(300)]
    out = [r for r in mixing.mix(llm.createDataFrame(rows, DOC)).collect() if r.source == "b"]
    order = [[r.block for r in sorted(out, key=lambda r: r.block_start) if r.epoch == e] for e in (0, 1)]
    assert order[0] != order[1]


# ---------------------------------------------------------------- the pipeline


def test_pipeline_against_its_parts(llm):
    """Every stage on a small corpus, against brute force over what the stage before kept."""
    import corpus_pipeline

    rng = random.Random(21)
    rows = [(1000 + k, words(k, 50), "en", "ab"[k % 2]) for k in range(12)]
    rows += [(2000 + k, t, "en", "a") for k, t in enumerate(variants(31, 4, 2, 60, 2))]
    rows += [(3000, words(1, 10) + "\n" + ITEM + "\n" + words(2, 10), "en", "b"), (3001, None, "en", "a"), (3002, "12 34", "en", "b")]
    rng.shuffle(rows)
    docs = frame(llm, rows)
    bench = llm.createDataFrame([(1, ITEM)], "item_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "mixing"]
    path = f"{__import__('ledgerloom.session', fromlist=['x']).scratch_dir(llm, 'pipeline-test')}"
    bench.write.parquet(f"{path}/benchmark.parquet")
    docs.write.parquet(f"{path}/documents.parquet")

    one = stages["language_id"](llm, docs, path).collect()
    assert {r.doc_id for r in one} == {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    gone = brute_lines([(r.doc_id, r.text) for r in one])
    two = stages["line_dedup"](llm, llm.createDataFrame(one, docs.schema), path).collect()
    want = {r.doc_id: without(r.text, gone[r.doc_id, r.text]) for r in one}
    assert {r.doc_id: r.text for r in two} == {i: t for i, t in want.items() if t.split()}
    three = stages["ngram_join"](llm, llm.createDataFrame(two, docs.schema), path).collect()
    assert {r.doc_id for r in three} == {c for _, _, c in brute_join([(r.doc_id, r.text) for r in two])}
    four = stages["decontamination"](llm, llm.createDataFrame(three, docs.schema), path).collect()
    assert {r.doc_id for r in four} == {r.doc_id for r in three if ITEM not in r.text}
    five = corpus_pipeline.run(llm, path)
    assert five.columns[:len(docs.columns)] == docs.columns
    assert {r.doc_id for r in five.collect()} == {r.doc_id for r in four}


def test_pipeline_of_nasty_and_empty_tables(llm, nasty, no_docs, benchmark_items, no_items):
    import corpus_pipeline
    from ledgerloom.session import scratch_dir

    for docs, items in ((nasty, benchmark_items), (no_docs, no_items)):
        path = scratch_dir(llm, "pipeline-nasty")
        docs.write.parquet(f"{path}/documents.parquet")
        items.write.parquet(f"{path}/benchmark.parquet")
        rows = corpus_pipeline.run(llm, path).collect()
        assert not {2, 3, 4, 7, 9, 11} & {r.doc_id for r in rows}
        assert ({1, 6} <= {r.doc_id for r in rows}) == (docs is nasty)


def test_registry_covers_every_operator():
    names = list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(names)
    assert language_id.ORDER == 3
