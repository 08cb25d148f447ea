"""SimHash near duplicates against all pairs of brute-force fingerprints."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash

from .conftest import NASTY, words

DOC = "doc_id long, text string, fp long, component long"


def fingerprint(text) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def linked(fps: list[int]) -> list[int]:
    """The least place of each fingerprint's component."""
    label = list(range(len(fps)))
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    while True:
        step = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(fps))]
        if step == label:
            return label
        label = step


def brute(rows):
    fps = [fingerprint(t) for _, t, *_ in rows]
    groups, label = {}, linked(fps)
    for (i, *_), k in zip(rows, label):
        groups.setdefault(k, []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, f"{fp:016x}", least[k]) for (i, *_), fp, k in zip(rows, fps, label)), key=repr)


def found(df):
    return sorted((tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_nasty_rows(nasty, no_docs):
    assert found(nasty) == brute(NASTY)
    assert found(no_docs) == []


def near_copies(seed: int, families: int, copies: int) -> list[str]:
    rng, out = random.Random(seed), []
    for f in range(families):
        base = words(seed * 50 + f, rng.choice([40, 150, 600])).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(["x", "yy", "zzz"])
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [512, 3])
def test_near_copies(llm, monkeypatch, block):
    """With a small block nearly every part value is compared block by block."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = near_copies(3, 6, 25) + [words(k, 80) for k in range(60)] + [None, "", " \n", "one", "One", "a b", "a  B\t"]
    rows = [(k * 7 % 400 if k % 9 else None, t) for k, t in enumerate(texts)]
    expected = brute(rows)
    assert len({r[2] for r in expected}) < len({r[1] for r in expected})
    assert found(llm.createDataFrame([(*r, 1, 2) for r in rows], DOC).repartition(4)) == expected


@pytest.mark.parametrize("m", simhash.PARTS)
def test_every_close_pair_is_probed(m):
    """Whatever thresholds an item gets, one of its probes meets each fingerprint within three bits."""
    rng = np.random.default_rng(m)
    x = rng.integers(0, 2**63, 400, dtype=np.uint64)
    x[200:] &= np.uint64(0xFF00FFFF0000FFFF)  # half of them on few bits: uneven estimates
    cut = simhash.Cut(simhash.correlated_parts(simhash._together(x).reshape(64, 64), len(x), m))
    assert sorted(b for p in cut.parts for b in p) == list(range(64))
    cut.learn(cut.counts(x), len(x))
    wanted, _ = cut.thresholds(x)
    assert (wanted.sum(axis=1) == simhash.MOST_BITS - m + 1).all()
    other = x.copy()
    for _ in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    probed: dict = {}
    for key, fp in cut.probes(x):
        for k, f in zip(key.tolist(), fp.tolist()):
            probed.setdefault(f, set()).add(k)
    entries = [e[0] for e in cut.entries(other)]
    for i in range(len(x)):
        assert any(int(e[i]) in probed[int(x[i])] for e in entries)


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**20, 50, dtype=np.uint64)
    cut = simhash.Cut(simhash.correlated_parts(simhash._together(x).reshape(64, 64), len(x), 3))
    cut.learn(cut.counts(x), len(x))
    wanted, cost = cut.thresholds(x)
    est = cut.candidates(x)

    def price(v, i):
        return sum(est[k][i, t] + simhash.ROW_COST * len(simhash.masks(len(cut.parts[k]), t)) for k, t in enumerate(v) if t >= 0)

    options = [(a, b, c) for a in range(-1, 4) for b in range(-1, 4) for c in range(-1, 4) if a + b + c == 1]
    for i in range(len(x)):
        assert price(wanted[i], i) == pytest.approx(min(price(v, i) for v in options))
        assert cost[i] == pytest.approx(price(wanted[i], i) + 3 * simhash.ROW_COST)


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (3000, 64)).astype(np.uint8)
    for k in range(1, 8):
        bits[:, 9 * k] = bits[:, 0]
    x = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    parts = simhash.correlated_parts(simhash._together(x).reshape(64, 64), len(x), 4)
    assert any(set(range(0, 64, 9)) <= set(p) for p in parts)
