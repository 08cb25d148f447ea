"""Vectorised views of text columns: bytes, words and hashes of whole Arrow batches.

Every function works on the bytes of many documents at once (``Chunk``), so the
per-byte work is numpy and no Python loop runs per word.  A chunk holds whole
documents of about ``CHUNK_BYTES`` together; one longer document is a chunk of
its own.  Nulls are read as empty texts (``Chunk.null`` keeps where they were).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled together in a task; bounds the working memory, not the texts.
CHUNK_BYTES = 1 << 20

_SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)
IS_WORD = np.ones(256, bool)
IS_WORD[_SPACES] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_CODE_LOWER = _CODE[LOWER]
_R = np.uint64(0x9E3779B97F4A7C15)  # 5 mod 8: powers repeat only after 2**62 steps
_R_INVERSE = np.uint64(pow(int(_R), -1, 2**64))
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = have
    return have[:n]


def release() -> None:
    """Give freed memory back to the system: workers are reused, and the allocators would keep their peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Chunk:
    """Whole documents: ``data`` (UTF-8 bytes) and ``offsets`` (one more than documents)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, null: np.ndarray, first: int):
        self.data, self.offsets, self.null, self.first = data, offsets, null, first
        self.n = len(offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes().decode("utf-8", "replace")

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array for each document."""
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of one Arrow text column, in order, a chunk at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    null = np.asarray(pc.is_null(column))
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield Chunk(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start], null[start:stop], start)
        start = stop
    if start:
        release()


class Words:
    """Words of a chunk: runs of bytes outside 0x20 and 0x09-0x0D, never across documents."""

    def __init__(self, chunk: Chunk):
        is_word = IS_WORD[chunk.data]
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:]
        inner = chunk.offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(is_word))]
        begins[inner] = is_word[inner]
        ends[inner - 1] = is_word[inner - 1]
        self.chunk = chunk
        self.is_word = is_word
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.offsets = np.searchsorted(self.starts, chunk.offsets)  # of documents, in words
        self.counts = np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(self.chunk.n), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        return span_hashes(self.chunk.data, self.starts, self.ends, lower)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial over random byte codes, then ``mix``."""
    code = (_CODE_LOWER if lower else _CODE)[data]
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code * _power(_R, len(data)), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * _power(_R_INVERSE, len(data) + 1)[starts])


def fold(parts: list[np.ndarray], salt: int | np.ndarray = 0) -> np.ndarray:
    """One hash of several hashes in order; ``salt``: one, or one for each."""
    total = np.full(len(parts[0]), salt, np.uint64)
    for i, part in enumerate(parts):
        total += part * _STEP[i % 64]
    return mix(total)


def windows(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows inside documents, with their document and first word.

    A document with fewer words (but one at least) gives one window: all its words.
    """
    counts = np.diff(offsets)
    full = np.maximum(counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), full)
    first = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full) + np.repeat(offsets[:-1], full)
    out = fold([hashes[first + k] for k in range(size)], size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.array([fold([hashes[j:j + 1] for j in range(offsets[d], offsets[d + 1])], int(counts[d]))[0]
                          for d in short], np.uint64)
        doc, first, out = (np.concatenate(x) for x in ((doc, short), (first, offsets[short]), (out, extra)))
        order = np.argsort(first, kind="stable")
        doc, first, out = doc[order], first[order], out[order]
    return out, doc, first


def stable_order(x: np.ndarray) -> np.ndarray:
    """The stable order of numbers of which few are equal: the fast sort, then equal ones by place."""
    order = np.argsort(x)
    held = x[order]
    same = held[1:] == held[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(x) else order
    order[tied] = order[tied][np.lexsort((order[tied], held[tied]))]
    return order


def distinct_pairs(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, owner) pairs, sorted by hash and then owner; ``owner`` must be ascending."""
    order = stable_order(hashes)
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], o[new]


def lines(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every line (split at newline bytes; an empty text has one empty line)."""
    breaks = np.flatnonzero(chunk.data == 10)
    per_doc = np.diff(np.searchsorted(breaks, chunk.offsets)) + 1
    doc = np.repeat(np.arange(chunk.n), per_doc)
    first = np.cumsum(per_doc) - per_doc
    s, e = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    s[first], e[first + per_doc - 1] = chunk.offsets[:-1], chunk.offsets[1:]
    rest = np.ones(len(doc), bool)
    rest[first] = False
    s[rest] = breaks + 1
    rest = np.ones(len(doc), bool)
    rest[first + per_doc - 1] = False
    e[rest] = breaks
    return s, e, doc
