"""Exact token counts at every prefix of a text, by dynamic programming.

Byte-pair encoding has a prefix structure: dropping the last token of an
encoding leaves the encoding of the shorter text, and a sequence of tokens is an
encoding exactly when each neighbouring pair encodes to itself.  So for every
prefix there is one last token ``t`` that may follow the last token of what
precedes it, and ``count[i] = count[i - len(t)] + 1``.  The table of a text holds
these counts for all its prefixes; how many tokens a text has, whether it fits a
limit, and where to cut it for a budget are then look-ups, with no encoding.

Defined cases: a null or empty text has the table ``[0]``; the vocabulary's
special strings count as one token where they occur whole, and as ordinary text
where a prefix ends inside one; repeated rows and null ids give a row each; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerloom.llm.textcodes import chunks

#: Pieces remembered by a task at a time (a working-memory bound; forgotten pieces are computed anew).
CACHE_PIECES = 1_000_000

#: Fixed value: the split pattern that goes with the vocabulary.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pieces(dict):
    """Tables of pieces, made when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        made = self[piece] = self.vocabulary.piece(piece)
        return made


class Vocabulary:
    """Merges of a byte-level BPE vocabulary file, and prefix tables under them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        added = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {raw(s) for s in spec["model"]["vocab"] if s not in added}
        self.longest = max(map(len, self.tokens))
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.split = regex.compile(SPLIT).findall
        self.blanks = regex.compile(r"\p{White_Space}{2,}")
        self.blank_pair = re.compile(r"\s\s").search  # a wider class: only says where to look
        self._follows: dict[tuple[bytes, bytes], bool] = {}
        self._pieces = _Pieces(self)

    def merge(self, text: bytes) -> list[bytes]:
        """Plain byte-pair encoding: join the pair of least rank, again and again."""
        parts, rank, never = [text[i:i + 1] for i in range(len(text))], self.rank.get, 1 << 30
        ranks = [rank(pair, never) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < never:
            i = ranks.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), never)
        return parts

    def _ends(self, before: bytes, token: bytes) -> bool:
        """Whether ``token`` can follow ``before`` (b'': nothing) as the last token."""
        if not before:
            return self.merge(token) == [token]
        if (before, token) in self.rank:
            return False  # side by side they would have been joined
        return self.merge(before + token) == [before, token]

    def piece_counts(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of one piece, by length in bytes (0 to all).

        Exactly one token ends each prefix, so the order of trial is free: the
        token that ended the last prefix, made longer, is the likeliest.
        """
        tokens, follows, longest = self.tokens, self._follows, self.longest
        if len(follows) > 2 * CACHE_PIECES:
            follows.clear()
        count, last, begin = [0], [b""], 0
        for i in range(1, len(piece) + 1):
            token = piece[begin:i]
            if follows.get((last[begin], token)):
                count.append(count[begin] + 1)
                last.append(token)
                continue
            for start in (begin, *range(i - 1, begin, -1), *range(begin - 1, max(0, i - longest) - 1, -1)):
                token = piece[start:i]
                if token in tokens:
                    pair = (last[start], token)
                    fits = follows.get(pair)
                    if fits is None:
                        fits = follows[pair] = self._ends(*pair)
                    if fits:
                        count.append(count[start] + 1)
                        last.append(token)
                        begin = start
                        break
            else:
                raise ValueError(f"no token ends a prefix of {piece[:40]!r}")
        return count

    def piece(self, text: str) -> bytes:
        """The counts after each character of a piece, as packed int32."""
        data = text.encode("utf-8")
        count = self.piece_counts(data)
        if len(data) == len(text):
            out = count[1:]
        else:
            ends = [i + 1 for i in range(len(data)) if i + 1 == len(data) or (data[i + 1] & 0xC0) != 0x80]
            out = [count[i] for i in ends]
        if text in ("'ll", "'re", "'ve"):
            out[1] = 2  # cut after one letter it is no contraction: apostrophe, letter
        return array("i", out).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        """Counts at each prefix (by characters, from 0) of a text without special strings."""
        pieces, known = self.split(text), self._pieces
        if len(known) > CACHE_PIECES:
            known.clear()
        tables = list(map(known.__getitem__, pieces))
        out = np.zeros(len(text) + 1, np.int32)
        if not pieces:
            return out
        out[1:] = np.frombuffer(b"".join(tables), np.int32)
        sizes = np.fromiter(map(len, tables), np.int64, len(tables)) // 4
        ends = np.cumsum(sizes)
        before = np.concatenate([[0], np.cumsum(out[ends])[:-1]])
        out[1:] += np.repeat(before, sizes).astype(np.int32)
        for run in self.blanks.finditer(text) if self.blank_pair(text) else ():  # a prefix that ends in blanks takes them as one piece
            a, b = run.span()
            out[a + 1:b + 1] = out[a] + np.frombuffer(self.piece(text[a:b]), np.int32)
        return out

    def table(self, text: str) -> np.ndarray:
        """Exact token counts of all prefixes: entry i is that of the first i characters."""
        marks = [m.span() for m in self.special.finditer(text)] if self.special and "<|" in text else []
        if not marks:
            return self._plain(text)
        out, base, at = [np.zeros(1, np.int32)], 0, 0
        for a, b in marks:
            out.append(base + self._plain(text[at:a])[1:])
            out.append(base + self._plain(text[at:b - 1])[a - at + 1:])  # cut inside: ordinary text
            base = int(base + self._plain(text[at:a])[-1]) + 1
            out.append(np.array([base], np.int32))
            at = b
        out.append(base + self._plain(text[at:])[1:])
        return np.concatenate(out).astype(np.int32)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def cut(table: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(table <= budget)[-1])


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id",
                 column: str = "text", with_table: bool = False) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars[, prefix_tokens]) of every whole text.

    ``fit_chars``: characters of the longest prefix within ``limit`` tokens.
    ``prefix_tokens`` (on request): the whole table, one count for each prefix.
    ``path``: the vocabulary file, readable at that place on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for b in batches:
            for chunk in chunks(b.column(1)):
                tables = [words.table(chunk.text(i)) for i in range(chunk.n)]
                n = np.array([t[-1] for t in tables], np.int64)
                out = {id_column: b.column(0).slice(chunk.first, chunk.n), "n_bytes": np.diff(chunk.offsets),
                       "n_tokens": n, "over_limit": n > limit,
                       "fit_chars": np.array([cut(t, limit) if t[-1] > limit else len(t) - 1 for t in tables], np.int64)}
                if with_table:
                    out["prefix_tokens"] = pa.array(tables, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out.values()],
                                                 names=list(out))

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return docs.select(id_column, column).mapInArrow(run, schema + ", prefix_tokens array<int>" * with_table)
