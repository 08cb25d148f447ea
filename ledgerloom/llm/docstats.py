"""Per-document counts over whole texts, computed for a chunk of documents at a time."""

from __future__ import annotations

import numpy as np

from ledgerloom.llm.textcodes import Chunk, Words, fold, lines, span_hashes

#: Characters counted as markup symbols.
SYMBOLS = b"#*$%&|<>"


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_SYMBOL = _flags(SYMBOLS)
_UPPER = _flags(bytes(range(65, 91)))
_LOWER = _flags(bytes(range(97, 123)))
_DIGIT = _flags(bytes(range(48, 58)))
_PUNCT = _flags(b".,;:!?\"'()-")
_LEAD = np.array([(b & 0xC0) != 0x80 for b in range(256)])


class Stats:
    """Lazily computed counts; every property is one value per document of the chunk."""

    def __init__(self, chunk: Chunk):
        self.chunk = chunk
        self._words: Words | None = None
        self._hashes: np.ndarray | None = None
        self._cache: dict[str, np.ndarray] = {}

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = Words(self.chunk)
        return self._words

    @property
    def word_hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = self.words.hashes(lower=False)
        return self._hashes

    def subset(self, keep: np.ndarray) -> Stats:
        """The same counts for the documents ``keep`` (one flag each); what was counted already is taken over."""
        chunk, sizes = self.chunk, np.diff(self.chunk.offsets)
        stays = np.repeat(keep, sizes)
        out = Stats(Chunk(chunk.data[stays], np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int64), chunk.null[keep], chunk.first))
        out._cache = {name: v[keep] for name, v in self._cache.items() if name != "line_spans"}
        if self._words is not None:
            old, mine = self._words, np.repeat(keep, self._words.counts)
            moved = np.repeat(chunk.offsets[:-1][keep] - out.chunk.offsets[:-1], old.counts[keep])
            words = Words.__new__(Words)
            words.chunk, words.is_word = out.chunk, old.is_word[stays]
            words.starts, words.ends, words.counts = old.starts[mine] - moved, old.ends[mine] - moved, old.counts[keep]
            words.offsets = np.concatenate([[0], np.cumsum(words.counts)])
            out._words = words
            if self._hashes is not None:
                out._hashes = self._hashes[mine]
        return out

    def has(self, name: str) -> bool:
        return name in self._cache

    def get(self, name: str) -> np.ndarray:
        if name not in self._cache:
            self._cache[name] = getattr(self, f"_{name}")()
        return self._cache[name]

    def _bytes(self, flags: np.ndarray) -> np.ndarray:
        return self.chunk.per_doc(flags[self.chunk.data])

    def _n_words(self):
        return self.words.counts.astype(np.int64)

    def _word_chars(self):
        return self.chunk.per_doc(self.words.is_word & _LEAD[self.chunk.data])

    def _n_symbols(self):
        return self._bytes(_SYMBOL)

    def _n_upper(self):
        return self._bytes(_UPPER)

    def _n_lower(self):
        return self._bytes(_LOWER)

    def _n_digits(self):
        return self._bytes(_DIGIT)

    def _n_punct(self):
        return self._bytes(_PUNCT)

    def _n_bangs(self):
        return self._bytes(_flags(b"!"))

    def _n_wide(self):
        return self.chunk.per_doc(self.chunk.data >= 0xC0)

    def _line_spans(self):
        start, end, doc = lines(self.chunk)
        word_before = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.words.is_word, dtype=np.int64)])
        filled = word_before[end] > word_before[start]
        return start[filled], end[filled], doc[filled]

    def _n_lines(self):
        """Lines that hold a word."""
        return np.bincount(self.get("line_spans")[2], minlength=self.chunk.n)

    def _n_dup_lines(self):
        """Lines that hold a word and equal an earlier line of the document."""
        start, end, doc = self.get("line_spans")
        h = span_hashes(self.chunk.data, start, end)
        order = np.argsort(h, kind="stable")
        same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        return np.bincount(doc[order][1:][same], minlength=self.chunk.n)

    def _n_repeat_words(self):
        """Words covered by a 3-word window that occurs twice or more in the document."""
        h, doc = self.word_hashes, self.words.doc()
        if len(h) < 3:
            return np.zeros(self.chunk.n, np.int64)
        inside = doc[2:] == doc[:-2]
        first = np.flatnonzero(inside)
        g = fold([h[first], h[first + 1], h[first + 2]], 3)
        order = np.argsort(g, kind="stable")
        g, first = g[order], first[order]
        same = (g[1:] == g[:-1]) & (doc[first[1:]] == doc[first[:-1]])
        repeated = np.zeros(len(g), bool)
        repeated[1:] |= same
        repeated[:-1] |= same
        covered = np.zeros(len(h), bool)
        for k in range(3):
            covered[first[repeated] + k] = True
        return np.bincount(doc[covered], minlength=self.chunk.n)

    def _n_stutter(self):
        """Words equal to the word before them."""
        h, doc = self.word_hashes, self.words.doc()
        same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        return np.bincount(doc[1:][same], minlength=self.chunk.n)

    def _n_short_words(self):
        """Words of three bytes or fewer."""
        w = self.words
        return np.bincount(w.doc()[(w.ends - w.starts) <= 3], minlength=self.chunk.n)

    def _n_distinct_words(self):
        h, doc = self.word_hashes, self.words.doc()
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        return np.bincount(doc[order][new], minlength=self.chunk.n)

    def _word_bytes_squared(self):
        w = self.words
        return np.bincount(w.doc(), weights=((w.ends - w.starts) ** 2).astype(float), minlength=self.chunk.n)
