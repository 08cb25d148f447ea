"""Words of a chunk of texts as spans of one buffer: lower-cased, one separator byte after each word."""

from __future__ import annotations

import numpy as np

from ledgerloom.llm.textcodes import LOWER, Chunk


class Spans:
    """The words of ``chunk`` as ``buffer[start[k]:end[k]]``; ``offsets`` are the documents in words.

    ``is_word`` tells word bytes by their value.  Words never cross documents.
    Every word is followed by one byte of ``buffer``: a space, or a newline where
    a byte for which ``is_break`` holds, or the end of the document, comes before
    the next word.
    """

    def __init__(self, chunk: Chunk, is_word: np.ndarray, is_break: np.ndarray | None = None):
        data, n = chunk.data, len(chunk.data)
        inside = is_word[data]
        edge = np.zeros(n + 1, bool)
        edge[chunk.offsets] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:n]
        ends[:-1] &= ~inside[1:] | edge[1:n]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        size = last - first
        self.n = len(first)
        self.offsets = np.searchsorted(first, chunk.offsets)
        self.start = np.cumsum(size + 1) - size - 1
        self.end = self.start + size
        buffer = np.full(int(size.sum()) + self.n, 32, np.uint8)
        if self.n:
            taken = np.ones(len(buffer), bool)
            taken[self.end] = False
            buffer[taken] = LOWER[data[inside]]
            if is_break is not None:
                seen = np.concatenate([np.zeros(1, np.int64), np.cumsum(is_break[data], dtype=np.int64)])
                apart = np.ones(self.n, bool)
                apart[:-1] = seen[first[1:]] > seen[last[:-1]]
                ends_text = self.offsets[1:][np.diff(self.offsets) > 0] - 1
                apart[ends_text] = True
                buffer[self.end[apart]] = 10
        self.buffer = buffer

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))
