"""The vectorised text helpers against plain Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.textcodes import Words, chunks, lines, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té🙂 x", max_size=25)), min_size=1, max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_lines_are_those_of_python(texts, max_bytes):
    found_words, found_lines, nulls = [], [], []
    for c in chunks(pa.array(texts, pa.string()), max_bytes):
        w = Words(c)
        spans = [c.data[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
        found_words += [spans[w.offsets[i]:w.offsets[i + 1]] for i in range(c.n)]
        per_doc = [[] for _ in range(c.n)]
        for a, b, d in zip(*lines(c)):
            per_doc[d].append(c.data[a:b].tobytes())
        found_lines += per_doc
        nulls += c.null.tolist()
    assert found_words == [(t or "").encode().split() for t in texts]
    assert found_lines == [(t or "").encode().split(b"\n") for t in texts]
    assert nulls == [t is None for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_window_hashes_agree_exactly_when_the_words_do(texts):
    seen: dict[int, tuple] = {}
    for c in chunks(pa.array(texts, pa.string())):
        w = Words(c)
        h, doc, first = windows(w.hashes(), w.offsets, 3)
        per_doc = [(t or "").encode().lower().split() for t in texts]
        assert len(h) == sum(max(len(x) - 2, min(len(x), 1)) for x in per_doc)
        for value, d, f in zip(h.tolist(), doc, first):
            at = f - w.offsets[d]
            mine = tuple(per_doc[c.first + d][at:at + 3])
            assert seen.setdefault(value, mine) == mine
    assert len(set(seen.values())) == len(seen)


def test_a_slice_of_a_column_reads_its_own_rows():
    column = pa.array(["x", "a b", None, "c"]).slice(1, 3)
    c = next(chunks(column))
    assert [c.text(i) for i in range(3)] == ["a b", "", "c"] and c.null.tolist() == [False, True, False]
    assert Words(c).counts.tolist() == [2, 0, 1]
    assert np.array_equal(c.offsets, [0, 3, 3, 4])
