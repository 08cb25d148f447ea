"""Inputs with everything that may go wrong in a column, and their empty twins."""

from __future__ import annotations

import random

import pytest

from ledgerloom.llm.common import ship

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, score double, n_tokens int, key string, "
        "item string, component long, block string, epoch string, digest string, keys string, gone string, line_key int, "
        "n_lines int, draw int, k int, label int, mix_key string, cls string")
CLASHES = (0.5, 7, "k", "i", 3, "b", "e", "d", "ks", "g", 1, 2, 3, 4, 5, "m", "c")
BENCHMARK = "item_id long, text string, score double"
LABELS = "doc_id long, quality int, toxic int, text string"


def words(seed: int, n: int, alphabet: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


LONG = "\n".join(words(k, 40) for k in range(800))
PLAIN = words(5000, 120)
ITEM = words(6000, 30)

NASTY = [
    (1, PLAIN, "en", "a"),
    (1, PLAIN, "en", "a"),  # a repeated row
    (2, None, "en", "a"),
    (None, words(5001, 60), "de", "b"),
    (None, None, None, None),
    (3, "", "en", ""),
    (4, " \n\t \r\n", "en", "a"),
    (5, "Word", "en", None),
    (6, LONG, "en", "a"),
    (7, LONG, None, "b"),  # a copy under another id
    (8, "日本語 🙂 <|endoftext|> ### x", "ja", "b"),
    (9, words(5002, 50) + "\n" + ITEM + "\n" + words(5003, 50), "de", "a"),
    (10, words(5001, 60) + " tail", "de", "b"),
    (11, "!!! ??? 123", "en", "b"),
    (12, "one two three four five", "en", "a"),
    (13, "ONE two three four FIVE", "en", "a"),
]


def frame(spark, rows):
    data = [(i, t, lang, src, None if t is None else len(t), *CLASHES) for i, t, lang, src in rows]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def nasty(llm):
    return frame(llm, NASTY).repartition(3)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(llm):
    rows = [(i, i % 2, int(i % 3 == 0), None) for i in range(1, 14)]
    return llm.createDataFrame(rows + [(1, 1, 0, "x"), (2, None, None, None), (None, 1, 1, None), (999, 0, 1, None)], LABELS)


@pytest.fixture(scope="session")
def no_labels(llm):
    return llm.createDataFrame([], LABELS)


@pytest.fixture(scope="session")
def benchmark_items(llm):
    return llm.createDataFrame([(1, ITEM, 0.1), (2, None, None), (3, "", 0.2), (4, "too short", 0.3), (5, ITEM, 0.4),
                                (None, words(6001, 20), 0.5)], BENCHMARK)


@pytest.fixture(scope="session")
def no_items(llm):
    return llm.createDataFrame([], BENCHMARK)
