"""Quality rules as a short-circuit cascade.

``plan_cascade`` runs every rule on a sample of documents, measures what each
costs and how many documents it rejects, and orders the rules by rejections per
second.  ``apply_cascade`` then runs the rules in that order inside each task: a
rule only sees the documents that no earlier rule rejected.  The order changes
the work, never the verdict: a document is kept when no rule rejects it.

Defined cases: a null or blank text has no words (every count 0) and fails the
length rule; repeated rows and null ids give one result row each; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.docstats import Stats
from ledgerloom.llm.textcodes import Chunk, chunks

#: Documents in the sample that orders the rules (expected; it sets the order only).
SAMPLE_DOCS = 2000


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the counts named in ``needs`` and gives one flag per document."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


#: Integer comparisons, so that SQL states them exactly.
RULES = (
    Rule("too_short", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 50 * n),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c < 2 * n) | (c > 15 * n)),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda n, d: 2 * d > n),
    Rule("shouting", ("n_upper", "n_lower"), lambda u, lo: 2 * u > u + lo),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE = ("too_short", "repeated_words")


def cascade(chunk: Chunk, rules: tuple[Rule, ...]) -> tuple[np.ndarray, list[Stats], list[np.ndarray]]:
    """Index of the rule that rejected each document (-1: kept), and the counts gathered on the way.

    A rejected document is taken out at once: later rules neither judge it nor count anything of it.
    """
    stopped = np.full(chunk.n, -1)
    alive = np.arange(chunk.n)
    stats = Stats(chunk)
    seen, owners = [stats], [alive]
    for k, rule in enumerate(rules):
        bad = rule.rejects(*(stats.get(c) for c in rule.needs))
        stopped[alive[bad]] = k
        if bad.any() and k + 1 < len(rules):
            stats, alive = stats.subset(~bad), alive[~bad]
            seen.append(stats)
            owners.append(alive)
            if not len(alive):
                break
    return stopped, seen, owners


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_docs: int = SAMPLE_DOCS,
                 column: str = "text") -> tuple[Rule, ...]:
    """The rules in order of rejections per second, as measured on a sample."""
    total = docs.count()
    if not total:
        return rules

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in chunks(b.column(0)):
                cost, hit = [], []
                for rule in rules:
                    t = time.perf_counter()
                    bad = rule.rejects(*(Stats(chunk).get(c) for c in rule.needs))
                    cost.append(time.perf_counter() - t)
                    hit.append(float(bad.sum()))
                yield pa.RecordBatch.from_pydict({"rule": np.arange(len(rules)), "cost": cost, "hit": hit})

    sample = docs.select(column).sample(False, min(1.0, sample_docs / total), 17)
    found = {r["rule"]: (r["cost"], r["hit"]) for r in
             sample.mapInArrow(measure, "rule long, cost double, hit double")
             .groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("hit").alias("hit")).collect()}
    gain = {i: found[i][1] / max(found[i][0], 1e-9) if i in found else 0.0 for i in range(len(rules))}
    return tuple(rules[i] for i in sorted(gain, key=lambda i: (-gain[i], i)))


def apply_cascade(docs: DataFrame, rules: tuple[Rule, ...], id_column: str = "doc_id", column: str = "text",
                  complete: tuple[str, ...] = COUNTS) -> DataFrame:
    """(id, counts of ``complete``, kept, stopped_by): whole texts, one row for each input row.

    ``stopped_by`` names the rule that ended the cascade and so depends on the
    order of the rules.  Counts that the cascade skipped for rejected documents
    are filled in afterwards, for ``complete`` only.
    """
    names = [r.name for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in chunks(b.column(1)):
                stopped, seen, owners = cascade(chunk, rules)
                out = {id_column: b.column(0).slice(chunk.first, chunk.n)}
                for c in complete:
                    # Each document's count from the stage that counted it; the rest is counted now.
                    whole, known = np.zeros(chunk.n, np.int64), np.zeros(chunk.n, bool)
                    for stage, own in zip(seen, owners):
                        if stage.has(c):
                            whole[own], known[own] = stage.get(c), True
                    if not known.all():
                        whole[~known] = seen[0].subset(~known).get(c)
                    out[c] = pa.array(whole, pa.int64())
                out["kept"] = pa.array(stopped < 0)
                out["stopped_by"] = pa.array([names[k] if k >= 0 else None for k in stopped], pa.string())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    kind = docs.schema[id_column].dataType.simpleString()
    schema = ", ".join([f"`{id_column}` {kind}", *(f"{c} long" for c in complete), "kept boolean", "stopped_by string"])
    return docs.select(id_column, column).mapInArrow(run, schema)


def quality_rules(docs: DataFrame) -> DataFrame:
    """The digest of the operator: counts, ``base_failed`` and the verdict."""
    found = apply_cascade(docs, plan_cascade(docs))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", *COUNTS, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT r, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
o AS (SELECT r, i, a, lead(a) OVER z AS b, lead(a, 2) OVER z AS c FROM p WINDOW z AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS c FROM o WHERE c IS NOT NULL),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c > 1) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
k AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lo
      FROM w LEFT JOIN c USING (r) LEFT JOIN k USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
            OR 2 * up > up + lo) AS kept
FROM f
"""
