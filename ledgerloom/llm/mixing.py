"""Mixing sources to target weights: tempered shares realised as permutations of blocks.

``exponent`` finds the flattest mixture w ~ share**a that meets a repetition
limit or an entropy target: a is a multiple of 2**-20, and each job evaluates
the fifteen inner nodes of a four-level bisection over the table of sources.
``mix`` turns weights into token budgets and each budget into passes over the
source: documents are dealt to blocks of about ``BLOCK_TOKENS``, every pass has
its own permutation of the blocks, and the last pass stops at the budget.

Without a given budget the mixture takes the least one at which every source is
used in full at least once, so no document with a word is dropped and small sources repeat up to
the limit.  Only sizes per source and per block are ever brought together; the
running sums over blocks go by buckets of blocks, so no task holds all blocks of
a hot source.

Defined cases: null and blank texts have no tokens but stay in their block (one
that holds nothing else is left out if it comes last in a used-up budget); a
source without any token takes no part; a null source is a source of its own;
null ids are dealt like an empty id; rows with one id go to one block, each as a
row of its own; an empty table gives an empty mixture; other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import fresh, materialize
from ledgerloom.llm.textcodes import Words, chunks

BLOCK_TOKENS = 1 << 14
#: Most passes over a source in the production mixture.
MAX_REPETITION = 2.0
SEED = "mix-1"
_GRID = 1 << 20
_BUCKET_BLOCKS = 256


def count_words(docs: DataFrame, columns: list[Column], column: Column) -> DataFrame:
    """``columns`` and, last, ``n_tokens``: the words of the text, none for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [Words(c).counts for c in chunks(b.column(b.num_columns - 1))]
            n = pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*b.schema.names[:-1], "n_tokens"])

    given = docs.select(*columns, column.cast("string"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])
    return given.mapInArrow(run, schema)


def _draw(*parts: Column) -> Column:
    """32 bits of a digest of the parts, as a long."""
    text = F.concat_ws("|", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def exponent(sizes: DataFrame, max_repetition: float | None = MAX_REPETITION, target_entropy: float | None = None,
             budget: int | None = None) -> float:
    """The least a in [0, 1] whose mixture meets the limits; 1 (plain shares) if none does.

    ``sizes``: one row per source with a positive ``tokens``.  ``target_entropy``
    is in nats and bounds the entropy of the mixture from above.
    """
    total = sizes.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    shares = sizes.select((F.col("tokens") / F.lit(float(total))).alias("p"))
    low, high = 0, _GRID
    while low < high:
        tries = sorted({low + (high - low) * k // 16 for k in range(16)})
        found = shares.agg(*(c for k in tries for a in [k / _GRID] for c in (
            F.sum(F.pow("p", F.lit(a))).alias(f"z{k}"), F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"l{k}"),
            F.max(F.pow("p", F.lit(a - 1))).alias(f"x{k}"), F.min(F.pow("p", F.lit(a - 1))).alias(f"n{k}")))).first()

        def meets(k: int) -> bool:
            z, a = found[f"z{k}"], k / _GRID
            passes = found[f"x{k}"] / found[f"n{k}"] if budget is None else found[f"x{k}"] / z * budget / total
            entropy = math.log(z) - a * found[f"l{k}"] / z
            return (max_repetition is None or passes <= max_repetition) and (
                target_entropy is None or entropy <= target_entropy)

        good = next((k for k in tries if meets(k)), high)
        low, high = max([low, *(k + 1 for k in tries if k < good)]), good
    return high / _GRID


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def plan_mixture(measured: DataFrame, max_repetition: float | None, target_entropy: float | None,
                 budget: int | None) -> tuple[DataFrame, DataFrame]:
    """From (id, k, n_tokens): the sources (k, blocks) and the passes (k, block, epoch, block_start, source_budget)."""
    sizes = materialize(measured.groupBy("k").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "sources")
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    a = exponent(sizes, max_repetition, target_entropy, budget)
    weight = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a))
    scale = sizes.agg(F.sum(weight), F.max(F.col("tokens") / weight)).first()
    each = (scale[1] if budget is None else budget / scale[0]) if total else 0.0
    plan = sizes.select("k", "tokens", F.round(weight * F.lit(float(each))).cast("long").alias("limit"),
                        F.ceil(F.col("tokens") / BLOCK_TOKENS).cast("long").alias("blocks"))
    held = (measured.join(plan, "k").groupBy("k", _block().alias("block"))
            .agg(F.sum("n_tokens").alias("in_block")).join(plan, "k"))
    passes = held.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor((F.col("limit") - 1) / F.col("tokens")).cast("int"))))
    passes = passes.withColumn("draw", _draw(F.col("k"), F.col("block"), F.col("epoch")))
    passes = passes.withColumn("bucket", F.shiftright(F.col("draw") * F.ceil(F.col("blocks") / _BUCKET_BLOCKS), 32))
    bucket = ["k", "epoch", "bucket"]
    before = F.coalesce(F.sum("in_bucket").over(
        W.partitionBy("k", "epoch").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    buckets = passes.groupBy(*bucket).agg(F.sum("in_block").alias("in_bucket")).select(*bucket, before.alias("before"))
    inside = F.coalesce(F.sum("in_block").over(
        W.partitionBy(*bucket).orderBy("draw", "block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    taken = (passes.join(buckets, bucket)
             .withColumn("block_start", F.col("epoch") * F.col("tokens") + F.col("before") + inside)
             .where("block_start < limit").select("k", "block", "epoch", "block_start", F.col("limit").alias("source_budget")))
    return plan.select("k", "blocks"), taken


def _block() -> Column:
    """The block of a row: its id decides."""
    return F.shiftright(_draw(F.col("id")) * F.col("blocks"), 32)


def mix(docs: DataFrame, max_repetition: float | None = MAX_REPETITION, target_entropy: float | None = None,
        budget: int | None = None, id_column: str = "doc_id", column: str = "text", source_column: str = "source") -> DataFrame:
    """The columns of ``docs``, once per pass that takes the row, with n_tokens, epoch, block, block_start, source_budget.

    ``block_start`` counts the source's tokens before the block over all passes;
    ordering by ``block_start / source_budget`` interleaves the sources.
    """
    own = [F.col(id_column).alias("id"), _source_key(F.col(source_column)).alias("k")]
    measured = materialize(count_words(docs, own, F.col(column)), "measured")
    sources, taken = plan_mixture(measured, max_repetition, target_entropy, budget)
    whole = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    rows = count_words(docs, [whole, *own], F.col(column)).join(sources, "k").withColumn("block", _block())
    out = rows.join(taken, ["k", "block"])
    extra = (F.col(c).alias(fresh(docs, c)) for c in ("n_tokens", "epoch", "block", "block_start", "source_budget"))
    return out.select("row.*", *extra)


def mixed_sources(docs: DataFrame) -> DataFrame:
    """The production mixture of ids, without the texts."""
    own = [F.col("doc_id").alias("id"), _source_key(F.col("source")).alias("k"), F.col("source")]
    measured = materialize(count_words(docs, own, F.col("text")), "measured")
    sources, taken = plan_mixture(measured, MAX_REPETITION, None, None)
    rows = measured.join(sources, "k").withColumn("block", _block())
    return rows.join(taken, ["k", "block"]).select(
        F.col("id").alias("doc_id"), "source", "n_tokens", "epoch", "block", "block_start", "source_budget")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS k, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
  FROM documents),
s AS (SELECT k, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY k HAVING sum(n_tokens) > 0),
t AS (SELECT sum(tokens)::DOUBLE AS total, max(tokens)::DOUBLE AS most, min(tokens)::DOUBLE AS least FROM s),
a(lo, hi) AS (
  SELECT 0, 1048576
  UNION ALL
  SELECT CASE WHEN pow(most / least, 1 - mid / 1048576.0::DOUBLE) <= 2 THEN lo ELSE mid + 1 END,
         CASE WHEN pow(most / least, 1 - mid / 1048576.0::DOUBLE) <= 2 THEN mid ELSE hi END
  FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM a WHERE lo < hi), t),
e AS (SELECT min(hi) / 1048576.0::DOUBLE AS x FROM a),
w AS (SELECT k, tokens, pow(tokens / total, x) AS w FROM s, t, e),
p AS (SELECT k, tokens, round(w * (SELECT max(tokens / w) FROM w))::BIGINT AS source_budget,
             ceil(tokens / 16384.0)::BIGINT AS blocks FROM w),
b AS (SELECT d.*, tokens, source_budget, blocks,
             (('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT * blocks) >> 32 AS block
      FROM d JOIN p USING (k)),
h AS (SELECT k, block, any_value(tokens) AS tokens, any_value(source_budget) AS source_budget, sum(n_tokens)::BIGINT AS in_block
      FROM b GROUP BY k, block),
q AS (SELECT *, unnest(range(0, (source_budget - 1) // tokens + 1)) AS epoch FROM h),
o AS (SELECT *, ('0x' || substr(md5('mix-1|' || k || '|' || block || '|' || epoch), 1, 8))::BIGINT AS draw FROM q),
r AS (SELECT k, block, epoch, (epoch * tokens + coalesce(sum(in_block) OVER (
             PARTITION BY k, epoch ORDER BY draw, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS block_start,
             source_budget AS cap FROM o)
SELECT doc_id, source, n_tokens, epoch, block, block_start, source_budget
FROM b JOIN r USING (k, block) WHERE block_start < cap
"""
