"""Keeping one row per key: in-batch collapse and latest-version reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse_duplicates(records: DataFrame, key: str = "trade_id", order_col: str = "feed_order",
                        count_col: str | None = None) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order_col`` (last in file order).

    A grouped ``max_by`` over a struct of the row: partial aggregation combines a
    hot key map-side, so a key holding a third of the rows costs one small
    shuffle record per map task, never one giant task.  ``dropDuplicates`` is
    not used - it keeps an arbitrary survivor.  ``count_col`` optionally adds
    how many copies each key had.
    """
    others = [c for c in records.columns if c not in (key,)]
    aggs = [F.max_by(F.struct(*others), F.col(order_col)).alias("_last")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = records.groupBy(key).agg(*aggs)
    cols = [key] + [F.col(f"_last.{c}").alias(c) for c in others]
    if count_col:
        cols.append(count_col)
    return out.select(*cols)
