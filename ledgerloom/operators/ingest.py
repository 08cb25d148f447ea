"""Landing a feed: coercion, the high-water filter, in-batch collapse, metrics, defects."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import blank_to_null, parse_int, parse_iso_timestamp, parse_price, parse_quantity


def coerce_feed(feed: DataFrame, source_file: str | Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Six feed strings -> typed trade columns; anything unparseable becomes NULL.

    ``keep`` passes extra columns (e.g. the file-order columns) through untouched.
    """
    src = source_file if isinstance(source_file, Column) else F.lit(source_file).cast("string")
    return feed.select(
        F.coalesce(F.col("trade_id"), F.lit("")).alias("trade_id"),
        parse_int(blank_to_null("instrument_id")).alias("instrument_id"),
        blank_to_null("side").alias("side"),
        parse_quantity(blank_to_null("quantity")).alias("quantity"),
        parse_price(blank_to_null("price")).alias("price"),
        parse_iso_timestamp(blank_to_null("executed_at")).alias("executed_at"),
        src.alias("source_file"),
        *keep,
    )


def above_watermark(records: DataFrame, mark: dt.datetime | None) -> DataFrame:
    """High-water filter: drop rows with executed_at <= mark; NULL times always pass."""
    if mark is None:
        return records
    return records.where(F.col("executed_at").isNull() | (F.col("executed_at") > F.lit(mark)))


def collapse_batch(records: DataFrame, mark: dt.datetime | None, order_col: str,
                   key: str = "trade_id") -> DataFrame:
    """High-water filter and in-batch collapse in one grouped pass, with the accounting.

    One row per key of the feed: ``_last`` = the last (by ``order_col``) row that
    passes the filter (NULL when every copy was skipped), and the counts
    n_read / n_skipped / n_candidates.  The filter runs before the collapse: if
    the last copy is below the mark, the newest copy above it wins.  Every
    aggregate is partial, so a hot key is combined map-side.
    """
    skip = F.lit(False) if mark is None else (
        F.col("executed_at").isNotNull() & (F.col("executed_at") <= F.lit(mark))
    )
    values = [c for c in records.columns if c not in (key, order_col)]
    return records.withColumn("_skip", skip).groupBy(key).agg(
        F.max_by(F.struct(*values), F.when(~F.col("_skip"), F.col(order_col))).alias("_last"),
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(F.col("_skip")).alias("n_skipped"),
        F.count_if(~F.col("_skip")).alias("n_candidates"),
    )


def batch_winners(grouped: DataFrame, key: str = "trade_id") -> DataFrame:
    """The rows to upsert: one per key that kept at least one copy."""
    return grouped.where(F.col("n_candidates") > 0).select(key, "_last.*")
