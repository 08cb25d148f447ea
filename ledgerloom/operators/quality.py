"""Load accounting and the feed's defect profile, each one aggregate pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import blank_to_null, parse_int, parse_iso_timestamp, parse_price, parse_quantity


def defect_profile(feed: DataFrame, instrument: DataFrame) -> DataFrame:
    """Per defect class, how many raw feed rows have it; ``total`` is their sum.

    Classes (a row can be in several): duplicate trade ids (rows beyond the first
    per id), null/unparseable price, quantity <= 0, instrument id unknown to the
    dimension (or unparseable), side not BUY/SELL in any case, null/unparseable
    timestamp.  The dimension is joined with a presence marker (broadcast when
    the planner sees it is small), so the feed is scanned once.
    """
    known = instrument.select("instrument_id").dropDuplicates(["instrument_id"]).withColumn("_known", F.lit(True))
    rows = feed.select(
        "trade_id",
        "side",
        parse_price(blank_to_null("price")).alias("price"),
        parse_quantity(blank_to_null("quantity")).alias("qty"),
        parse_int(blank_to_null("instrument_id")).alias("instrument_id"),
        parse_iso_timestamp(blank_to_null("executed_at")).alias("ts"),
    ).join(known, "instrument_id", "left")
    prof = rows.agg(
        (F.count(F.lit(1)) - F.count_distinct(F.coalesce("trade_id", F.lit("")))).alias("duplicate_trade_ids"),
        F.count_if(F.col("price").isNull()).alias("null_prices"),
        F.count_if(F.col("qty") <= 0).alias("non_positive_quantities"),
        F.count_if(F.col("_known").isNull()).alias("unknown_instruments"),
        F.count_if(~F.coalesce(F.upper("side").isin("BUY", "SELL"), F.lit(False))).alias("bad_sides"),
        F.count_if(F.col("ts").isNull()).alias("null_timestamps"),
    )
    parts = ["duplicate_trade_ids", "null_prices", "non_positive_quantities", "unknown_instruments",
             "bad_sides", "null_timestamps"]
    total = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    return prof.select(*parts, total.alias("total"))


def load_metrics(grouped: DataFrame, mark: dt.datetime | None) -> DataFrame:
    """LoadResult as one row, from ``ingest.collapse_batch`` output (one more tiny aggregate).

    The new mark is the max executed_at of the rows that win the collapse (a
    losing duplicate's time does not count), never below the stored mark.
    """
    upserted = F.count_if(F.col("n_candidates") > 0)
    batch_max = F.max(F.col("_last.executed_at"))
    before = F.lit(mark).cast("timestamp")
    return grouped.agg(
        F.sum("n_read").cast("long").alias("rows_read"),
        upserted.alias("rows_upserted"),
        F.sum("n_skipped").cast("long").alias("rows_skipped_by_watermark"),
        (F.sum("n_candidates") - upserted).cast("long").alias("duplicates_collapsed"),
        before.alias("watermark_before"),
        F.greatest(before, batch_max).alias("watermark_after"),
    )
