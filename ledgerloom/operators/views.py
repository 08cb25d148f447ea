"""Analytic views over daily_pnl: running totals and the monthly ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUNNING_COLUMNS = (
    "pnl_date", "instrument_id", "symbol", "asset_class", "trade_count", "closing_position",
    "avg_cost", "close_price", "realised_pnl", "unrealised_pnl", "cumulative_realised_pnl", "total_pnl",
)


def _with_instrument(daily: DataFrame, instrument: DataFrame) -> DataFrame:
    # Inner join: rows of instruments missing from the dimension drop out.
    return daily.join(instrument.select("instrument_id", "symbol", "asset_class"), "instrument_id")


def running_pnl(daily: DataFrame, instrument: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """v_running_pnl: cumulative realised per instrument; total = that + the day's unrealised.

    Unrealised is a point-in-time mark, never summed.  The window partitions by
    (instrument_id, symbol) - symbol is unique per instrument, so the frame is
    the same, but a symbol filter above the view can then be pushed below the
    window to the dimension scan.  One instrument has at most one row per day,
    so no partition grows with trade volume.  ``before`` (instrument_id, realised_before)
    is what each instrument realised ahead of the first day in ``daily``.
    """
    w = Window.partitionBy("instrument_id", "symbol").orderBy("pnl_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cum = F.sum("realised_pnl").over(w)
    rows = _with_instrument(daily, instrument)
    if before is not None:
        rows = rows.join(before, "instrument_id", "left")
        cum = (cum + F.coalesce("realised_before", F.lit(0).cast("decimal(28,6)"))).cast("decimal(28,6)")
    return rows.select(
        *RUNNING_COLUMNS[:-2],
        cum.alias("cumulative_realised_pnl"),
        (cum + F.col("unrealised_pnl")).alias("total_pnl"),
    )


def _coarse(value: Column) -> Column:
    """A number that never falls as ``value`` rises: sign, length and leading digits of the value."""
    digits = F.abs(value * 1_000_000).cast("decimal(38,0)").cast("string")
    size = F.length(digits) * 1000 + F.rpad(F.substring(digits, 1, 3), 3, "0").cast("int")
    return F.when(value < 0, -size).when(value == 0, F.lit(0)).otherwise(size)


def top_instruments_by_month(daily: DataFrame, instrument: DataFrame, at_most: int | None = None) -> DataFrame:
    """v_top_instruments_by_month: monthly realised and trade count, RANK() by realised desc.

    Ties share a rank and the next rank skips (RANK, not DENSE_RANK).  The rank is
    found in two levels, so no window holds a whole month: the rows of coarser
    buckets above, then the greater values inside the bucket.  With ``at_most``
    only ranks up to it are wanted; a plain rank window is then cut to so many rows
    per task before its shuffle.
    """
    monthly = (
        _with_instrument(daily, instrument)
        .groupBy(F.trunc("pnl_date", "MM").alias("month"), "instrument_id", "symbol", "asset_class")
        .agg(F.sum("realised_pnl").alias("realised_pnl"), F.sum("trade_count").alias("trade_count"))
    )
    if at_most is not None:
        w = Window.partitionBy("month").orderBy(F.desc("realised_pnl"))
        return monthly.select("*", F.rank().over(w).cast("long").alias("pnl_rank")).where(F.col("pnl_rank") <= at_most)
    values = monthly.groupBy("month", "realised_pnl").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "bucket", _coarse(F.col("realised_pnl")))
    above = Window.partitionBy("month").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = values.groupBy("month", "bucket").agg(F.sum("n").alias("n")).select(
        "month", "bucket", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))
    greater = Window.partitionBy("month", "bucket").orderBy(F.desc("realised_pnl")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = values.withColumn("greater", F.coalesce(F.sum("n").over(greater), F.lit(0))).join(buckets, ["month", "bucket"])
    rank = (F.col("above") + F.col("greater") + 1).cast("long").alias("pnl_rank")
    return monthly.join(ranks.select("month", "realised_pnl", rank), ["month", "realised_pnl"]).select(*monthly.columns, "pnl_rank")
