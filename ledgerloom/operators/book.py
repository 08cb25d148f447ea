"""Per-instrument, per-day position and average-cost PnL (the daily book).

Semantics: valid trades, optionally from ``since`` on; per instrument in
(executed_at, trade_id) order, a SELL realises (price - average buy cost so far)
x quantity, where the average is over *all* earlier buys (never reset when
flat); a sell before any buy realises 0.  Per (instrument, day): trade count,
net quantity, realised, and the last execution's price as the mark; closing
position and end-of-day average cost run over all days so far.

Plan shape (no window is ever partitioned by instrument alone over trades, so
a hot instrument cannot serialise the job):

1. segments: (instrument, UTC day, slice).  A day is one slice, except that the
   trades of days with more than ``hot_rows`` of them are range-partitioned by
   (instrument, day, executed_at, trade_id) and every ``hot_rows`` rows of a sorted
   range are a slice, so trades of one instant are cut as well.  The cut rows are
   written once under the checkpoint folder: every later step sees the same slices.
   ``segment_micros`` instead cuts every day into slices of that width.
2. ``segment_carry``: buy cost/qty per segment - a partial aggregate, then a
   running sum over that small table gives the carry-in (everything bought in
   earlier segments).
3. ``positions``: a window partitioned by (instrument, segment) ordered by
   (executed_at, trade_id) adds the intra-segment prior buys to the carry-in;
   the same window ordering gives each segment's last price (the mark).
4. ``day_totals`` + ``running_days``: a hash aggregate per (instrument, day),
   then one running window over the (instrument, day) table for closing
   position and cumulative cost.

The sums are exact decimals, so regrouping changes no digit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..functions.coerce import utc_date
from ..session import scratch_dir


def _is_buy() -> Column:
    return F.col("side") == F.lit("BUY")


def _is_sell() -> Column:
    return F.col("side") == F.lit("SELL")


def clean_trades(valid: DataFrame, since: dt.date | None = None) -> DataFrame:
    """The valid set, optionally restricted to trade_date >= since.

    Besides the exact date predicate we add the equivalent instant bound on
    ``executed_at`` so the scan can skip row groups (the date is derived, the
    instant is a stored column).
    """
    if since is None:
        return valid
    start = dt.datetime(since.year, since.month, since.day, tzinfo=dt.timezone.utc)
    return valid.where(F.col("executed_at") >= F.lit(start)).where(F.col("trade_date") >= F.lit(since))


# A (instrument, day) with more trades than this is cut into slices of at most this many.
HOT_SEGMENT_ROWS = 1_000_000
# A task that cuts hot days takes about so many trades (or one slice, if that is more): small slices share a task.
RANGE_ROWS = 200_000
# monotonically_increasing_id: the partition above these bits, the row of the partition in them.
ROW_BITS = 33
MICROS_PER_DAY = 86_400_000_000


def busy_days(records: DataFrame, hot_rows: int = HOT_SEGMENT_ROWS) -> DataFrame:
    """(instrument_id, trade_date, n): days with more than ``hot_rows`` of these records, duplicates and invalid ones counted too.

    For ``hot_days`` below, where the landed records are cheaper to count than the trades made of them.
    """
    days = records.groupBy("instrument_id", utc_date("executed_at").alias("trade_date")).agg(F.count(F.lit(1)).alias("n"))
    return days.where(F.col("n") > hot_rows)


COST10, QTY4 = money.COST, "decimal(28,4)"  # narrowed so adding two sums keeps the scale


def opening_book(valid: DataFrame, since: dt.date) -> DataFrame:
    """Everything before ``since`` that later days depend on, one row per instrument.

    Trades seen, buy cost, buy quantity and net position: one partial aggregate
    over history - no window, no sort, no shuffle of trade rows - so a run from
    ``since`` with carry-in costs a scan of history plus the book of recent days.
    """
    start = dt.datetime(since.year, since.month, since.day, tzinfo=dt.timezone.utc)
    hist = _legs(valid.where(F.col("executed_at") < F.lit(start)).where(F.col("trade_date") < F.lit(since)))
    return hist.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("open_n"),
        F.sum("buy_cost").cast(COST10).alias("open_cost"),
        F.sum("buy_qty").cast(QTY4).alias("open_qty"),
        F.sum("signed_qty").cast(QTY4).alias("open_pos"),
    )


def opening_from_days(days: DataFrame, since: dt.date) -> DataFrame:
    """The opening book from stored day sums (``daily_pnl`` rows with ``DAY_SUMS``): no trade is read."""
    return opening_of_days(days.where(F.col("pnl_date") < F.lit(since)))


def opening_of_days(earlier: DataFrame) -> DataFrame:
    """The opening book that these stored days make, one row per instrument."""
    return earlier.groupBy("instrument_id").agg(
        F.sum("trade_count").alias("open_n"),
        F.sum(DAY_SUMS[1]).cast(COST10).alias("open_cost"),
        F.sum(DAY_SUMS[2]).cast(QTY4).alias("open_qty"),
        F.sum(DAY_SUMS[0]).cast(QTY4).alias("open_pos"),
    )


def _with_opening(df: DataFrame, opening: DataFrame | None) -> DataFrame:
    """Attach the opening book (zeros when there is none)."""
    if opening is None:
        return df.select(
            "*", F.lit(0).cast("long").alias("open_n"), F.lit(0).cast(COST10).alias("open_cost"),
            F.lit(0).cast(QTY4).alias("open_qty"), F.lit(0).cast(QTY4).alias("open_pos"),
        )
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("open_n", "open_cost", "open_qty", "open_pos")]
    return df.join(opening, "instrument_id", "left").select(*df.columns, *filled)


def _legs(clean: DataFrame) -> DataFrame:
    q, p = F.col("quantity"), F.col("price")
    return clean.select(
        "instrument_id",
        "trade_date",
        "trade_id",
        "side",
        "quantity",
        "price",
        "executed_at",
        F.when(_is_buy(), q).otherwise(-q).alias("signed_qty"),
        F.when(_is_buy(), q * p).otherwise(F.lit(0)).alias("buy_cost"),
        F.when(_is_buy(), q).otherwise(F.lit(0)).alias("buy_qty"),
    )


def _segmented(legs: DataFrame, segment_micros: int | None, hot_rows: int | None,
               hot_days: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """Add the ``slice`` of the UTC day each trade falls in; segments are (day, slice).

    Fixed ``segment_micros``: slice = floor(micros of the day / width), for every day.
    Default: slice 0 (the whole day) except for the trades of hot days, whose slice is
    their place in (instrument, day, executed_at, trade_id) order, by range and ``hot_rows``
    rows of it; how many tasks do that follows from the trades, not from the slices.  ``hot_days``
    (instrument_id, trade_date, n) names them, as counted when the trades were stored;
    without it they are found by one aggregate when the plan is made (``hot_rows=None``
    skips both, for data known not to be skewed).
    """
    order = ["trade_date", "slice"]
    if segment_micros is not None:
        micros_of_day = F.pmod(F.unix_micros("executed_at"), F.lit(MICROS_PER_DAY))
        return legs.select("*", F.floor(micros_of_day / F.lit(segment_micros)).cast("long").alias("slice")), order
    plain = legs.select("*", F.lit(0).cast("long").alias("slice"))
    if hot_rows is None:
        return plain, order
    day = ["instrument_id", "trade_date"]
    hot = hot_days
    if hot is None:
        hot = legs.groupBy(*day).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    total = hot.agg(F.sum("n")).first()[0]
    if not total:
        return plain, order
    in_order = [*day, "executed_at", "trade_id"]
    ranges = max(2, -(-total // max(hot_rows, RANGE_ROWS)))
    place = F.col("_place")
    first = F.shiftleft(F.shiftright(place, ROW_BITS), ROW_BITS)
    cut = (legs.join(hot.select(*day), day, "left_semi").repartitionByRange(ranges, *in_order).sortWithinPartitions(*in_order)
           .withColumn("_place", F.monotonically_increasing_id())
           .withColumn("slice", first + F.floor((place - first) / F.lit(hot_rows)).cast("long")).select(*plain.columns))
    path = scratch_dir(legs.sparkSession, "hot-days")
    cut.write.parquet(path)
    cut = legs.sparkSession.read.schema(cut.schema).parquet(path)
    return plain.join(hot.select(*day), day, "left_anti").select(*plain.columns).unionByName(cut), order


def segment_carry(legs: DataFrame, order: list[str], opening: DataFrame | None = None) -> DataFrame:
    """Trades and buys strictly before each (instrument, segment): one row per segment.

    ``opening`` (from ``opening_book``) adds what happened before the first segment.
    """
    before = Window.partitionBy("instrument_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = legs.groupBy("instrument_id", *order).agg(
        F.count(F.lit(1)).alias("seg_n"), F.sum("buy_cost").alias("seg_cost"), F.sum("buy_qty").alias("seg_qty")
    )
    running = totals.select(
        "instrument_id",
        *order,
        F.coalesce(F.sum("seg_n").over(before), F.lit(0)).alias("run_n"),
        F.coalesce(F.sum("seg_cost").over(before), F.lit(0)).cast(COST10).alias("run_cost"),
        F.coalesce(F.sum("seg_qty").over(before), F.lit(0)).cast(QTY4).alias("run_qty"),
    )
    return _with_opening(running, opening).select(
        "instrument_id",
        *order,
        (F.col("open_n") + F.col("run_n")).alias("carry_n"),
        (F.col("open_cost") + F.col("run_cost")).alias("carry_cost"),
        (F.col("open_qty") + F.col("run_qty")).alias("carry_qty"),
    )


def positions(clean: DataFrame, segment_micros: int | None = None,
              hot_rows: int | None = HOT_SEGMENT_ROWS, opening: DataFrame | None = None,
              hot_days: DataFrame | None = None) -> DataFrame:
    """P2 + P3, one row per trade: signed quantity, prior buy cost / quantity, realised.

    ``prior_buy_cost`` / ``prior_buy_qty`` are NULL on an instrument's first trade
    (the frame is empty), like a window over an empty frame.  ``segment_close``
    is the price of the segment's last execution (the same window ordering, so
    the same sort) and ``segment_rank`` orders segments within a day.
    """
    legs, order = _segmented(_legs(clean), segment_micros, hot_rows, hot_days)
    keys = ["instrument_id", *order]
    ordered = Window.partitionBy(*keys).orderBy("executed_at", "trade_id")
    within = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = legs.select(
        "*",
        F.count(F.lit(1)).over(within).alias("intra_n"),
        F.sum("buy_cost").over(within).alias("intra_cost"),
        F.sum("buy_qty").over(within).alias("intra_qty"),
        F.last("price").over(whole).alias("segment_close"),
    ).join(segment_carry(legs, order, opening), keys)
    empty_frame = (F.col("carry_n") + F.col("intra_n")) == 0
    # Narrow before adding: two decimal(38,10) sums would make Spark drop to scale 9.
    prior_cost = F.when(
        ~empty_frame,
        F.col("carry_cost").cast(COST10) + F.coalesce(F.col("intra_cost"), F.lit(0)).cast(COST10),
    )
    prior_qty = F.when(
        ~empty_frame,
        F.col("carry_qty").cast(QTY4) + F.coalesce(F.col("intra_qty"), F.lit(0)).cast(QTY4),
    )
    rows = rows.select("*", prior_cost.alias("prior_buy_cost"), prior_qty.alias("prior_buy_qty"))
    rows = money.add_realised(rows, "realised_pnl", "price", "quantity", "prior_buy_cost", "prior_buy_qty", _is_sell())
    return rows.select(
        "instrument_id",
        "trade_date",
        "trade_id",
        "side",
        "quantity",
        "price",
        "executed_at",
        "signed_qty",
        "buy_cost",
        "buy_qty",
        "prior_buy_cost",
        "prior_buy_qty",
        "realised_pnl",
        "segment_close",
        F.col("slice").alias("segment_rank"),
    )


def day_totals(pos: DataFrame) -> DataFrame:
    """P4 + P6 + the inner sums of P7, one aggregate per (instrument, day).

    Every buffer is fixed-width, so this is a hash aggregate (partial per
    segment, then a small shuffle); the mark is the close of the day's last segment.
    """
    return pos.groupBy("instrument_id", "trade_date").agg(
        F.count(F.lit(1)).cast("int").alias("trade_count"),
        F.sum("signed_qty").alias("net_qty"),
        F.sum("realised_pnl").alias("realised_pnl"),
        F.max_by("segment_close", "segment_rank").alias("close_price"),
        F.sum("buy_cost").alias("day_buy_cost"),
        F.sum("buy_qty").alias("day_buy_qty"),
    )


def running_days(days: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """P5 + P7: closing position and cumulative buys through each day (plus the opening book)."""
    upto = Window.partitionBy("instrument_id").orderBy("trade_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    run = days.select(
        "*",
        F.sum("net_qty").over(upto).cast(QTY4).alias("_run_pos"),
        F.sum("day_buy_cost").over(upto).cast(COST10).alias("_run_cost"),
        F.sum("day_buy_qty").over(upto).cast(QTY4).alias("_run_qty"),
    )
    if opening is None:
        return run.withColumnsRenamed(
            {"_run_pos": "closing_position", "_run_cost": "cum_buy_cost", "_run_qty": "cum_buy_qty"}
        )
    return _with_opening(run, opening).select(
        *days.columns,
        (F.col("open_pos") + F.col("_run_pos")).alias("closing_position"),
        (F.col("open_cost") + F.col("_run_cost")).alias("cum_buy_cost"),
        (F.col("open_qty") + F.col("_run_qty")).alias("cum_buy_qty"),
    )


def _valued(run: DataFrame) -> DataFrame:
    """``run`` with ``unrealised_pnl`` at scale 10 and ``avg_cost`` (NULL before the first buy)."""
    run = money.add_unrealised(run, "unrealised_pnl", "close_price", "cum_buy_cost", "cum_buy_qty", "closing_position")
    return money.add_average(run, "avg_cost", "cum_buy_cost", "cum_buy_qty")


def wide_days(valid: DataFrame) -> DataFrame:
    """The daily book before its values are narrowed to the column scales of ``daily_pnl``."""
    run = _valued(running_days(day_totals(positions(valid))))
    return run.select("instrument_id", "trade_date", "trade_count", "closing_position", "cum_buy_cost",
                      F.col("realised_pnl").cast(money.SCALE10).alias("realised_pnl"), "unrealised_pnl",
                      money.to_price(F.col("avg_cost")).alias("avg_cost"))


DAY_SUMS = ("day_net_qty", "day_buy_cost", "day_buy_qty")


def finish(run: DataFrame, with_sums: bool = False) -> DataFrame:
    """The daily_pnl projection, values rounded once to the column scales.

    ``with_sums`` adds what a later opening book needs of the day (``DAY_SUMS``).
    """
    return _valued(run).select(
        F.col("trade_date").alias("pnl_date"),
        "instrument_id",
        "trade_count",
        money.to_qty(F.col("closing_position")).alias("closing_position"),
        money.to_price(F.col("avg_cost")).alias("avg_cost"),
        money.to_price(F.col("close_price")).alias("close_price"),
        money.to_price(F.col("realised_pnl")).alias("realised_pnl"),
        money.to_price(F.col("unrealised_pnl")).alias("unrealised_pnl"),
        F.current_timestamp().alias("computed_at"),
        *((F.col("net_qty").cast(QTY4).alias(DAY_SUMS[0]), F.col("day_buy_cost").cast(COST10).alias(DAY_SUMS[1]),
           F.col("day_buy_qty").cast(QTY4).alias(DAY_SUMS[2])) if with_sums else ()),
    )


def daily_pnl(
    valid: DataFrame,
    since: dt.date | None = None,
    *,
    carry_in: bool = False,
    segment_micros: int | None = None,
    hot_rows: int | None = HOT_SEGMENT_ROWS,
    hot_days: DataFrame | None = None,
    opening: DataFrame | None = None,
    with_sums: bool = False,
) -> DataFrame:
    """The daily_pnl rows for a set of valid trades.

    ``carry_in=False`` is the reference behaviour: trades before ``since`` are
    ignored, so positions and average cost restart from zero at ``since``.
    ``carry_in=True`` equals the full run restricted to the days >= since, but
    computes it as an opening book plus the book of the recent trades only.  The
    opening book is ``opening`` if given (``opening_from_days``), else one
    aggregate over the earlier trades.
    """
    clean = clean_trades(valid, since)
    if not carry_in or since is None:
        opening = None
    elif opening is None:
        opening = opening_book(valid, since)
    days = day_totals(positions(clean, segment_micros, hot_rows, opening, hot_days))
    return finish(running_days(days, opening), with_sums)


def days_after(clean: DataFrame, opening: DataFrame, hot_rows: int | None = None, hot_days: DataFrame | None = None) -> DataFrame:
    """The daily_pnl rows, with the day sums, of trades that come after an opening book; each instrument may start on its own day."""
    days = day_totals(positions(clean, None, hot_rows, opening, hot_days))
    return finish(running_days(days, opening), with_sums=True)
