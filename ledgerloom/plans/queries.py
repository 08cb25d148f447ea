"""The registered queries: one per operator of the survey, each (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import utc_wallclock
from ..operators import book as _book
from ..operators import ingest as _ingest
from ..operators import merge as _merge
from ..operators import quality as _quality
from ..operators import views as _views
from ..operators import watermark as _wm
from ..operators.dedup import collapse_duplicates as _collapse
from ..operators.instruments import seed_instruments as _seed
from ..operators.valid import invalid_trades as _invalid
from ..session import scratch_dir as _scratch
from ..sources import derived as _derived
from ..sources import feed_csv as _csv
from . import jobs as _jobs
from . import serve as _serve
from . import workloads as W

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall clock (zone-free); run-time stamps dropped."""
    df = W.drop_volatile(df)
    cols = [
        utc_wallclock(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


@register("valid_trades")
def q_valid_trades(spark, sf):
    return comparable(W.events_valid(spark, sf))


@register("daily_pnl")
def q_daily_pnl(spark, sf):
    return comparable(W.events_daily_pnl(spark, sf))


@register("daily_pnl_lineitem")
def q_daily_pnl_lineitem(spark, sf):
    return comparable(W.lineitem_daily_pnl(spark, sf))


# ------------------------------------------------------------------ ingest


UTC = _dt.timezone.utc
# Fixed parameters of the registered queries.
EVENTS_MARK = _dt.datetime(2024, 1, 15, tzinfo=UTC)
LINEITEM_MARK = _dt.datetime(1998, 6, 30, tzinfo=UTC)
LINEITEM_SPLIT = _dt.datetime(1998, 1, 1, tzinfo=UTC)
SINCE = _dt.date(2024, 1, 16)
SYMBOL = "AAAAAD"  # instrument 3 of the events dimension (an FX-shaped symbol)
RUN_START, RUN_END = _dt.date(2024, 1, 5), _dt.date(2024, 1, 20)
TOP_MONTH = _dt.date(2024, 1, 15)
HOUR_MICROS = 3_600_000_000


@register("coerce_feed")
def q_coerce_feed(spark, sf):
    return comparable(W.events_trades(spark, sf))


@register("watermark_filter")
def q_watermark_filter(spark, sf):
    return comparable(_ingest.above_watermark(W.events_trades(spark, sf), EVENTS_MARK))


@register("collapse_duplicates")
def q_collapse_duplicates(spark, sf):
    return comparable(W.lineitem_trades(spark, sf))


@register("load_metrics")
def q_load_metrics(spark, sf):
    grouped = _ingest.collapse_batch(W.lineitem_records(spark, sf), LINEITEM_MARK, "feed_order")
    return comparable(_quality.load_metrics(grouped, LINEITEM_MARK))


@register("advance_watermark")
def q_advance_watermark(spark, sf):
    marks = _wm.marks_frame(spark, {
        "trades_csv": {"watermark_at": LINEITEM_MARK, "rows_loaded": 1000},
        "other_feed": {"watermark_at": _dt.datetime(2001, 1, 1, tzinfo=UTC), "rows_loaded": 5},
    })
    grouped = _ingest.collapse_batch(W.lineitem_records(spark, sf), LINEITEM_MARK, "feed_order")
    return comparable(_wm.advance(marks, _ingest.batch_winners(grouped), "trades_csv"))


def _lineitem_batches(spark, sf):
    recs = W.lineitem_records(spark, sf)
    before = F.coalesce(F.col("executed_at") < F.lit(LINEITEM_SPLIT), F.lit(False))
    first, second = recs.where(before), recs.where(~before)
    landed = [
        _collapse(b, order_col="feed_order").drop("feed_order").withColumn("ingested_at", F.current_timestamp())
        for b in (first, second)
    ]
    return landed


@register("upsert_trades")
def q_upsert_trades(spark, sf):
    target, source = _lineitem_batches(spark, sf)
    return comparable(_merge.merge_upsert(target, source, ["trade_id"], keep_first=["ingested_at"]))


@register("upsert_instruments")
def q_upsert_instruments(spark, sf):
    return _merge.merge_upsert(W.events_instruments(spark, sf), _seed(spark), ["instrument_id"])


@register("upsert_daily_pnl")
def q_upsert_daily_pnl(spark, sf):
    valid = W.events_valid(spark, sf)
    full = _book.daily_pnl(valid)
    since = _book.daily_pnl(valid, SINCE)
    return comparable(_merge.merge_upsert(full, since, ["pnl_date", "instrument_id"]))


@register("classify_instruments")
def q_classify_instruments(spark, sf):
    return W.events_instruments(spark, sf)


@register("defect_profile")
def q_defect_profile(spark, sf):
    return _quality.defect_profile(_derived.events_feed(spark, sf), W.events_instruments(spark, sf))


@register("defect_profile_lineitem")
def q_defect_profile_lineitem(spark, sf):
    return _quality.defect_profile(_derived.lineitem_feed(spark, sf), W.lineitem_instruments(spark))


@register("invalid_trades")
def q_invalid_trades(spark, sf):
    return comparable(_invalid(W.events_trades(spark, sf), W.events_instruments(spark, sf)))


# ------------------------------------------------------------------ the book stages

def _events_positions(spark, sf):
    return _book.positions(W.events_valid(spark, sf))


@register("trade_positions")
def q_trade_positions(spark, sf):
    return _events_positions(spark, sf).select(
        "instrument_id", "trade_date", "trade_id", "side", "quantity", "price",
        "signed_qty", "prior_buy_cost", "prior_buy_qty",
    )


@register("trade_realised")
def q_trade_realised(spark, sf):
    return _events_positions(spark, sf).select("trade_id", "instrument_id", "trade_date", "realised_pnl")


def _events_days(spark, sf):
    return _book.running_days(_book.day_totals(_events_positions(spark, sf)))


@register("daily_net")
def q_daily_net(spark, sf):
    return _events_days(spark, sf).select("instrument_id", "trade_date", "trade_count", "net_qty", "realised_pnl")


@register("closing_position")
def q_closing_position(spark, sf):
    return _events_days(spark, sf).select(
        "instrument_id", "trade_date", F.col("closing_position").cast("decimal(18,4)").alias("closing_position")
    )


@register("daily_marks")
def q_daily_marks(spark, sf):
    return _events_days(spark, sf).select("instrument_id", "trade_date", "close_price")


@register("eod_cost")
def q_eod_cost(spark, sf):
    return _events_days(spark, sf).select("instrument_id", "trade_date", "cum_buy_cost", "cum_buy_qty")


@register("daily_pnl_since")
def q_daily_pnl_since(spark, sf):
    return comparable(W.events_daily_pnl(spark, sf, since=SINCE))


@register("daily_pnl_since_carry")
def q_daily_pnl_since_carry(spark, sf):
    return comparable(W.events_daily_pnl(spark, sf, since=SINCE, carry_in=True))


@register("daily_pnl_lineitem_since_carry")
def q_daily_pnl_lineitem_since_carry(spark, sf):
    """Through the store: a full run, then a carry-in run from 2000-01-01 whose opening book is the stored day sums."""
    store = _jobs.create_schema(spark)
    _jobs.upsert_instruments(store, W.lineitem_instruments(spark))
    records = _derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", _csv.FEED_ORDER)
    _jobs.load_trades(store, records, source_file="lineitem.parquet")
    _jobs.compute_daily_pnl(store)
    _jobs.compute_daily_pnl(store, since=_dt.date(2000, 1, 1), carry_in=True)
    return comparable(store.daily_pnl().where(F.col("pnl_date") >= F.lit(_dt.date(2000, 1, 1))))


@register("daily_pnl_hot_slices")
def q_daily_pnl_hot_slices(spark, sf):
    """Every lineitem day with more than 2 trades cut into slices (all its trades are at midnight): the same rows."""
    return comparable(W.lineitem_daily_pnl(spark, sf, hot_rows=2))


@register("daily_pnl_hourly_segments")
def q_daily_pnl_hourly_segments(spark, sf):
    """The events feed has real times of day: each hour of an instrument's day is a segment."""
    return comparable(W.events_daily_pnl(spark, sf, segment_micros=HOUR_MICROS))


@register("book_of_large_trades")
def q_book_of_large_trades(spark, sf):
    """lineitem with quantities and prices scaled up: positions beyond 1e9, spreads beyond 1e14."""
    valid = W.lineitem_valid(spark, sf).withColumns({
        "quantity": (F.col("quantity") * 1_000_000).cast("decimal(18,4)"),
        "price": (F.col("price") * 10_000).cast("decimal(18,6)"),
    })
    return _book.wide_days(valid)


# ------------------------------------------------------------------ views and the read surface

def _events_book(spark, sf):
    return W.events_daily_pnl(spark, sf), W.events_instruments(spark, sf)


def _lineitem_book(spark, sf):
    return W.lineitem_daily_pnl(spark, sf), W.lineitem_instruments(spark)


@register("running_pnl")
def q_running_pnl(spark, sf):
    return _views.running_pnl(*_events_book(spark, sf))


@register("running_pnl_filtered")
def q_running_pnl_filtered(spark, sf):
    return _serve.running_pnl(*_events_book(spark, sf), symbol=SYMBOL, start=RUN_START, end=RUN_END)


@register("running_pnl_latest")
def q_running_pnl_latest(spark, sf):
    return _serve.running_pnl(*_events_book(spark, sf))


@register("running_pnl_lineitem")
def q_running_pnl_lineitem(spark, sf):
    return _serve.running_pnl(*_lineitem_book(spark, sf), symbol="AAPL")


@register("running_pnl_lineitem_all")
def q_running_pnl_lineitem_all(spark, sf):
    return _views.running_pnl(*_lineitem_book(spark, sf))


def _stored_lineitem_book(spark, sf):
    store = _seeded(spark, W.lineitem_instruments(spark))
    records = _derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", _csv.FEED_ORDER)
    _jobs.load_trades(store, records, source_file="lineitem.parquet", incremental=False)
    _jobs.compute_daily_pnl(store)
    return store


@register("running_pnl_stored_latest")
def q_running_pnl_stored_latest(spark, sf):
    """The newest rows of the stored book: the newest months, on top of what their instruments realised before."""
    return _jobs.running_pnl(_stored_lineitem_book(spark, sf))


@register("running_pnl_stored_from")
def q_running_pnl_stored_from(spark, sf):
    return _jobs.running_pnl(_stored_lineitem_book(spark, sf), symbol="AAPL", start=_dt.date(1996, 3, 5), end=_dt.date(1997, 2, 10))


@register("top_by_month")
def q_top_by_month(spark, sf):
    return _views.top_instruments_by_month(*_events_book(spark, sf))


@register("top_by_month_lineitem")
def q_top_by_month_lineitem(spark, sf):
    return _views.top_instruments_by_month(*_lineitem_book(spark, sf))


@register("top_by_month_filtered")
def q_top_by_month_filtered(spark, sf):
    return _serve.top_instruments(*_events_book(spark, sf), month=TOP_MONTH, top_n=5)


@register("top_by_month_lineitem_top3")
def q_top_by_month_lineitem_top3(spark, sf):
    return _serve.top_instruments(*_lineitem_book(spark, sf), top_n=3)


@register("instrument_list")
def q_instrument_list(spark, sf):
    return _serve.instruments(W.events_instruments(spark, sf))


@register("stats")
def q_stats(spark, sf):
    trade = W.events_trades(spark, sf)
    inst = W.events_instruments(spark, sf)
    daily = W.events_daily_pnl(spark, sf)
    marks = _wm.advance(_wm.empty_marks(spark), trade)
    return comparable(_serve.stats(trade, daily, inst, marks))


@register("serving_rows")
def q_serving_rows(spark, sf):
    return _serve.to_jsonable(
        _serve.running_pnl(*_events_book(spark, sf), symbol=SYMBOL, start=RUN_START, end=RUN_END)
    )


# ------------------------------------------------------------------ files, store and jobs


@register("feed_roundtrip")
def q_feed_roundtrip(spark, sf):
    """Write the events feed as CSV (fresh folder under the checkpoint root), read it back by header name."""
    path = _csv.write_feed_csv(_derived.events_feed(spark, sf), _scratch(spark, "feed") + "/trades.csv")
    return _csv.read_feed_csv(spark, path).drop(_csv.FEED_ORDER)


@register("coerce_dirty_text")
def q_coerce_dirty_text(spark, sf):
    """Malformed ids, numbers and times of every kind: what does not parse is NULL."""
    return comparable(_ingest.coerce_feed(_derived.dirty_feed(spark, sf), "dirty"))


@register("feed_of_two_headers")
def q_feed_of_two_headers(spark, sf):
    """The events feed in one folder, half its files with another column order."""
    folder = _scratch(spark, "feed")
    feed = _derived.events_feed(spark, sf)
    odd = F.pmod(F.xxhash64("trade_id"), F.lit(2)) == 1
    _csv.write_feed_csv(feed.where(odd), f"{folder}/a")
    _csv.write_feed_csv(feed.where(~odd), f"{folder}/b", columns=list(reversed(_csv.FEED_COLUMNS)))
    return _csv.read_feed_csv(spark, [f"{folder}/a", f"{folder}/b"]).drop(_csv.FEED_ORDER)


@register("sql_views")
def q_sql_views(spark, sf):
    """The committed tables through ``spark.sql`` over the registered views."""
    store = _jobs.create_schema(spark)
    _jobs.upsert_instruments(store, W.events_instruments(spark, sf))
    feed = _derived.events_feed(spark, sf).withColumn(_csv.FEED_ORDER, F.lit(0))
    _jobs.load_trades(store, feed, source_file="events.parquet")
    _jobs.compute_daily_pnl(store)
    _jobs.register_views(store)
    out = spark.sql("""
        SELECT v.pnl_date, v.symbol, v.cumulative_realised_pnl, t.pnl_rank, (SELECT count(*) FROM v_valid_trade) AS valid_rows
        FROM v_running_pnl v JOIN v_top_instruments_by_month t
          ON t.instrument_id = v.instrument_id AND t.month = trunc(v.pnl_date, 'MM')""")
    _jobs.drop_schema(spark)
    return out


@register("loaded_trades")
def q_loaded_trades(spark, sf):
    """Land the lineitem feed twice (full, then again), fold the log, read the trade table."""
    store = _jobs.create_schema(spark)
    records = _derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", _csv.FEED_ORDER)
    _jobs.load_trades(store, records, source_file="lineitem.parquet", incremental=False)
    _jobs.load_trades(store, records, source_file="lineitem.parquet", incremental=False)
    store.compact_trades()
    return comparable(store.trades())


@register("trade_pipeline")
def q_pipeline(spark, sf):
    """Q6 end to end on a CSV copy of the events feed: seed, load, aggregate, stats."""
    path = _csv.write_feed_csv(_derived.events_feed(spark, sf), _scratch(spark, "feed") + "/trades.csv")
    store, out = _jobs.run_pipeline(
        spark, _csv.read_feed_csv(spark, path), W.events_instruments(spark, sf), source_file="trades.csv"
    )
    return comparable(out)


def _two_loads(spark, sf):
    """History before the split landed first (full), then the whole feed incrementally."""
    store = _jobs.create_schema(spark)
    records = _derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", _csv.FEED_ORDER)
    history = records.where(F.col("executed_at") < F.lit("1998-01-01"))
    _jobs.load_trades(store, history, source_file="lineitem.parquet", incremental=False)
    _jobs.load_trades(store, records, source_file="lineitem.parquet", incremental=True)
    return store


@register("incremental_load")
def q_incremental_load(spark, sf):
    return comparable(_two_loads(spark, sf).trades())


@register("pnl_after_two_loads")
def q_pnl_after_two_loads(spark, sf):
    store = _two_loads(spark, sf)
    _jobs.upsert_instruments(store, W.lineitem_instruments(spark))
    _jobs.compute_daily_pnl(store)
    return comparable(store.daily_pnl())


@register("etl_watermark")
def q_etl_watermark(spark, sf):
    return comparable(_two_loads(spark, sf).marks())


@register("pnl_job_since")
def q_pnl_job_since(spark, sf):
    """Full PnL run, then a run from 2000-01-01 (which restarts the book there) upserted by month."""
    store = _jobs.create_schema(spark)
    _jobs.upsert_instruments(store, W.lineitem_instruments(spark))
    records = _derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", _csv.FEED_ORDER)
    _jobs.load_trades(store, records, source_file="lineitem.parquet")
    _jobs.compute_daily_pnl(store)
    _jobs.compute_daily_pnl(store, since=_dt.date(2000, 1, 1))
    return comparable(store.daily_pnl())


def _seeded(spark, instruments):
    store = _jobs.create_schema(spark)
    _jobs.upsert_instruments(store, instruments)
    return store


@register("daily_pnl_refreshed")
def q_daily_pnl_refreshed(spark, sf):
    """The events book without one instrument's first days, then those trades as a late load, then only what changed anew."""
    store = _seeded(spark, W.events_instruments(spark, sf))
    feed = _derived.events_feed(spark, sf).withColumn(_csv.FEED_ORDER, F.lit(0))
    late = (F.col("instrument_id") == "3") & (F.col("executed_at") < "2024-01-11") & (F.col("executed_at") != "")
    _jobs.load_trades(store, feed.where(~late), source_file="events.parquet", incremental=False)
    _jobs.compute_daily_pnl(store)
    _jobs.load_trades(store, feed.where(late), source_file="events.parquet", incremental=False)
    _jobs.refresh_daily_pnl(store)
    return comparable(store.daily_pnl())


CORRECTED_INSTRUMENT, CORRECTED_BEFORE = 7, "1996-01-01"


@register("daily_pnl_refreshed_lineitem")
def q_daily_pnl_refreshed_lineitem(spark, sf):
    """The lineitem book, then old trades of one instrument sent again one dearer, then only what changed anew.

    Trades that move to this instrument change another one's days as well.
    """
    store = _seeded(spark, W.lineitem_instruments(spark))
    records = _derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", _csv.FEED_ORDER)
    _jobs.load_trades(store, records, source_file="lineitem.parquet", incremental=False)
    _jobs.compute_daily_pnl(store)
    again = records.where((F.col("instrument_id") == str(CORRECTED_INSTRUMENT)) & (F.col("executed_at") < CORRECTED_BEFORE))
    dearer = again.withColumn("price", (F.col("price").cast("decimal(18,6)") + 1).cast("decimal(18,6)").cast("string"))
    _jobs.load_trades(store, dearer, source_file="lineitem.parquet", incremental=False)
    _jobs.refresh_daily_pnl(store)
    return comparable(store.daily_pnl())


@register("streaming_load")
def q_streaming_load(spark, sf):
    """The events feed dropped as CSV files, landed by the availableNow file stream."""
    from ..streaming.incremental import start_incremental_load

    inbox = _scratch(spark, "inbox")
    _csv.write_feed_csv(_derived.events_feed(spark, sf), inbox)
    store = _jobs.create_schema(spark)
    start_incremental_load(spark, inbox, store, _scratch(spark, "stream-ckpt")).awaitTermination()
    return comparable(store.trades())
