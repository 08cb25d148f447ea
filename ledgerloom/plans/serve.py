"""The read surface as DataFrame functions.

Each returns a lazy DataFrame; the caller collects, writes or serves it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import utc_wallclock
from ..operators.valid import flag_validity
from ..operators.views import running_pnl as running_view
from ..operators.views import top_instruments_by_month

MAX_RUNNING_LIMIT = 10_000
MAX_TOP_N = 100


def instruments(instrument: DataFrame) -> DataFrame:
    """Q1: the dimension ordered by symbol."""
    return instrument.select("instrument_id", "symbol", "asset_class", "currency").orderBy("symbol")


def running_pnl(
    daily: DataFrame,
    instrument: DataFrame,
    symbol: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    limit: int = 500,
    before: DataFrame | None = None,
) -> DataFrame:
    """Q2: running PnL, newest first then symbol, at most ``limit`` rows.

    ``before`` (instrument_id, realised_before): what was realised ahead of the days in ``daily``.

    Filters apply after the running sum (a ``start`` does not reset it); only
    predicates that are set are added.  ORDER BY + LIMIT plans as a top-k
    (TakeOrderedAndProject): each task keeps ``limit`` rows, no full sort.
    """
    if not 1 <= limit <= MAX_RUNNING_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_RUNNING_LIMIT}")
    if end is not None:
        # Safe below the window: a running sum only looks backwards, so days after
        # ``end`` never change the rows we keep - and the scan can skip them.
        daily = daily.where(F.col("pnl_date") <= F.lit(end))
    out = running_view(daily, instrument, before)
    if symbol is not None:
        out = out.where(F.col("symbol") == F.lit(symbol))
    if start is not None:
        out = out.where(F.col("pnl_date") >= F.lit(start))
    if end is not None:
        out = out.where(F.col("pnl_date") <= F.lit(end))
    return out.orderBy(F.desc("pnl_date"), F.asc("symbol")).limit(limit)


def top_instruments(
    daily: DataFrame, instrument: DataFrame, month: dt.date | None = None, top_n: int = 10
) -> DataFrame:
    """Q3: ranks <= top_n (ties may return more rows), optional month given as any day in it."""
    if not 1 <= top_n <= MAX_TOP_N:
        raise ValueError(f"top_n must be between 1 and {MAX_TOP_N}")
    if month is not None:
        # Ranks are per month, so only that month's rows matter: a plain date range
        # on pnl_date reaches the Parquet scan (min/max statistics), trunc() would not.
        first = month.replace(day=1)
        nxt = (first + dt.timedelta(days=32)).replace(day=1)
        daily = daily.where((F.col("pnl_date") >= F.lit(first)) & (F.col("pnl_date") < F.lit(nxt)))
    out = top_instruments_by_month(daily, instrument, at_most=top_n)
    if month is not None:
        out = out.where(F.col("month") == F.trunc(F.lit(month), "MM"))
    return out.orderBy(F.desc("month"), F.asc("pnl_rank"))


def stats(trade: DataFrame, daily: DataFrame, instrument: DataFrame, watermark: DataFrame) -> DataFrame:
    """Q4: one row of counts and the newest mark over all streams, plus invalid_rows.

    The landed and the valid trades are counted in one pass over the trades.
    """
    trades = flag_validity(trade, instrument).agg(
        F.count(F.lit(1)).alias("trade_rows"), F.count_if("is_valid").alias("valid_trade_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"))
    return trades.select(
        "trade_rows",
        "valid_trade_rows",
        daily.select(F.count(F.lit(1))).scalar().alias("daily_pnl_rows"),
        instrument.select(F.count(F.lit(1))).scalar().alias("instrument_rows"),
        watermark.select(F.max("watermark_at")).scalar().alias("watermark_at"),
        "invalid_rows",
    )


def to_jsonable(df: DataFrame) -> DataFrame:
    """Q5: serving types - decimals as double, dates as ISO text, instants as ISO UTC text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            # Python's isoformat(): fraction only when non-zero, explicit UTC offset.
            micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
            frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
            c = F.concat(F.date_format(utc_wallclock(c), "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_json_rows(df: DataFrame) -> DataFrame:
    """Q5 as JSON text, one object per row (what an HTTP endpoint would return)."""
    return to_jsonable(df).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
