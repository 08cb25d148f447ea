"""The standard inputs built from a scale-factor directory, shared by queries and bench.

Each function is lazy: it returns a DataFrame plan over the parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import book, ingest
from ..operators.dedup import collapse_duplicates
from ..operators.valid import valid_trades
from ..sources import derived


def events_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events feed landed as typed trades (its trade ids are already unique)."""
    return ingest.coerce_feed(derived.events_feed(spark, sf_dir), "events.parquet")


def events_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.events_instruments(spark, sf_dir)


def events_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_trades(events_trades(spark, sf_dir), events_instruments(spark, sf_dir))


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem feed coerced, file order kept for the collapse."""
    return ingest.coerce_feed(derived.lineitem_feed(spark, sf_dir), "lineitem.parquet", keep=("feed_order",))


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem feed landed: one row per trade id, the last occurrence wins."""
    return collapse_duplicates(lineitem_records(spark, sf_dir), order_col="feed_order").drop("feed_order")


def lineitem_instruments(spark: SparkSession) -> DataFrame:
    return derived.lineitem_instruments(spark)


def lineitem_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_trades(lineitem_trades(spark, sf_dir), lineitem_instruments(spark))


def _busy(records: DataFrame, kw: dict) -> dict:
    """Hot days counted on the landed records, before they are collapsed and joined."""
    hot_rows = kw.get("hot_rows", book.HOT_SEGMENT_ROWS)
    return kw if hot_rows is None or "segment_micros" in kw else {**kw, "hot_days": book.busy_days(records, hot_rows)}


def events_daily_pnl(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return book.daily_pnl(events_valid(spark, sf_dir), **_busy(events_trades(spark, sf_dir), kw))


def lineitem_daily_pnl(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return book.daily_pnl(lineitem_valid(spark, sf_dir), **_busy(lineitem_records(spark, sf_dir), kw))


def drop_volatile(df: DataFrame) -> DataFrame:
    """Remove run-time stamps (computed_at, ingested_at, updated_at) from an output."""
    return df.drop(*[c for c in ("computed_at", "ingested_at", "updated_at") if c in df.columns])

