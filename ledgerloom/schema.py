"""Declared schemas.  Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the feed file (fixed value: must equal the reference's header).
FEED_COLUMNS = ("trade_id", "instrument_id", "side", "quantity", "price", "executed_at")

QTY_TYPE = T.DecimalType(18, 4)
PRICE_TYPE = T.DecimalType(18, 6)

FEED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FEED_COLUMNS])

INSTRUMENT_SCHEMA = T.StructType([
    T.StructField("instrument_id", T.IntegerType(), False),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("asset_class", T.StringType(), True),
    T.StructField("currency", T.StringType(), True),
])

TRADE_SCHEMA = T.StructType([
    T.StructField("trade_id", T.StringType(), False),
    T.StructField("instrument_id", T.IntegerType(), True),
    T.StructField("side", T.StringType(), True),
    T.StructField("quantity", QTY_TYPE, True),
    T.StructField("price", PRICE_TYPE, True),
    T.StructField("executed_at", T.TimestampType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

DAILY_PNL_SCHEMA = T.StructType([
    T.StructField("pnl_date", T.DateType(), False),
    T.StructField("instrument_id", T.IntegerType(), False),
    T.StructField("trade_count", T.IntegerType(), True),
    T.StructField("closing_position", QTY_TYPE, True),
    T.StructField("avg_cost", PRICE_TYPE, True),
    T.StructField("close_price", PRICE_TYPE, True),
    T.StructField("realised_pnl", PRICE_TYPE, True),
    T.StructField("unrealised_pnl", PRICE_TYPE, True),
    T.StructField("computed_at", T.TimestampType(), True),
])

WATERMARK_SCHEMA = T.StructType([
    T.StructField("stream", T.StringType(), False),
    T.StructField("watermark_at", T.TimestampType(), True),
    T.StructField("rows_loaded", T.LongType(), False),
    T.StructField("updated_at", T.TimestampType(), True),
])

DEFAULT_STREAM = "trades_csv"

DAILY_PNL_KEY = ("pnl_date", "instrument_id")
INSTRUMENT_KEY = ("instrument_id",)
