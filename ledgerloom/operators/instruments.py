"""The instrument dimension: classification of symbols and the seed list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The seed symbol list, in order; the 1-based position is the id.
SEED_SYMBOLS = (
    "AAPL", "MSFT", "AMZN", "GOOGL", "META", "TSLA", "NVDA", "JPM",
    "BAC", "XOM", "CVX", "PFE", "JNJ", "WMT", "HD", "PG",
    "KO", "PEP", "DIS", "NFLX", "INTC", "AMD", "CRM", "ORCL",
    "EURUSD", "GBPUSD", "USDJPY", "AUDUSD", "ESZ5", "NQZ5",
)
# Futures are recognised by these contract-month suffixes.
FUTURE_SUFFIXES = ("Z5", "H6")
DEFAULT_CURRENCY = "USD"


def asset_class(symbol: Column) -> Column:
    """Six letters -> FX; else a futures suffix -> FUTURE; else EQUITY (order matters)."""
    suffix = "(" + "|".join(FUTURE_SUFFIXES) + ")$"
    return (
        F.when(symbol.rlike(r"^\p{L}{6}$"), F.lit("FX"))
        .when(symbol.rlike(suffix), F.lit("FUTURE"))
        .otherwise(F.lit("EQUITY"))
    )


def currency(symbol: Column, klass: Column) -> Column:
    """FX quotes in the second currency of the pair (chars 4-6); everything else in USD."""
    return F.when(klass == "FX", F.substring(symbol, 4, 3)).otherwise(F.lit(DEFAULT_CURRENCY))


def classify(symbols: DataFrame) -> DataFrame:
    """(instrument_id, symbol) -> the four dimension columns."""
    klass = asset_class(F.col("symbol"))
    return symbols.select(
        F.col("instrument_id").cast("int").alias("instrument_id"),
        "symbol",
        klass.alias("asset_class"),
        currency(F.col("symbol"), klass).alias("currency"),
    )


def seed_instruments(spark: SparkSession) -> DataFrame:
    """The seed dimension (30 rows): ids are the 1-based list positions.

    Built on ``spark.range`` so the planner knows its row count and can broadcast
    it (a DataFrame made from a Python list has no size statistics).
    """
    symbols = F.array(*[F.lit(s) for s in SEED_SYMBOLS])
    ids = spark.range(1, len(SEED_SYMBOLS) + 1).select(F.col("id").cast("int").alias("instrument_id"))
    return classify(ids.select("instrument_id", F.element_at(symbols, F.col("instrument_id")).alias("symbol")))
