"""The valid-trade rule (the only definition of a usable trade) and its complement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import utc_date

VALID_COLUMNS = ("trade_id", "instrument_id", "side", "quantity", "price", "executed_at", "trade_date")


def row_rule() -> Column:
    """Per-row part of the rule (NULL-safe: unknown counts as not valid)."""
    side = F.upper(F.col("side"))
    rule = (
        F.col("instrument_id").isNotNull()
        & F.col("side").isNotNull()
        & side.isin("BUY", "SELL")
        & F.col("quantity").isNotNull()
        & (F.col("quantity") > 0)
        & F.col("price").isNotNull()
        & (F.col("price") > 0)
        & F.col("executed_at").isNotNull()
    )
    return F.coalesce(rule, F.lit(False))


def valid_trades(trade: DataFrame, instrument: DataFrame) -> DataFrame:
    """v_valid_trade: row rule + instrument EXISTS in the dimension.

    The EXISTS is a left-semi join.  No broadcast hint: the planner broadcasts
    the dimension when its estimated size is under the broadcast threshold, and
    AQE re-checks the real size at run time; beyond it the join shuffles.
    """
    known = instrument.select("instrument_id")
    return (
        trade.where(row_rule())
        .join(known, "instrument_id", "left_semi")
        .select(
            "trade_id",
            "instrument_id",
            F.upper("side").alias("side"),
            "quantity",
            "price",
            "executed_at",
            utc_date("executed_at").alias("trade_date"),
        )
    )


def flag_validity(trade: DataFrame, instrument: DataFrame) -> DataFrame:
    """Every landed trade plus a boolean ``is_valid``, in one pass over ``trade``."""
    known = instrument.select("instrument_id").dropDuplicates(["instrument_id"]).withColumn(
        "_known", F.lit(True)
    )
    flagged = trade.join(known, "instrument_id", "left")
    return flagged.withColumn("is_valid", row_rule() & F.coalesce(F.col("_known"), F.lit(False))).drop("_known")


def invalid_trades(trade: DataFrame, instrument: DataFrame) -> DataFrame:
    """Rows that landed but are not valid (trade minus v_valid_trade)."""
    cols = trade.columns
    return flag_validity(trade, instrument).where(~F.col("is_valid")).select(*cols)
