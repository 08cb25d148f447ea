"""Shared fixtures: one local Spark session, a tape of fills, fresh stores."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.operators.instruments import classify  # noqa: E402
from ledgerloom.plans import jobs  # noqa: E402
from ledgerloom.schema import FEED_COLUMNS  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.sources.feed_csv import FEED_ORDER  # noqa: E402

DIMENSION = [(1, "AAPL"), (2, "MSFT"), (3, "EURUSD")]


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir is left as the environment sets it; when it is unset,
    # ledgerloom.session.checkpoint_root picks a fresh folder (local master only).
    yield build_session(master="local[4]", shuffle_partitions=8)


class Tape:
    """Feed rows in file order; times are written like ``2023-05-02 09:30`` (UTC) or given as raw text."""

    def __init__(self, *rows: tuple):
        self.rows = list(rows)

    def raw(self, key, instrument, side, units, price, time) -> Tape:
        self.rows.append(tuple(str(x) for x in (key, instrument, side, units, price, time)))
        return self

    def _fill(self, side, key, units, price, when, on) -> Tape:
        stamp = f"{when.replace(' ', 'T')}:00Z" if len(when) == 16 and when[10] == " " else when
        return self.raw(key, on, side, units, price, stamp)

    def buy(self, key, units, price, when, on=1) -> Tape:
        return self._fill("BUY", key, units, price, when, on)

    def sell(self, key, units, price, when, on=1) -> Tape:
        return self._fill("SELL", key, units, price, when, on)

    def frame(self, spark):
        data = [(*r, i) for i, r in enumerate(self.rows)]
        df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in FEED_COLUMNS) + ", place long")
        order = F.struct(F.lit("tape").alias("file"), F.lit(0).cast("long").alias("block"), F.col("place").alias("row"))
        return df.select(*FEED_COLUMNS, order.alias(FEED_ORDER))

    def land(self, store, incremental=False, **kw):
        return jobs.load_trades(store, self.frame(store.spark), incremental=incremental, **kw)


@pytest.fixture()
def store_factory(spark):
    """Fresh stores with the three instruments of ``DIMENSION``, on demand."""
    def make():
        made = jobs.create_schema(spark)
        jobs.upsert_instruments(made, classify(spark.createDataFrame(DIMENSION, "instrument_id int, symbol string")))
        return made
    return make


@pytest.fixture()
def store(store_factory):
    return store_factory()
