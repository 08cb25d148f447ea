"""The feeds derived from the test tables carry the defects and counts FIXTURES.md records."""

from __future__ import annotations

from ledgerloom.operators import book
from ledgerloom.operators.quality import defect_profile
from ledgerloom.plans import workloads as W
from ledgerloom.sources import derived

SF = "/root/testdata/sf0.01"


def test_events_feed_defects_at_sf001(spark):
    p = defect_profile(derived.events_feed(spark, SF), W.events_instruments(spark, SF)).first()
    assert (p.duplicate_trade_ids, p.null_prices, p.non_positive_quantities, p.unknown_instruments,
            p.bad_sides, p.null_timestamps) == (0, 25, 20, 15, 2014, 8)
    assert W.events_valid(spark, SF).count() == 7930


def test_lineitem_feed_duplicates_and_valid_rows_at_sf001(spark):
    assert derived.lineitem_feed(spark, SF).count() == 60000
    trades = W.lineitem_trades(spark, SF)
    assert trades.count() == 45832  # 14 168 surplus copies collapsed
    valid = W.lineitem_valid(spark, SF)
    assert valid.count() == 38219
    assert book.daily_pnl(valid).count() == 29739


def test_events_dimension_symbols_are_unique_and_classified(spark):
    dim = W.events_instruments(spark, SF)
    rows = dim.collect()
    assert len(rows) == 150 and len({r.symbol for r in rows}) == 150
    classes = {r.asset_class for r in rows}
    assert classes == {"FX", "FUTURE", "EQUITY"}
    assert all(len(r.currency) == 3 for r in rows)
