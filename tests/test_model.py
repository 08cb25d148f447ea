"""Property test: the Spark book against a brute-force model of the semantics.

The model walks each instrument's trades in (executed_at, trade_id) order with
exact fractions - average cost over all earlier buys, realised on sells, the
day's last price as the mark - and rounds once at the end.  Counts, positions
and marks must be equal; money may differ only in the last (6th) decimal, by
the engine's documented single rounding at scale 10 before the sum.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from ledgerloom.operators import book
from ledgerloom.operators.valid import valid_trades
from tests.conftest import Tape

UNIT6 = Decimal("0.000001")


def _q6(x: Fraction) -> Decimal:
    return (Decimal(x.numerator) / Decimal(x.denominator)).quantize(UNIT6, rounding=ROUND_HALF_UP) \
        if x >= 0 else -((Decimal(-x.numerator) / Decimal(x.denominator)).quantize(UNIT6, rounding=ROUND_HALF_UP))


def model(rows):
    """rows: (trade_id, instrument_id, side, qty, price, executed_at datetime) of valid trades."""
    out = {}
    by_inst = defaultdict(list)
    for r in rows:
        by_inst[r[1]].append(r)
    for inst, trades in by_inst.items():
        trades.sort(key=lambda r: (r[5], r[0]))
        cost = qty = Fraction(0)
        pos = Fraction(0)
        days = {}
        for tid, _, side, q, p, ts in trades:
            q, p = Fraction(q), Fraction(p)
            d = ts.astimezone(dt.timezone.utc).date()
            day = days.setdefault(d, {"n": 0, "real": Fraction(0), "mark": None})
            realised = (p - cost / qty) * q if side == "SELL" and qty > 0 else Fraction(0)
            if side == "BUY":
                cost += q * p
                qty += q
                pos += q
            else:
                pos -= q
            day["n"] += 1
            day["real"] += realised
            day["mark"] = p
            day["pos"], day["cost"], day["qty"] = pos, cost, qty
        for d, v in days.items():
            avg = v["cost"] / v["qty"] if v["qty"] > 0 else None
            unreal = (v["mark"] - avg) * v["pos"] if avg is not None else Fraction(0)
            out[(d, inst)] = (v["n"], _q6(v["pos"]), None if avg is None else _q6(avg), _q6(v["mark"]),
                              _q6(v["real"]), _q6(unreal))
    return out


trade_st = st.tuples(
    st.integers(1, 4),                                   # instrument (4 is unknown to the seeded dimension)
    st.sampled_from(["BUY", "SELL", "buy", "sell", "B"]),
    st.integers(1, 500),                                 # quantity
    st.integers(1, 50_000),                              # price in cents
    st.integers(0, 4),                                   # day
    st.integers(0, 3),                                   # hour (few values: many equal times)
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck),
          phases=(Phase.explicit, Phase.reuse, Phase.generate))  # each example runs Spark jobs: no shrinking
@given(st.lists(trade_st, min_size=1, max_size=40))
def test_book_matches_brute_force(spark, store_factory, trades):
    store = store_factory()
    rows = []
    for i, (inst, side, q, cents, day, hour) in enumerate(trades):
        ts = dt.datetime(2024, 3, 1 + day, 9 + hour, tzinfo=dt.timezone.utc)
        rows.append((f"T{i:03d}", str(inst), side, str(q), f"{cents / 100:.2f}", ts.isoformat()))
    Tape(*rows).land(store)
    m = store.manifest()
    got = {(r.pnl_date, r.instrument_id): (r.trade_count, r.closing_position, r.avg_cost, r.close_price,
                                           r.realised_pnl, r.unrealised_pnl)
           for r in book.daily_pnl(valid_trades(store.trades(m), store.instruments(m))).collect()}
    valid = [(t, int(i), s.upper(), Decimal(q), Decimal(p), dt.datetime.fromisoformat(e))
             for t, i, s, q, p, e in rows if s.upper() in ("BUY", "SELL") and i in ("1", "2", "3")]
    want = model(valid)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert g[:2] == w[:2] and g[3] == w[3], k
        for a, b in zip((g[2], g[4], g[5]), (w[2], w[4], w[5])):
            assert (a is None) == (b is None), k
            if a is not None:
                assert abs(a - b) <= UNIT6, (k, a, b)
