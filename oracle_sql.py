"""Independent DuckDB SQL for every query in ``__spark_entry__.queries()``.

The SQL re-derives each feed from the raw tables (no string round trip) and
computes PnL in exact scaled integers (HUGEINT): quantity x 1e4, price x 1e6,
divisions rounded half away from zero by hand.  DuckDB's own decimal division
returns DOUBLE, so nothing here divides decimals.  Timestamps are UTC wall-clock
TIMESTAMP values on both sides.
"""

from __future__ import annotations

# The instruments every seed dimension has, by id.
SEED_ROWS = """(1, 'AAPL'), (2, 'MSFT'), (3, 'AMZN'), (4, 'GOOGL'), (5, 'META'), (6, 'TSLA'), (7, 'NVDA'), (8, 'JPM'),
(9, 'BAC'), (10, 'XOM'), (11, 'CVX'), (12, 'PFE'), (13, 'JNJ'), (14, 'WMT'), (15, 'HD'), (16, 'PG'),
(17, 'KO'), (18, 'PEP'), (19, 'DIS'), (20, 'NFLX'), (21, 'INTC'), (22, 'AMD'), (23, 'CRM'), (24, 'ORCL'),
(25, 'EURUSD'), (26, 'GBPUSD'), (27, 'USDJPY'), (28, 'AUDUSD'), (29, 'ESZ5'), (30, 'NQZ5')"""

# ---------------------------------------------------------------- helpers


def half(n: str, d: str) -> str:
    """round(n / d) half away from zero, integers, d > 0."""
    return f"(CASE WHEN ({n}) >= 0 THEN (2 * ({n}) + ({d})) // (2 * ({d})) ELSE -((2 * (-({n})) + ({d})) // (2 * ({d}))) END)"


def scaled(n: str, scale: int, typ: str) -> str:
    """integer at ``scale`` -> DECIMAL ``typ`` (stays decimal: multiply, never divide)."""
    return f"CAST(CAST({n} AS DECIMAL(38,0)) * 0.{'0' * (scale - 1)}1 AS {typ})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


# ---------------------------------------------------------------- feeds

EVENTS_FEED = """events_feed AS (
  SELECT 'E' || CAST(event_id AS VARCHAR) AS trade_id,
         CAST(CASE WHEN event_id % 667 = 5 THEN -1 ELSE user_id + 1 END AS INTEGER) AS instrument_id,
         CASE WHEN event_type = 'purchase' THEN 'BUY' WHEN event_type = 'signup' THEN 'buy'
              WHEN event_type IN ('view', 'click') THEN 'SELL' WHEN event_type = 'error' THEN 'B' END AS side,
         CAST(CASE WHEN event_id % 500 = 11 THEN 0 ELSE event_id % 97 + 1 END AS DECIMAL(18,4)) AS quantity,
         CASE WHEN event_id % 400 = 3 THEN NULL ELSE CAST(value AS DECIMAL(18,6)) END AS price,
         CASE WHEN event_id % 1250 = 9 THEN NULL ELSE ts END AS executed_at,
         'events.parquet' AS source_file
  FROM events)"""


def _letters(idc: str, n: int) -> str:
    return " || ".join(f"chr(CAST(65 + ({idc} // {26 ** k}) % 26 AS INTEGER))" for k in range(n - 1, -1, -1))


def _classify(sym: str) -> tuple[str, str]:
    klass = (f"CASE WHEN regexp_matches({sym}, '^[A-Za-z]{{6}}$') THEN 'FX' "
             f"WHEN regexp_matches({sym}, '(Z5|H6)$') THEN 'FUTURE' ELSE 'EQUITY' END")
    cur = f"CASE WHEN ({klass}) = 'FX' THEN substr({sym}, 4, 3) ELSE 'USD' END"
    return klass, cur


_EV_SYMBOL = (
    "CASE WHEN instrument_id % 3 = 0 THEN " + _letters("instrument_id", 6)
    + " WHEN instrument_id % 3 = 1 THEN " + _letters("instrument_id", 5)
    + " || CASE WHEN (instrument_id // 3) % 2 = 0 THEN 'Z5' ELSE 'H6' END"
    + " ELSE " + _letters("instrument_id", 7) + " END"
)
_K, _C = _classify("symbol")

EVENTS_DIM = f"""events_ids AS (SELECT DISTINCT CAST(user_id + 1 AS INTEGER) AS instrument_id FROM events),
events_sym AS (SELECT instrument_id, {_EV_SYMBOL} AS symbol FROM events_ids),
events_dim AS (SELECT instrument_id, symbol, {_K} AS asset_class, {_C} AS currency FROM events_sym)"""

SEED_DIM = f"""seed_sym AS (SELECT * FROM (VALUES {SEED_ROWS}) t(instrument_id, symbol)),
seed_dim AS (SELECT CAST(instrument_id AS INTEGER) AS instrument_id, symbol, {_K} AS asset_class, {_C} AS currency FROM seed_sym)"""

LINEITEM_FEED = """li_feed AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trade_id,
         CAST(l_partkey % 30 + 1 AS INTEGER) AS instrument_id,
         CASE WHEN l_returnflag = 'N' THEN 'BUY' WHEN l_returnflag = 'R' THEN 'sell'
              WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'BUY' ELSE 'A' END AS side,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,6)) AS price,
         l_shipdate AS executed_at,
         'lineitem.parquet' AS source_file,
         l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity
  FROM lineitem)"""

LAST_FIRST = "ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC"
TRADE_COLS = "trade_id, instrument_id, side, quantity, price, executed_at, source_file"


def last_copy(name: str, src: str, where: str = "TRUE") -> str:
    """One row per trade_id of ``src`` rows passing ``where``: the last in feed order."""
    return f"""{name} AS (
  SELECT {TRADE_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY trade_id {LAST_FIRST}) AS last_rank FROM {src} WHERE {where})
  WHERE last_rank = 1)"""


LINEITEM_TRADES = last_copy("li_trades", "li_feed")


def valid_cte(name: str, trades: str, dim: str, first_day: str | None = None) -> str:
    """Usable trades: those that no reason for rejection applies to."""
    late = f"coalesce(CAST(executed_at AS DATE) < {first_day}, FALSE)" if first_day else "FALSE"
    return f"""{name}_checked AS (
  SELECT t.*, CASE upper(t.side) WHEN 'BUY' THEN 'BUY' WHEN 'SELL' THEN 'SELL' END AS way,
         list_any_value([CASE WHEN t.executed_at IS NULL THEN 'time' END, CASE WHEN coalesce(t.price, 0) <= 0 THEN 'price' END,
                         CASE WHEN coalesce(t.quantity, 0) <= 0 THEN 'quantity' END, CASE WHEN k.instrument_id IS NULL THEN 'unknown' END,
                         CASE WHEN {late} THEN 'early' END]) AS fault
  FROM {trades} t LEFT JOIN (SELECT DISTINCT instrument_id FROM {dim}) k ON t.instrument_id = k.instrument_id),
{name} AS (
  SELECT trade_id, instrument_id, way AS side, quantity, price, executed_at, CAST(executed_at AS DATE) AS trade_date
  FROM {name}_checked WHERE fault IS NULL AND way IS NOT NULL)"""


# ---------------------------------------------------------------- the book, exact integers

def long_half(p: str, q: str, cost: str, qty: str) -> str:
    """round((p - cost/qty) * q) half away from zero for q >= 0, cutting cost/qty first so that nothing overflows."""
    whole, rest = f"(({cost}) // ({qty}))", f"((({cost}) % ({qty})) * ({q}))"
    m = f"((({p}) - {whole}) * ({q}) - {rest} // ({qty}))"
    return (f"({m} - CASE WHEN {m} > 0 AND 2 * ({rest} % ({qty})) > ({qty}) THEN 1 "
            f"WHEN {m} <= 0 AND 2 * ({rest} % ({qty})) >= ({qty}) THEN 1 ELSE 0 END)")


def book_ctes(clean: str, p: str = "b", large: bool = False) -> list[str]:
    """CTEs {p}_real (per trade), {p}_day (per instrument-day), {p}_run, {p}_pnl.

    What was bought before a trade, and through a day, is gathered by joining
    each row with the earlier ones.  ``large``: values beyond HUGEINT products.
    """
    sold = long_half("t.p", "t.q", "e.cost", "e.units") if large else half("(t.p * e.units - e.cost) * t.q", "e.units")
    if large:
        size = long_half("mark", "abs(closing)", "cc", "cq")
        held = f"sign(closing)::HUGEINT * {size}"
    else:
        held = half("(mark * cq - cc) * closing", "cq")
    pnl_cols = f"""trade_date AS pnl_date, instrument_id, CAST(n AS INTEGER) AS trade_count,
         {scaled('closing', 4, 'DECIMAL(18,4)')} AS closing_position,
         CASE WHEN cq > 0 THEN {scaled(half('cc', 'cq'), 6, 'DECIMAL(18,6)')} END AS avg_cost,
         {scaled('mark', 6, 'DECIMAL(18,6)')} AS close_price,
         {scaled(half('r10', '10000'), 6, 'DECIMAL(18,6)')} AS realised_pnl,
         {scaled(f"CASE WHEN cq > 0 THEN {half('u10', '10000')} ELSE 0 END", 6, 'DECIMAL(18,6)')} AS unrealised_pnl"""
    return [
        f"""{p}_int AS (
  SELECT instrument_id, trade_date, trade_id, side, executed_at, quantity, price,
         CAST(CAST(quantity AS DECIMAL(28,4)) * 10000 AS HUGEINT) AS q, CAST(CAST(price AS DECIMAL(28,6)) * 1000000 AS HUGEINT) AS p
  FROM {clean})""",
        f"""{p}_earlier AS (
  SELECT a.instrument_id, a.trade_id, count(*) AS trades, sum(b.q * b.p) FILTER (b.side = 'BUY') AS cost,
         sum(b.q) FILTER (b.side = 'BUY') AS units
  FROM {p}_int a JOIN {p}_int b ON a.instrument_id = b.instrument_id
   AND (b.executed_at < a.executed_at OR (b.executed_at = a.executed_at AND b.trade_id < a.trade_id))
  GROUP BY a.instrument_id, a.trade_id)""",
        f"""{p}_real AS (
  SELECT t.*, CASE t.side WHEN 'BUY' THEN t.q ELSE -t.q END AS sq, CASE t.side WHEN 'BUY' THEN t.q * t.p ELSE 0 END AS bc,
         CASE t.side WHEN 'BUY' THEN t.q ELSE 0 END AS bq,
         CASE WHEN e.trades > 0 THEN coalesce(e.cost, 0) END AS pc, CASE WHEN e.trades > 0 THEN coalesce(e.units, 0) END AS pq,
         CASE WHEN t.side = 'SELL' AND e.units > 0 THEN {sold} ELSE 0 END AS r10
  FROM {p}_int t LEFT JOIN {p}_earlier e ON e.instrument_id = t.instrument_id AND e.trade_id = t.trade_id)""",
        f"""{p}_day AS (
  SELECT instrument_id, trade_date, count(*) AS n, sum(sq) AS net, sum(r10) AS r10, sum(bc) AS dbc, sum(bq) AS dbq,
         arg_max(p, (executed_at, trade_id)) AS mark
  FROM {p}_real GROUP BY instrument_id, trade_date)""",
        f"""{p}_through AS (
  SELECT a.instrument_id, a.trade_date, sum(b.net) AS closing, sum(b.dbc) AS cc, sum(b.dbq) AS cq
  FROM {p}_day a JOIN {p}_day b ON b.instrument_id = a.instrument_id AND b.trade_date <= a.trade_date
  GROUP BY a.instrument_id, a.trade_date)""",
        f"""{p}_run AS (SELECT *, CASE WHEN cq > 0 THEN {held} ELSE 0 END AS u10 FROM {p}_day JOIN {p}_through USING (instrument_id, trade_date))""",
        f"""{p}_pnl AS (SELECT {pnl_cols} FROM {p}_run)""",
    ]


EV_BASE = [EVENTS_FEED, EVENTS_DIM, valid_cte("ev_valid", "events_feed", "events_dim")]
LI_BASE = [LINEITEM_FEED, LINEITEM_TRADES, SEED_DIM, valid_cte("li_valid", "li_trades", "seed_dim")]


def _q(ctes: list[str], select: str) -> str:
    return with_(*ctes) + "\n" + select


PNL_COLS = ("pnl_date, instrument_id, trade_count, closing_position, avg_cost, close_price, "
            "realised_pnl, unrealised_pnl")

EVENTS_MARK = "TIMESTAMP '2024-01-15 00:00:00'"
LINEITEM_MARK = "TIMESTAMP '1998-06-30 00:00:00'"
LINEITEM_SPLIT = "TIMESTAMP '1998-01-01 00:00:00'"
SINCE = "DATE '2024-01-16'"


def running_view(daily: str, dim: str, name: str = "run_view") -> str:
    """Cumulative realised by joining each day with the days up to it."""
    return f"""{name}_sofar AS (
  SELECT late.instrument_id, late.pnl_date, sum(early.realised_pnl) AS total
  FROM {daily} late, {daily} early WHERE early.instrument_id = late.instrument_id AND early.pnl_date <= late.pnl_date
  GROUP BY ALL),
{name} AS (
  SELECT day.*, known.symbol, known.asset_class, CAST(sofar.total AS DECIMAL(28,6)) AS cumulative_realised_pnl,
         CAST(sofar.total + day.unrealised_pnl AS DECIMAL(29,6)) AS total_pnl
  FROM {daily} day JOIN {name}_sofar sofar USING (instrument_id, pnl_date)
  JOIN {dim} known USING (instrument_id))"""


def monthly_view(daily: str, dim: str, name: str = "top_view") -> str:
    """A rank is one more than the number of greater sums of the month."""
    return f"""{name}_sums AS (
  SELECT make_date(year(pnl_date), month(pnl_date), 1) AS month, instrument_id, CAST(sum(realised_pnl) AS DECIMAL(28,6)) AS realised_pnl,
         CAST(sum(trade_count) AS BIGINT) AS trade_count
  FROM {daily} WHERE instrument_id IN (SELECT instrument_id FROM {dim}) GROUP BY ALL),
{name} AS (
  SELECT mine.*, known.symbol, known.asset_class, 1 + count(better.instrument_id) AS pnl_rank
  FROM {name}_sums mine JOIN {dim} known USING (instrument_id)
  LEFT JOIN {name}_sums better ON better.month = mine.month AND better.realised_pnl > mine.realised_pnl
  GROUP BY ALL)"""


def build() -> dict[str, str]:
    out: dict[str, str] = {}
    ev_book = EV_BASE + book_ctes("ev_valid")
    li_book = LI_BASE + book_ctes("li_valid")

    out["valid_trades"] = _q(EV_BASE, "SELECT * FROM ev_valid")
    out["daily_pnl"] = _q(ev_book, "SELECT * FROM b_pnl")
    out["daily_pnl_lineitem"] = _q(li_book, "SELECT * FROM b_pnl")

    # ingest
    out["coerce_feed"] = _q([EVENTS_FEED], "SELECT * FROM events_feed")
    out["watermark_filter"] = _q(
        [EVENTS_FEED], f"SELECT * FROM events_feed WHERE executed_at IS NULL OR executed_at > {EVENTS_MARK}")
    out["collapse_duplicates"] = _q([LINEITEM_FEED, LINEITEM_TRADES], "SELECT * FROM li_trades")
    cand = f"executed_at IS NULL OR executed_at > {LINEITEM_MARK}"
    out["load_metrics"] = _q([LINEITEM_FEED, last_copy("li_win", "li_feed", cand)], f"""
SELECT (SELECT count(*) FROM li_feed) AS rows_read,
       (SELECT count(*) FROM li_win) AS rows_upserted,
       (SELECT count(*) FROM li_feed WHERE NOT ({cand})) AS rows_skipped_by_watermark,
       (SELECT count(*) FROM li_feed WHERE {cand}) - (SELECT count(*) FROM li_win) AS duplicates_collapsed,
       {LINEITEM_MARK} AS watermark_before,
       greatest({LINEITEM_MARK}, (SELECT max(executed_at) FROM li_win)) AS watermark_after""")
    out["advance_watermark"] = _q([LINEITEM_FEED, last_copy("li_win", "li_feed", cand)], f"""
SELECT 'other_feed' AS stream, TIMESTAMP '2001-01-01 00:00:00' AS watermark_at, CAST(5 AS BIGINT) AS rows_loaded
UNION ALL
SELECT 'trades_csv', greatest({LINEITEM_MARK}, (SELECT max(executed_at) FROM li_win)),
       CAST(1000 + (SELECT count(*) FROM li_win) AS BIGINT)""")
    out["upsert_trades"] = _q(
        [LINEITEM_FEED, last_copy("li_a", "li_feed", f"executed_at < {LINEITEM_SPLIT}"),
         last_copy("li_b", "li_feed", f"executed_at IS NULL OR executed_at >= {LINEITEM_SPLIT}")],
        "SELECT * FROM li_b UNION ALL SELECT * FROM li_a WHERE trade_id NOT IN (SELECT trade_id FROM li_b)")
    out["upsert_instruments"] = _q(
        [EVENTS_DIM, SEED_DIM],
        "SELECT * FROM seed_dim UNION ALL "
        "SELECT * FROM events_dim WHERE instrument_id NOT IN (SELECT instrument_id FROM seed_dim)")
    ev_since = valid_cte("ev_since", "events_feed", "events_dim", SINCE)
    out["upsert_daily_pnl"] = _q(
        ev_book + [ev_since] + book_ctes("ev_since", "s"),
        f"SELECT {PNL_COLS} FROM s_pnl UNION ALL SELECT {PNL_COLS} FROM b_pnl "
        "WHERE (pnl_date, instrument_id) NOT IN (SELECT (pnl_date, instrument_id) FROM s_pnl)")
    out["classify_instruments"] = _q([EVENTS_DIM], "SELECT * FROM events_dim")

    def profile(feed: str, dim: str) -> str:
        parts = f"""(SELECT count(*) - count(DISTINCT trade_id) FROM {feed}) AS duplicate_trade_ids,
       (SELECT count(*) FROM {feed} WHERE price IS NULL) AS null_prices,
       (SELECT count(*) FROM {feed} WHERE quantity <= 0) AS non_positive_quantities,
       (SELECT count(*) FROM {feed} WHERE instrument_id IS NULL
           OR instrument_id NOT IN (SELECT instrument_id FROM {dim})) AS unknown_instruments,
       (SELECT count(*) FROM {feed} WHERE side IS NULL OR upper(side) NOT IN ('BUY', 'SELL')) AS bad_sides,
       (SELECT count(*) FROM {feed} WHERE executed_at IS NULL) AS null_timestamps"""
        return f"""SELECT *, duplicate_trade_ids + null_prices + non_positive_quantities + unknown_instruments
       + bad_sides + null_timestamps AS total FROM (SELECT {parts})"""

    out["defect_profile"] = _q([EVENTS_FEED, EVENTS_DIM], profile("events_feed", "events_dim"))
    out["defect_profile_lineitem"] = _q([LINEITEM_FEED, SEED_DIM], profile("li_feed", "seed_dim"))
    out["invalid_trades"] = _q(EV_BASE, "SELECT * FROM events_feed WHERE trade_id NOT IN (SELECT trade_id FROM ev_valid)")

    # book stages
    out["trade_positions"] = _q(ev_book, f"""SELECT instrument_id, trade_date, trade_id, side, quantity, price,
       {scaled('sq', 4, 'DECIMAL(18,4)')} AS signed_qty,
       {scaled('pc', 10, 'DECIMAL(38,10)')} AS prior_buy_cost,
       {scaled('pq', 4, 'DECIMAL(29,4)')} AS prior_buy_qty
FROM b_real""")
    out["trade_realised"] = _q(ev_book, f"""SELECT trade_id, instrument_id, trade_date,
       {scaled('r10', 10, 'DECIMAL(38,10)')} AS realised_pnl FROM b_real""")
    out["daily_net"] = _q(ev_book, f"""SELECT instrument_id, trade_date, CAST(n AS INTEGER) AS trade_count,
       {scaled('net', 4, 'DECIMAL(28,4)')} AS net_qty, {scaled('r10', 10, 'DECIMAL(38,10)')} AS realised_pnl FROM b_run""")
    out["closing_position"] = _q(ev_book, f"""SELECT instrument_id, trade_date,
       {scaled('closing', 4, 'DECIMAL(18,4)')} AS closing_position FROM b_run""")
    out["daily_marks"] = _q(ev_book, f"""SELECT instrument_id, trade_date,
       {scaled('mark', 6, 'DECIMAL(18,6)')} AS close_price FROM b_run""")
    out["eod_cost"] = _q(ev_book, f"""SELECT instrument_id, trade_date,
       {scaled('cc', 10, 'DECIMAL(37,10)')} AS cum_buy_cost, {scaled('cq', 4, 'DECIMAL(28,4)')} AS cum_buy_qty FROM b_run""")
    out["daily_pnl_since"] = _q(EV_BASE + [ev_since] + book_ctes("ev_since", "s"), "SELECT * FROM s_pnl")
    out["daily_pnl_since_carry"] = _q(ev_book, f"SELECT * FROM b_pnl WHERE pnl_date >= {SINCE}")
    out["daily_pnl_hourly_segments"] = out["daily_pnl"]
    out["daily_pnl_hot_slices"] = out["daily_pnl_lineitem"]
    large = """li_large AS (SELECT * REPLACE (CAST(CAST(quantity AS DECIMAL(24,4)) * CAST(1000000 AS DECIMAL(8,0)) AS DECIMAL(18,4)) AS quantity,
         CAST(CAST(price AS DECIMAL(24,6)) * CAST(10000 AS DECIMAL(8,0)) AS DECIMAL(18,6)) AS price) FROM li_valid)"""
    out["book_of_large_trades"] = _q(LI_BASE + [large] + book_ctes("li_large", "g", large=True), f"""
SELECT instrument_id, trade_date, CAST(n AS INTEGER) AS trade_count, {scaled('closing', 4, 'DECIMAL(28,4)')} AS closing_position,
       {scaled('cc', 10, 'DECIMAL(37,10)')} AS cum_buy_cost, {scaled('r10', 10, 'DECIMAL(38,10)')} AS realised_pnl,
       {scaled('u10', 10, 'DECIMAL(38,10)')} AS unrealised_pnl,
       CASE WHEN cq > 0 THEN {scaled(half('cc', 'cq'), 6, 'DECIMAL(18,6)')} END AS avg_cost
FROM g_run""")
    out["daily_pnl_lineitem_since_carry"] = _q(li_book, "SELECT * FROM b_pnl WHERE pnl_date >= DATE '2000-01-01'")

    # views and the read surface
    ev_views = ev_book + [running_view("b_pnl", "events_dim"), monthly_view("b_pnl", "events_dim")]
    li_views = li_book + [running_view("b_pnl", "seed_dim"), monthly_view("b_pnl", "seed_dim")]
    out["running_pnl"] = _q(ev_views, "SELECT * FROM run_view")
    filt = ("SELECT * FROM run_view WHERE symbol = 'AAAAAD' AND pnl_date >= DATE '2024-01-05' "
            "AND pnl_date <= DATE '2024-01-20' ORDER BY pnl_date DESC, symbol LIMIT 500")
    out["running_pnl_filtered"] = _q(ev_views, filt)
    out["running_pnl_latest"] = _q(ev_views, "SELECT * FROM run_view ORDER BY pnl_date DESC, symbol LIMIT 500")
    out["running_pnl_lineitem"] = _q(
        li_views, "SELECT * FROM run_view WHERE symbol = 'AAPL' ORDER BY pnl_date DESC, symbol LIMIT 500")
    out["running_pnl_stored_latest"] = _q(li_views, "SELECT * FROM run_view ORDER BY pnl_date DESC, symbol LIMIT 500")
    out["running_pnl_stored_from"] = _q(
        li_views, "SELECT * FROM run_view WHERE symbol = 'AAPL' AND pnl_date BETWEEN DATE '1996-03-05' AND DATE '1997-02-10' "
                  "ORDER BY pnl_date DESC, symbol LIMIT 500")
    out["running_pnl_lineitem_all"] = _q(li_views, "SELECT * FROM run_view")
    out["top_by_month"] = _q(ev_views, "SELECT * FROM top_view")
    out["top_by_month_lineitem"] = _q(li_views, "SELECT * FROM top_view")
    out["top_by_month_filtered"] = _q(
        ev_views, "SELECT * FROM top_view WHERE pnl_rank <= 5 AND month = DATE '2024-01-01' ORDER BY month DESC, pnl_rank")
    out["top_by_month_lineitem_top3"] = _q(
        li_views, "SELECT * FROM top_view WHERE pnl_rank <= 3 ORDER BY month DESC, pnl_rank")
    out["instrument_list"] = _q([EVENTS_DIM], "SELECT instrument_id, symbol, asset_class, currency FROM events_dim ORDER BY symbol")
    out["stats"] = _q(ev_book, """SELECT (SELECT count(*) FROM events_feed) AS trade_rows,
       (SELECT count(*) FROM ev_valid) AS valid_trade_rows,
       (SELECT count(*) FROM b_pnl) AS daily_pnl_rows,
       (SELECT count(*) FROM events_dim) AS instrument_rows,
       (SELECT max(executed_at) FROM events_feed) AS watermark_at,
       (SELECT count(*) FROM events_feed) - (SELECT count(*) FROM ev_valid) AS invalid_rows""")
    out["serving_rows"] = _q(ev_views, f"""SELECT strftime(pnl_date, '%Y-%m-%d') AS pnl_date, instrument_id, symbol,
       asset_class, trade_count, CAST(closing_position AS DOUBLE) AS closing_position,
       CAST(avg_cost AS DOUBLE) AS avg_cost, CAST(close_price AS DOUBLE) AS close_price,
       CAST(realised_pnl AS DOUBLE) AS realised_pnl, CAST(unrealised_pnl AS DOUBLE) AS unrealised_pnl,
       CAST(cumulative_realised_pnl AS DOUBLE) AS cumulative_realised_pnl, CAST(total_pnl AS DOUBLE) AS total_pnl
FROM ({filt})""")
    out["feed_roundtrip"] = """SELECT 'E' || CAST(event_id AS VARCHAR) AS trade_id,
       CASE WHEN event_id % 667 = 5 THEN '-1' ELSE CAST(user_id + 1 AS VARCHAR) END AS instrument_id,
       CASE WHEN event_type = 'purchase' THEN 'BUY' WHEN event_type = 'signup' THEN 'buy'
            WHEN event_type IN ('view', 'click') THEN 'SELL' WHEN event_type = 'error' THEN 'B' END AS side,
       CASE WHEN event_id % 500 = 11 THEN '0' ELSE CAST(event_id % 97 + 1 AS VARCHAR) END AS quantity,
       CASE WHEN event_id % 400 = 3 THEN '' ELSE CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR) END AS price,
       CASE WHEN event_id % 1250 = 9 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS executed_at
FROM events"""
    number = "CAST(event_id % 97 + 1 AS VARCHAR)"
    out["coerce_dirty_text"] = f"""WITH raw AS (
  SELECT 'E' || event_id AS trade_id,
         CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'x' || user_id WHEN 2 THEN '99999999999' ELSE CAST(user_id AS VARCHAR) END AS i,
         CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'Sell' ELSE upper(event_type) END AS s,
         CASE event_id % 11 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '1,000' WHEN 3 THEN {number} || '.50009'
              WHEN 4 THEN '-' || {number} WHEN 5 THEN {number} || 'x' ELSE {number} END AS q,
         CASE event_id % 13 WHEN 0 THEN 'n/a' WHEN 1 THEN '12.3.4' WHEN 2 THEN '' WHEN 3 THEN '0.0000005' ELSE CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR) END AS p,
         CASE event_id % 17 WHEN 0 THEN '2024-02-30T10:00:00' WHEN 1 THEN 'yesterday' WHEN 2 THEN '' WHEN 3 THEN '2024-01-05'
              WHEN 4 THEN '2024-13-01T00:00:00' WHEN 5 THEN strftime(ts, '%Y%m%dT%H%M%S') WHEN 6 THEN strftime(ts, '%Y-%m-%d %H%M') || '+0130'
              WHEN 7 THEN strftime(ts, '%GW%V%uT%H%M%S') WHEN 8 THEN '2024-W' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0')
              WHEN 9 THEN strftime(ts, '%Y-%m-%dT%H:%M%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS t,
         -- What the odd forms mean, from the time they were written from: to the second, less an offset, or the Monday of a week of 2024.
         CASE event_id % 17 WHEN 5 THEN date_trunc('second', ts) WHEN 7 THEN date_trunc('second', ts)
              WHEN 6 THEN date_trunc('minute', ts) - INTERVAL 90 MINUTE
              WHEN 8 THEN CASE WHEN event_id % 60 BETWEEN 1 AND 52 THEN TIMESTAMP '2024-01-01 00:00:00' + (event_id % 60 - 1) * INTERVAL 7 DAY END
         END AS odd
  FROM events)
SELECT trade_id, TRY_CAST(i AS INTEGER) AS instrument_id, nullif(s, '') AS side, TRY_CAST(q AS DECIMAL(18,4)) AS quantity,
       TRY_CAST(p AS DECIMAL(18,6)) AS price, CASE WHEN CAST(substr(trade_id, 2) AS BIGINT) % 17 BETWEEN 5 AND 9 THEN odd ELSE TRY_CAST(t AS TIMESTAMP) END AS executed_at,
       'dirty' AS source_file FROM raw"""
    out["feed_of_two_headers"] = out["feed_roundtrip"]
    out["sql_views"] = _q(ev_views, """SELECT v.pnl_date, v.symbol, v.cumulative_realised_pnl, t.pnl_rank,
       (SELECT count(*) FROM ev_valid) AS valid_rows
FROM run_view v JOIN top_view t ON t.instrument_id = v.instrument_id AND t.month = date_trunc('month', v.pnl_date)""")
    out["loaded_trades"] = _q([LINEITEM_FEED, LINEITEM_TRADES], "SELECT * FROM li_trades")
    out["trade_pipeline"] = out["stats"].replace("'events.parquet'", "'trades.csv'")
    split = "TIMESTAMP '1998-01-01 00:00:00'"
    two = [LINEITEM_FEED, last_copy("li_a", "li_feed", f"executed_at < {split}"),
           last_copy("li_b", "li_feed", "executed_at IS NULL OR executed_at > (SELECT max(executed_at) FROM li_a)")]
    out["incremental_load"] = _q(
        two, "SELECT * FROM li_b UNION ALL SELECT * FROM li_a WHERE trade_id NOT IN (SELECT trade_id FROM li_b)")
    out["etl_watermark"] = _q(two, """SELECT 'trades_csv' AS stream,
       greatest((SELECT max(executed_at) FROM li_a), (SELECT max(executed_at) FROM li_b)) AS watermark_at,
       (SELECT count(*) FROM li_a) + (SELECT count(*) FROM li_b) AS rows_loaded""")
    li_since = valid_cte("li_since", "li_trades", "seed_dim", "DATE '2000-01-01'")
    out["pnl_job_since"] = _q(
        li_book + [li_since] + book_ctes("li_since", "s"),
        f"SELECT {PNL_COLS} FROM s_pnl UNION ALL SELECT {PNL_COLS} FROM b_pnl "
        "WHERE (pnl_date, instrument_id) NOT IN (SELECT (pnl_date, instrument_id) FROM s_pnl)")
    two_trades = """li_two AS (SELECT * FROM li_b UNION ALL SELECT * FROM li_a WHERE trade_id NOT IN (SELECT trade_id FROM li_b))"""
    out["pnl_after_two_loads"] = _q([*two, two_trades, SEED_DIM, valid_cte("two_valid", "li_two", "seed_dim")]
                                    + book_ctes("two_valid", "t"), "SELECT * FROM t_pnl")
    out["daily_pnl_refreshed"] = out["daily_pnl"]
    sent_again = """li_again AS (SELECT * REPLACE (price + 1 AS price) FROM li_feed WHERE instrument_id = 7 AND executed_at < TIMESTAMP '1996-01-01 00:00:00')"""
    corrected = """li_now AS (SELECT * FROM li_new UNION ALL SELECT * FROM li_trades WHERE trade_id NOT IN (SELECT trade_id FROM li_new))"""
    out["daily_pnl_refreshed_lineitem"] = _q(
        li_book + [sent_again, last_copy("li_new", "li_again"), corrected, valid_cte("now_valid", "li_now", "seed_dim")]
        + book_ctes("now_valid", "n"),
        f"SELECT {PNL_COLS} FROM n_pnl UNION ALL SELECT {PNL_COLS} FROM b_pnl "
        "WHERE (pnl_date, instrument_id) NOT IN (SELECT (pnl_date, instrument_id) FROM n_pnl)")
    out["streaming_load"] = _q([EVENTS_FEED], "SELECT * REPLACE ('stream-epoch-0' AS source_file) FROM events_feed")
    return out
