"""Trade feeds derived from the driver's tables by pure projection.

There is no trade table in the test data, so feeds are built from ``events``
(a dirty string feed: every defect class of the reference's generator) and
``lineitem`` (a larger feed with natural duplicate trade ids, many equal
timestamps and only 30 instruments - the skew case).  Every row of the source
is kept; the rules below only decide what each row looks like.  Each feed is
the six-string-column CSV shape, so it goes through the same coercion as a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.instruments import classify, seed_instruments

# Fixed values of the derivation rules (FIXTURES.md section 3).
ORPHAN_INSTRUMENT = "-1"  # ids of the dimension are positive, so it never becomes known
LINEITEM_INSTRUMENTS = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso_utc(ts_ntz: Column) -> Column:
    return F.concat(F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a dirty trade feed (all strings).

    trade_id 'E'+event_id; instrument user_id+1, an unknown id every 667th event;
    side from the event type (purchase BUY, signup 'buy', view/click SELL, error 'B');
    quantity 1 + event_id % 97, '0' every 500th; price = value, '' every 400th;
    executed_at ISO-8601 UTC with microseconds, '' every 1250th.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    side = (
        F.when(F.col("event_type") == "purchase", "BUY")
        .when(F.col("event_type") == "signup", "buy")
        .when(F.col("event_type").isin("view", "click"), "SELL")
        .when(F.col("event_type") == "error", "B")
    )
    return e.select(
        F.concat(F.lit("E"), eid.cast("string")).alias("trade_id"),
        F.when(eid % 667 == 5, F.lit(ORPHAN_INSTRUMENT))
        .otherwise((F.col("user_id") + 1).cast("string"))
        .alias("instrument_id"),
        side.alias("side"),
        F.when(eid % 500 == 11, F.lit("0")).otherwise((eid % 97 + 1).cast("string")).alias("quantity"),
        F.when(eid % 400 == 3, F.lit("")).otherwise(F.col("value").cast("decimal(18,6)").cast("string")).alias("price"),
        F.when(eid % 1250 == 9, F.lit("")).otherwise(_iso_utc(F.col("ts"))).alias("executed_at"),
    )


def _week_text(ts_ntz: Column) -> Column:
    """ISO week text of a time: the year of the week's Thursday, the week and the day, then a time without colons."""
    thursday = F.date_add(F.to_date(ts_ntz), F.lit(3) - F.weekday(ts_ntz))
    return F.concat(F.year(thursday).cast("string"), F.lit("W"), F.lpad(F.weekofyear(ts_ntz).cast("string"), 2, "0"),
                    (F.weekday(ts_ntz) + 1).cast("string"), F.date_format(ts_ntz, "'T'HHmmss"))


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as feed text that parses only in part: ids, numbers, sides and times of every malformed kind."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")

    def pick(modulus: int, odd: dict[int, Column | str], usual: Column) -> Column:
        out = F
        for rest, value in odd.items():
            out = out.when(eid % modulus == rest, F.lit(value) if isinstance(value, str) else value)
        return out.otherwise(usual)

    user, number = F.col("user_id").cast("string"), (eid % 97 + 1).cast("string")
    return e.select(
        F.concat(F.lit("E"), eid.cast("string")).alias("trade_id"),
        pick(7, {0: "", 1: F.concat(F.lit("x"), user), 2: "99999999999"}, user).alias("instrument_id"),
        pick(5, {0: "", 1: "Sell"}, F.upper("event_type")).alias("side"),
        pick(11, {0: "abc", 1: "", 2: "1,000", 3: F.concat(number, F.lit(".50009")), 4: F.concat(F.lit("-"), number),
                  5: F.concat(number, F.lit("x"))}, number).alias("quantity"),
        pick(13, {0: "n/a", 1: "12.3.4", 2: "", 3: "0.0000005"},
             F.col("value").cast("decimal(18,6)").cast("string")).alias("price"),
        pick(17, {0: "2024-02-30T10:00:00", 1: "yesterday", 2: "", 3: "2024-01-05", 4: "2024-13-01T00:00:00",
                  5: F.date_format("ts", "yyyyMMdd'T'HHmmss"), 6: F.concat(F.date_format("ts", "yyyy-MM-dd HHmm"), F.lit("+0130")),
                  7: _week_text(F.col("ts")), 8: F.concat(F.lit("2024-W"), F.lpad((eid % 60).cast("string"), 2, "0")),
                  9: F.date_format("ts", "yyyy-MM-dd'T'HH:mmss")},
             F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("executed_at"),
    )


def _letters(id_col: Column, n: int) -> Column:
    """n upper-case base-26 digits of a non-negative id, most significant first."""
    return F.concat(*[F.char(F.lit(65) + F.floor(id_col / F.lit(26**k)) % 26) for k in range(n - 1, -1, -1)])


def rule_symbol(id_col: Column) -> Column:
    """A symbol for a derived instrument id; the shape encodes the asset class.

    id % 3 == 0: six letters (an FX pair); id % 3 == 1: five letters and a
    contract suffix Z5 / H6 (a future); else seven letters (an equity).
    Unique for ids below 26**5 (futures), 26**6 (FX) and 26**7 (equities).
    """
    suffix = F.when(F.floor(id_col / 3) % 2 == 0, F.lit("Z5")).otherwise(F.lit("H6"))
    return (
        F.when(id_col % 3 == 0, _letters(id_col, 6))
        .when(id_col % 3 == 1, F.concat(_letters(id_col, 5), suffix))
        .otherwise(_letters(id_col, 7))
    )


def events_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension for the events feed: one instrument per distinct user (id user_id + 1)."""
    ids = table(spark, sf_dir, "events").select((F.col("user_id") + 1).alias("instrument_id")).distinct()
    return classify(ids.select("instrument_id", rule_symbol(F.col("instrument_id")).alias("symbol")))


def lineitem_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a trade feed, plus ``feed_order`` giving the file order.

    trade_id orderkey-linenumber (natural duplicates); instrument partkey % 30 + 1;
    side N -> BUY, R -> 'sell', A -> BUY when the line is open else 'A';
    quantity / price from l_quantity / l_extendedprice; executed_at the ship date
    as naive ISO text (UTC).  A later duplicate is one with a greater
    (shipdate, partkey, suppkey, extendedprice, quantity).
    """
    li = table(spark, sf_dir, "lineitem")
    side = (
        F.when(F.col("l_returnflag") == "N", "BUY")
        .when(F.col("l_returnflag") == "R", "sell")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "BUY")
        .otherwise(F.lit("A"))
    )
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("trade_id"),
        (F.col("l_partkey") % LINEITEM_INSTRUMENTS + 1).cast("string").alias("instrument_id"),
        side.alias("side"),
        F.col("l_quantity").cast("decimal(18,4)").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,6)").cast("string").alias("price"),
        F.col("l_shipdate").cast("string").alias("executed_at"),  # naive ISO text, read as UTC
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("feed_order"),
    )


def lineitem_instruments(spark: SparkSession) -> DataFrame:
    return seed_instruments(spark)
