"""Column functions that turn feed strings into typed values without ever raising.

Every function here is a pure Column -> Column expression built from Spark
built-ins, so it runs inside whole-stage codegen and never leaves the JVM.
A value that does not parse becomes NULL: the loader lands every row, and the
valid-trade rule decides later what is usable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PRICE_TYPE, QTY_TYPE

MICROS_PER_DAY = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """'' (and NULL) -> NULL, anything else unchanged (no trimming)."""
    c = _col(c)
    return F.when(c != F.lit(""), c)


def _strip_digit_underscores(c: Column) -> Column:
    # Python's numeric constructors accept '1_000'; keep parity for that one form.
    # The regex only runs on the rare values that contain an underscore.
    return F.when(c.contains("_"), F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")).otherwise(c)


def parse_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Decimal parse, rounded half away from zero to ``scale``; bad or out of range -> NULL."""
    return _strip_digit_underscores(_col(c)).try_cast(f"decimal({precision},{scale})")


def parse_quantity(c: Column | str) -> Column:
    return parse_decimal(c, QTY_TYPE.precision, QTY_TYPE.scale)


def parse_price(c: Column | str) -> Column:
    return parse_decimal(c, PRICE_TYPE.precision, PRICE_TYPE.scale)


def parse_int(c: Column | str) -> Column:
    """Integer parse: surrounding blanks allowed, '1.0' and overflow -> NULL."""
    return _strip_digit_underscores(_col(c)).try_cast("int")


# Accepted ISO-8601 forms (those of Python's datetime.fromisoformat): date 'YYYY-MM-DD' or
# 'YYYYMMDD', or a week 'YYYY-Www', 'YYYY-Www-D', 'YYYYWww', 'YYYYWwwD' (Monday if no day is
# given); optional time after 'T' or ' ' as HH, HH:MM, HH:MM:SS or HH:MM:SS.f (6 digits of f
# count, '.' or ','), its colons all there or all left out; optional offset 'Z', +HH, +HHMM,
# +HH:MM, +HHMMSS or +HH:MM:SS.  No offset means UTC.
_TIME = (
    r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)
_ISO = r"^(\d{4}-\d{2}-\d{2}|\d{8})" + _TIME
_WEEK = r"^\d{4}(?:-W\d{2}(?:-[1-7])?|W\d{2}[1-7]?)(?:[T ].*)?$"
# Colons in one place of a time or offset and none in another.
_MIXED = r"(?:^[\dW-]{7,10}[T ]|^.{11,}[+-])(?:\d{2}:\d{4}|\d{4}:\d{2})"


# The full form a feed normally carries: Spark's cast reads it as is (naive -> append Z).
_FULL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?$"


def _calendar_form(s: Column) -> Column:
    """Any accepted form with a calendar date -> 'yyyy-MM-dd HH:mm:ss.f<offset>'.

    The chain is linear (no sub-expression is used twice), so the generated code
    stays small even when the optimizer inlines it into several operators.
    """
    x = F.regexp_replace(s, _ISO, "$1|$2|$3|$4|$5|$6")
    # Fields can only be missing from the right: fill them.
    x = F.regexp_replace(x, r"^([^|]*)\|\|\|\|\|", "$1|00|00|00|0|")
    x = F.regexp_replace(x, r"^([^|]*\|\d\d)\|\|\|", "$1|00|00|0")
    x = F.regexp_replace(x, r"^([^|]*\|\d\d\|\d\d)\|\|", "$1|00|0")
    x = F.regexp_replace(x, r"^([^|]*\|\d\d\|\d\d\|\d\d)\|\|", "$1|0|")
    x = F.regexp_replace(x, r"\|$", "|Z")
    return F.regexp_replace(
        x, r"^(\d{4})-?(\d\d)-?(\d\d)\|(\d\d)\|(\d\d)\|(\d\d)\|(\d+)\|([Z+-]\d{0,2}):?(\d{0,2}):?(\d{0,2})$",
        "$1-$2-$3 $4:$5:$6.$7$8$9$10"
    )


def _week_to_calendar(s: Column) -> Column:
    """A week form with its date written as a calendar date; NULL where the year has no such week."""
    part = lambda group: F.regexp_extract(s, r"^(\d{4})-?W(\d{2})-?([1-7]?)(.*)$", group)
    year, week = part(1).cast("int"), part(2).cast("int")
    day = F.coalesce(F.nullif(part(3), F.lit("")).cast("int"), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in week 1; the 28th of December always in the last week
    exists = (year >= 1) & (week >= 1) & (week <= F.weekofyear(F.make_date(year, F.lit(12), F.lit(28))))
    monday = F.date_sub(fourth, F.weekday(fourth))
    return F.when(exists, F.concat(F.date_format(F.date_add(monday, (week - 1) * 7 + day - 1), "yyyy-MM-dd"), part(4)))


def parse_iso_timestamp(c: Column | str) -> Column:
    """ISO text -> TimestampType instant, NULL when it does not parse.

    The regex guard keeps the accepted set strict (a bare cast takes '2024',
    '2024-1-1', '10:00').  A well-formed value is rewritten by a short chain of
    regex replacements - split into fields, fill the missing trailing time
    fields, default the offset to UTC - which ``try_cast`` checks for calendar
    validity (Feb 30, hour 24 -> NULL).  Values already in the full
    'yyyy-MM-ddTHH:mm:ss[.f][offset]' form skip the chain: one match and the cast.
    """
    s = _col(c)
    # In the full form an offset is 'Z' or '+HH:MM' / '-HH:MM': its sign sits 6 from the end,
    # where a naive value always has a digit, ':' or '.'.
    zoned = (F.substring(s, -1, 1) == "Z") | F.substring(s, -6, 1).isin("+", "-")
    full = F.when(zoned, s).otherwise(F.concat(s, F.lit("Z")))
    return F.when(s.rlike(_FULL), full.try_cast("timestamp")).otherwise(_interpreted(s, _other_form))


def _other_form(s: Column) -> Column:
    return (F.when(s.rlike(_MIXED), F.lit(None).cast("timestamp"))
            .when(s.rlike(_ISO), _calendar_form(s).try_cast("timestamp"))
            .when(s.rlike(_WEEK), _calendar_form(_week_to_calendar(s)).try_cast("timestamp")))


def _interpreted(s: Column, form: Callable[[Column], Column]) -> Column:
    """form(s) outside generated code, which a long rare branch would make too large for the JIT compiler."""
    return F.element_at(F.transform(F.array(s), form), 1)


def utc_date(ts: Column | str) -> Column:
    """Calendar date of an instant in UTC, independent of the session time zone."""
    seconds = F.unix_seconds(_col(ts))  # floors, so instants before 1970 stay on the right day
    return F.date_from_unix_date(F.floor(seconds / F.lit(86_400)).cast("int"))


def utc_wallclock(ts: Column | str) -> Column:
    """Instant -> TIMESTAMP_NTZ holding its UTC wall-clock time (zone-free output)."""
    micros_of_day = F.pmod(F.unix_micros(_col(ts)), F.lit(MICROS_PER_DAY))
    return F.timestamp_add("MICROSECOND", micros_of_day, utc_date(ts).cast("timestamp_ntz"))
