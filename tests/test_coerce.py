"""Coercion matches Python's parsers on the forms a feed uses; unparseable -> NULL."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import coerce as C

CASES = [
    "2024-01-01T10:00:00+00:00", "2024-01-01 10:00", "2024-01-01T10", "20240101T10:00:00Z", "2024-01-01",
    "2024-01-01T10:00:00.5", "2024-01-01T10:00:00,123", "2024-01-01T23:30:00-05:00", "2024-02-30T10:00:00",
    "2024", "2024-1-1", "10:00", "2024-01-01T10:00:00+0530", "2024-01-01T10:00:00+05",
    "1969-12-31T23:59:59.999999+00:00", "2024-01-01T24:00:00", "", " 2024-01-01",
    "2024-01-01T10:00:00+05:30:15", "2024-01-01T10:00:00.1234567", "2024-13-01", "2024-01-01T10:60",
    # Times without colons, and colons in one place only.
    "2024-01-01T101530", "2024-01-01T1015", "20240101T101530.25", "20240101 101530,5+0530", "2024-01-01T10:15:30+053015",
    "2024-01-01T10:1530", "2024-01-01T1015:30", "2024-01-01T10:15:30+05:3015", "2024-01-01T10:15:30+0530:15", "2024-01-01T101560",
    "2024-01-01T1015-05:00", "2024-01-01T10153", "20240101T", "2024-01-01T10+05:30",
    # Weeks: first and last ones, years of 52 and 53 weeks, days in the next or the former year.
    "2024-W01", "2024W01", "2024-W01-1", "2024W017", "2020-W53-5", "2021-W53-1", "2024-W53", "2015-W53-7", "2009-W01-1",
    "2024-W00", "2024-W54-1", "2024-W10-0", "2024-W10-8", "2024-W1-1", "2024-W10-3T10:15:30", "2024W103T101530+02", "2024-W10T10",
    "2026-W53-4 23:59:59.999999-12:00", "2024-W10-3T10:1530", "0001-W01-1", "W10-3", "2024-w10-3",
]


def _py(v):
    if not v:
        return None
    try:
        p = dt.datetime.fromisoformat(v)
    except ValueError:
        return None
    return p if p.tzinfo else p.replace(tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_match_fromisoformat(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(v,) for v in CASES], "s string")
        got = {r.s: (r.us, r.d) for r in df.select(
            "s", F.unix_micros(C.parse_iso_timestamp("s")).alias("us"),
            C.utc_date(C.parse_iso_timestamp("s")).alias("d")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    for v in CASES:
        p = _py(v)
        want = None if p is None else (p - epoch) // dt.timedelta(microseconds=1)
        assert got[v][0] == want, v
        assert got[v][1] == (None if p is None else p.astimezone(dt.timezone.utc).date()), v


def test_numbers_parse_like_python(spark):
    df = spark.createDataFrame([("1_000", " 7 ", "1.0", "1e3", "x", "12.34567", "-0.00005", "")],
                               "a string, b string, c string, d string, e string, f string, g string, h string")
    ints = df.select(*[C.parse_int(C.blank_to_null(c)).alias(c) for c in df.columns]).first()
    assert tuple(ints) == (1000, 7, None, None, None, None, None, None)
    qty = df.select(*[C.parse_quantity(C.blank_to_null(c)).alias(c) for c in df.columns]).first()
    assert qty.a == Decimal("1000.0000") and qty.c == Decimal("1.0000") and qty.d == Decimal("1000.0000")
    assert qty.e is None and qty.h is None
    assert qty.f == Decimal("12.3457") and qty.g == Decimal("-0.0001")  # half away from zero


def test_utc_wallclock_is_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.createDataFrame([("2024-01-01T23:30:00-05:00",)], "s string").select(
            C.utc_wallclock(C.parse_iso_timestamp("s")).alias("w")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.w == dt.datetime(2024, 1, 2, 4, 30)
