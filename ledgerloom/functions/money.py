"""Exact decimal forms for average-cost PnL.

The accounting is  realised = (price - cost/qty) * quantity  and
unrealised = (close - cost/qty) * position, rounded half away from zero at scale
10; the caller sums at scale 10 and rounds once more to the column's scale 6.

Spark decimals have 38 digits, fewer than the products above need in general.
Where price, quantities and result are of ordinary size (``_FITS``), one exact division
of n * units by qty does, with n = price * qty - cost:

    rounded = (2 * |n| * units + d) div (2 * d),   d = qty in units of the last digit.

Beyond that the division is carried out in steps that are each exact.  With ``a`` the average
cost cut to 6 digits, ``r`` the rest of that division and ``u`` the quantity in
units of 0.0001,

    (price - cost/qty) * u  =  (price - a) * u  -  r * u / qty',

where qty' is the quantity in units of the average's last digit.  ``r * u / qty'``
is divided like on paper, nine digits of ``u`` at a time, and the last rest
decides the rounding.

Every step is a column of its own, selected before the next one uses it: Catalyst
does not merge a projection into the next if that would repeat work, so each step
is planned and computed once.  A row that does not need a step has NULL operands in it.

Domain: every price the column holds (< 1e12), every quantity and position it
holds (< 1e14), cumulative buy quantity < 1e20, cumulative buy cost < 1e27.  A
position beyond its column's range gives NULL values in its own row, not an
error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PRICE_TYPE, QTY_TYPE

SCALE10 = "decimal(38,10)"
#: Cumulative buy cost, narrow enough that adding two keeps scale 10.
COST = "decimal(37,10)"
#: Cumulative quantity, narrow enough for the steps of the division.
QTY = "decimal(24,4)"
_CHUNK = 1_000_000_000
#: Results below this size (in units of the last digit a long) take the single division.
_FITS = 9e8


def _unit(scale: int) -> Column:
    """10 ** -scale as a decimal of that scale."""
    return F.lit(f"0.{'0' * (scale - 1)}1").cast(f"decimal({scale},{scale})")


def _whole(n: int, digits: int) -> Column:
    return F.lit(n).cast(f"decimal({digits},0)")


def _div(a: Column, b: Column) -> Column:
    """Whole part of a / b as a long; a and b not negative."""
    return F.call_function("div", a, b)


def _step(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select("*", *(c.alias(name) for name, c in columns.items()))


def add_average(df: DataFrame, name: str, cost: str, qty: str) -> DataFrame:
    """``name``: cost / qty rounded half away from zero to scale 6; NULL unless qty > 0."""
    c = F.col
    out = _step(df, _c=F.when(c(qty) > 0, c(cost)).cast(SCALE10), _d=(c(qty).cast(QTY) * _unit(6)).cast("decimal(24,10)"))
    out = _step(out, _w=_div(c("_c"), c("_d")).cast("decimal(18,0)"), _r=(c("_c") % c("_d")).cast("decimal(24,10)"))
    up = F.when(c("_r") + c("_r") >= c("_d"), _unit(6)).otherwise(F.lit(0).cast("decimal(6,6)"))
    return out.select(*df.columns, ((c("_w") * _unit(6)).cast("decimal(18,6)") + up).alias(name))


def add_value(df: DataFrame, name: str, price: str, cost: str, qty: str, units: Column, where: Column) -> DataFrame:
    """``name``: (price - cost / qty) * units, rounded half away from zero to scale 10; NULL unless ``where``.

    ``units`` must not be negative, ``qty`` must be positive where ``where`` holds.
    """
    c = F.col
    out = _step(df, _p=F.when(where, c(price)).cast("decimal(18,6)"), _c=F.when(where, c(cost)).cast(COST),
                _q=c(qty).cast(QTY), _u=units.cast("decimal(18,4)"))
    # Ordinary size: one division.
    out = _step(out, _qf=c("_q").try_cast("decimal(18,4)"), _uf=c("_u").try_cast("decimal(14,4)"))
    out = _step(out, _n=c("_p").try_cast("decimal(16,6)") * c("_qf") - c("_c").try_cast("decimal(34,10)"),
                _d=c("_qf") * _unit(10))
    out = _step(out, _a=F.abs("_n").try_cast("decimal(20,10)"))
    out = _step(out, _fits=F.coalesce(c("_a").cast("double") * c("_uf").cast("double") < F.lit(_FITS) * c("_qf").cast("double"), F.lit(False)))
    out = _step(out, _fast=F.when(c("_fits"), _div(c("_a") * c("_uf") * _whole(2, 1) + c("_d"), c("_d") * _whole(2, 1))),
                _cs=F.when(~c("_fits"), c("_c")).cast(SCALE10), _ds=(c("_q") * _unit(6)).cast("decimal(24,10)"),
                _us=F.when(~c("_fits"), (c("_u") * _whole(10_000, 5)).cast("long")))
    # Any size: steps.
    out = _step(out, _w=_div(c("_cs"), c("_ds")).cast("decimal(18,0)"), _r=(c("_cs") % c("_ds")).cast("decimal(24,10)"),
                _high=_div(c("_us"), F.lit(_CHUNK)).cast("decimal(10,0)"), _low=(c("_us") % _CHUNK).cast("decimal(10,0)"))
    out = _step(out, _first=c("_r") * c("_high"))
    out = _step(out, _q1=_div(c("_first"), c("_ds")), _r1=(c("_first") % c("_ds")).cast("decimal(24,10)"))
    out = _step(out, _second=c("_r1") * _whole(_CHUNK, 10) + c("_r") * c("_low"))
    out = _step(out, _q2=_div(c("_second"), c("_ds")), _r2=(c("_second") % c("_ds")).cast("decimal(24,10)"))
    average = (c("_w") * _unit(6)).cast("decimal(18,6)")
    taken = (c("_q1") * _CHUNK + c("_q2")).cast("decimal(19,0)") * _unit(10)
    out = _step(out, _exact=(((c("_p") - average) * c("_u")).cast("decimal(37,10)") - taken).cast("decimal(37,10)"))
    # What is left to subtract is r2 / d of the last digit: half or more goes away from zero.
    up = F.when(c("_exact") > 0, c("_r2") + c("_r2") > c("_ds")).otherwise(c("_r2") + c("_r2") >= c("_ds"))
    slow = (c("_exact") - F.when(up, _unit(10)).otherwise(F.lit(0).cast("decimal(10,10)"))).cast(SCALE10)
    fast = (c("_fast").cast("decimal(19,0)") * _unit(10)).cast(COST)
    # 0 - x of the narrower type: a difference of two 38 digit decimals would lose a digit of scale.
    signed = F.when(c("_n") < 0, (F.lit(0).cast(COST) - fast).cast(SCALE10)).otherwise(fast.cast(SCALE10))
    return out.select(*df.columns, F.when(~c("_fits"), slow).otherwise(signed).alias(name))


def add_unrealised(df: DataFrame, name: str, close: str, cum_cost: str, cum_qty: str, position: str) -> DataFrame:
    """``name``: (close - cum_cost / cum_qty) * position at scale 10; zero without buys, NULL where the position is out of its range."""
    out = _step(df, _held=F.col(position).try_cast(QTY_TYPE))
    bought = F.col(cum_qty) > 0
    out = add_value(out, "_value", close, cum_cost, cum_qty, F.abs("_held"), bought)
    # 0 - x, since unary minus rounds to 34 digits.
    value = F.when(F.col("_held") < 0, (F.lit(0).cast(COST) - F.col("_value").cast(COST)).cast(SCALE10)).otherwise(F.col("_value"))
    return out.select(*df.columns, F.when(bought, value).otherwise(zero10()).alias(name))


def add_realised(df: DataFrame, name: str, price: str, quantity: str, prior_cost: str, prior_qty: str, sells: Column) -> DataFrame:
    """``name``: (price - prior_cost / prior_qty) * quantity at scale 10 where ``sells`` and something was bought; else zero."""
    out = _step(df, _sells=sells & F.coalesce(F.col(prior_qty) > 0, F.lit(False)))
    out = add_value(out, "_value", price, prior_cost, prior_qty, F.col(quantity), F.col("_sells"))
    return out.select(*df.columns, F.when(F.col("_sells"), F.col("_value")).otherwise(zero10()).alias(name))


def zero10() -> Column:
    return F.lit(0).cast(SCALE10)


def to_price(c: Column) -> Column:
    return c.try_cast(PRICE_TYPE)


def to_qty(c: Column) -> Column:
    return c.try_cast(QTY_TYPE)
