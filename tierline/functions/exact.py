"""Sums and averages of doubles that do not depend on the order of the rows.

Adding doubles gives a result that changes with the partitioning, and a rounded
average can then land on either side of a half unit. A value is therefore taken
as the decimal number it prints as:

* Most values have few decimals. They are whole numbers of 1/10000 units, added
  up in two ``bigint`` columns (high and low part), so that no order of rows can
  overflow: plain hash aggregates with map-side combine in generated code.
* A value with more decimals is added up as a decimal with 14 of them.
* A value from 10^11 to 10^22 in size is added up as a decimal with 6, which is more
  than it has.
* What has no such form (NaN, infinity, values from 10^22, digits past the 14th) is
  added up as a double and added to the rest at the end. Only there, with values from
  10^22, can the order of the rows move the last digit.

Which way a value goes depends on that value alone. A measure is aggregated into:

================  =======================================================
``<m>__high``     sum of the units divided by 2^26, rounded down
``<m>__low``      sum of what that leaves
``<m>__fine``     sum of the values with more decimals
``<m>__wide``     sum of the large values
``<m>__float``    sum of the values, or parts, without a decimal form
``<m>__floats``   how many values have such a part
``<m>__n``        how many values are not NULL
================  =======================================================
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals of a unit; the usual values have no more. A choice of speed only.
DECIMALS = 4
#: Decimals that are added up exactly.
FINE = 14
#: Bits of the low part; the sizes from which values count as large and as floating.
_LOW = 26
_LARGE, _HUGE = 1e11, 1e22
#: Decimals of the large values.
_WIDE = 6
#: Sums of digits past the 14th are taken to this part of 1; their order is noise below.
_QUANTUM = 2.0**80


def _partial_names(measure: str) -> tuple[str, ...]:
    return tuple(f"{measure}__{p}" for p in ("high", "low", "fine", "wide", "float", "floats", "n"))


def partials(measures: Iterable[str], decimals: int = DECIMALS) -> list[Column]:
    """Aggregates that turn value columns into partial columns."""
    scale = float(10**decimals)
    result = []
    for measure in measures:
        value = F.col(measure).cast("double")
        bounded = F.abs(value) < _LARGE  # false for NaN too
        small = F.when(bounded, value).otherwise(F.lit(0.0))
        units = F.rint(small * scale).cast("bigint")
        whole = units.cast("double") / scale == small
        fine = F.when(~whole, small.cast(f"decimal(26,{FINE})"))
        large = ~bounded & (F.abs(value) < _HUGE)
        wide = F.when(large, value.cast(f"decimal(28,{_WIDE})"))
        left = F.when(~whole, small - fine.cast("double")).otherwise(F.lit(0.0))
        floating = F.when(bounded, left).when(large, F.lit(0.0)).otherwise(value)
        floats = F.count_if((~bounded & ~large) | (left != 0))
        columns = (
            F.sum(F.when(whole, F.shiftright(units, _LOW)).otherwise(F.lit(0).cast("bigint"))),
            F.sum(
                F.when(whole, units.bitwiseAND(F.lit(2**_LOW - 1).cast("bigint"))).otherwise(
                    F.lit(0).cast("bigint")
                )
            ),
            F.sum(fine),
            F.sum(wide),
            F.sum(floating),
            floats,
            F.count(value),
        )
        result += [c.alias(name) for c, name in zip(columns, _partial_names(measure))]
    return result


def total(measure: str, digits: int = 2, decimals: int = DECIMALS) -> Column:
    """``round(sum(measure), digits)`` from the partial columns; NULL without values."""
    return _rounded(measure, F.lit(1).cast("bigint"), digits, decimals)


def average(measure: str, digits: int = 2, decimals: int = DECIMALS) -> Column:
    """``round(avg(measure), digits)`` from the partial columns; NULL without values."""
    return _rounded(measure, F.col(f"{measure}__n"), digits, decimals)


def _rounded(measure: str, count: Column, digits: int, decimals: int) -> Column:
    if not 0 <= digits <= FINE:
        raise ValueError(f"digits must be between 0 and {FINE}, not {digits}")
    high, low, fine, wide, floating, floats, n = map(F.col, _partial_names(measure))
    units = high.cast("decimal(20,0)") * F.lit(2**_LOW) + low.cast("decimal(20,0)")
    # Both parts in units of the last exact decimal, as whole numbers.
    whole = (units * F.lit(10 ** (FINE - decimals)).cast("decimal(15,0)")).cast("decimal(38,0)")
    extra = F.coalesce(fine * F.lit(10**FINE).cast("decimal(15,0)"), F.lit(0)).cast("decimal(38,0)")
    exact = (whole + extra).cast("decimal(38,0)")
    divisor = F.nullif(count, F.lit(0).cast("bigint"))
    settled = F.when(F.abs(floating) < 1, F.rint(floating * _QUANTUM) / _QUANTUM).otherwise(floating)
    large = F.coalesce(wide.cast("double"), F.lit(0.0))
    as_double = large + exact.cast("double") / float(10**FINE) + settled
    inexact = F.round(as_double / divisor.cast("double"), digits)
    return F.when(n == 0, F.lit(None).cast("double")).otherwise(
        F.when((floats > 0) | wide.isNotNull(), inexact).otherwise(_half_up(exact, divisor, digits))
    )


def _half_up(exact: Column, count: Column, digits: int) -> Column:
    """``exact / count`` rounded half away from zero, in whole-number steps."""
    step = F.lit(10 ** (FINE - digits)).cast("decimal(15,0)")
    divisor = (count.cast("decimal(19,0)") * step).cast("decimal(38,0)")
    size = F.abs(exact)
    rest = size % divisor
    rounded = F.call_function("div", size - rest, divisor) + F.when(
        rest >= divisor - rest, F.lit(1)
    ).otherwise(F.lit(0))
    value = rounded.cast("double") / F.lit(float(10**digits))
    return F.when(exact < 0, -value).otherwise(value)
