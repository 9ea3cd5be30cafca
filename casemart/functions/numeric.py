"""Exact arithmetic: decimals and whole numbers, one rounding, then a double."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600


def hours_between(start: Column, end: Column) -> Column:
    """Hours from start to end as decimal(23,11).

    The times have no zone and are subtracted as such, so the session's zone and
    its clock changes play no part. A microsecond is 2.8e-10 hours: eleven digits
    decide every comparison with, and every rounding to, two digits as the exact
    quotient would.
    """
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return seconds / F.lit(SECONDS_PER_HOUR).cast("decimal(4,0)")


def _rounded_units(numerator: Column, denominator: Column, digits: int) -> Column:
    """|numerator / denominator| in units of 10**-digits, half rounded up.

    The rounding is a whole-number division, so no intermediate quotient is cut
    off however large the counts are. NULL when the denominator is 0.
    """
    divisor = F.nullif(denominator.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    twice = F.abs(numerator) * F.lit(2 * 10**digits).cast("decimal(8,0)")
    return F.call_function("div", twice + divisor, divisor * F.lit(2).cast("decimal(1,0)"))


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """numerator / denominator rounded half away from zero, as a double."""
    sign = F.signum(numerator).cast("int")
    return sign * _rounded_units(numerator, denominator, digits) / F.lit(float(10**digits))


def decimal_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Like `ratio`, as decimal(10, digits)."""
    sign = F.signum(numerator).cast("int")
    units = (sign * _rounded_units(numerator, denominator, digits)).cast("decimal(20,0)")
    return (units * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(10,{digits})")


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole to two digits; NULL when whole is 0."""
    return ratio(part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)"), whole)


def total(column: Column) -> Column:
    """A sum that is 0, not NULL, over no rows."""
    return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))


_LOW_BITS = 20


def _half_sums(column: str, digits: int) -> tuple[Column, Column]:
    """Two whole-number sums that together are the exact sum of a decimal(10, digits).

    Adding up longs takes half the time of adding up decimals. A double holds ten
    digits with millionths to spare, so rounding it gives the exact units. Their
    low bits are added up apart from the rest, so that neither sum can overflow
    before eight trillion rows.
    """
    units = F.rint(F.col(column).cast("double") * 10**digits).cast("bigint")
    low = units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return F.sum(F.shiftright(units, _LOW_BITS)), F.sum(low)


def _joined(high: Column, low: Column, digits: int) -> Column:
    weight = F.lit(1 << _LOW_BITS).cast("decimal(7,0)")
    units = high.cast("decimal(20,0)") * weight + low.cast("decimal(20,0)")
    return units * F.lit(Decimal(1).scaleb(-digits))


def exact_sum(column: str, digits: int) -> Column:
    """The sum of a decimal(10, digits), as a decimal."""
    return _joined(*_half_sums(column, digits), digits)


def part_sums(column: str, name: str, digits: int = 2) -> list[Column]:
    """The sum of a decimal(10, digits) in two columns that can be added up again."""
    high, low = _half_sums(column, digits)
    return [high.alias(f"{name}_high"), low.alias(f"{name}_low")]


def whole_sum(name: str, digits: int = 2) -> Column:
    """The decimal sum that rows of `part_sums` stand for."""
    return _joined(F.sum(f"{name}_high"), F.sum(f"{name}_low"), digits)
