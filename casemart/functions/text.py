"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """Remove Unicode whitespace from both ends; NULL stays NULL."""
    return F.btrim(column, F.lit(WHITESPACE))


def place_label(code: Column, name: Column) -> Column:
    """`code (name)`, or the code alone when there is no name."""
    return F.when(name.isNull(), code).otherwise(F.concat(code, F.lit(" ("), name, F.lit(")")))


def grouped_digits(column: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(column, 0)
