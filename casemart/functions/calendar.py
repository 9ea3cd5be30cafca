"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(moment: Column) -> Column:
    """yyyymmdd as an int; arithmetic, so no text is formatted per row."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def as_date(value: date | str | Column | None) -> Column:
    """A date literal; None means the date on which the query runs."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")
