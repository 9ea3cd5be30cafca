"""Clean raw tickets: fill places, strip text, keep the first row of a ticket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.functions.text import strip

# Defaults for a missing place, and the text columns to strip.
PLACE_DEFAULTS = {
    "district_code": "DIST-UNKNOWN",
    "neighborhood": "Unknown Neighborhood",
    "zip_code": "00000",
}
STRIPPED = [
    "department_name", "division_name", "request_category",
    "request_type", "status", "priority_level",
]


def fill_places(tickets: DataFrame) -> DataFrame:
    """Replace a missing district, neighborhood or zip; empty text is kept."""
    return tickets.na.fill(PLACE_DEFAULTS)


def strip_text(tickets: DataFrame) -> DataFrame:
    """Strip the text columns that are present."""
    present = [name for name in STRIPPED if name in tickets.columns]
    return tickets.withColumns({name: strip(F.col(name)) for name in present})


def keep_first(tickets: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """One row per ticket number, the first by `arrival`; NULL is one ticket.

    Spark turns "row number = 1" into a group limit that runs before the shuffle
    too, so each map task sends at most one row per ticket. A ticket number that
    fills a third of the input therefore costs its reducer one row per map task.
    """
    in_order = Window.partitionBy("ticket_number").orderBy(*arrival)
    return (
        tickets.withColumn("_place", F.row_number().over(in_order))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def clean(tickets: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Fill, strip and deduplicate. Rows are dropped before they are edited.

    No rule touches the ticket number or the arrival columns, so deduplicating
    first gives the same rows and strips only the ones that stay.
    """
    return keep_first(tickets, arrival).transform(fill_places).transform(strip_text)
