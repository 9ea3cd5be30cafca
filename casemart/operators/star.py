"""The star schema as one value: the fact and its five dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dates: DataFrame
    locations: DataFrame
    request_types: DataFrame
    departments: DataFrame
    statuses: DataFrame
    # The sums of the fact at the grains of the marts, if they are stored; those of a part of the fact are not.
    sums: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        """The six tables by name."""
        return {
            "dim_date": self.dates,
            "dim_location": self.locations,
            "dim_request_type": self.request_types,
            "dim_department": self.departments,
            "dim_status": self.statuses,
            "fact_service_requests": self.fact,
        }


def keep_keys(fact: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """The fact rows whose `key` is in the one-column dimension rows `chosen`.

    A semi join, with the range of the chosen keys as a filter on the scan. Keys
    are numbered in the order of the names and the fact is sorted by keys, so
    parquet skips most of what a department, a category or a district leaves out.
    The two ends of the range are subqueries: Spark runs them when it runs the
    query, and the scan gets their values.
    """
    # Top rows and not min and max: Spark would merge those into one subquery, whose parts no scan understands.
    lowest, highest = (chosen.orderBy(order(key)).limit(1).scalar() for order in (F.asc, F.desc))
    return fact.filter(F.col(key).between(lowest, highest)).join(chosen, key, "left_semi")
