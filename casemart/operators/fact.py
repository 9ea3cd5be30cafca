"""The ticket fact: dimension keys, times and service-level measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.calendar import date_key
from casemart.functions.numeric import hours_between
from casemart.session import input_bytes

FACT_COLUMNS = [
    "ticket_number", "created_date_key", "closed_date_key", "location_key",
    "request_type_key", "department_key", "status_key", "created_timestamp",
    "closed_timestamp", "resolution_time_hours", "target_sla_hours",
    "sla_variance_hours", "is_sla_breached", "is_repeat_incident",
    "satisfaction_rating",
]


# What a ticket names its dimension rows by.
NATURAL_KEYS = [
    "district_code", "neighborhood", "request_category", "request_type", "priority_level",
    "department_name", "division_name", "status",
]
RESOLVED = ["location_key", "request_type_key", "department_key", "status_key", "is_closed"]


def attach_keys(
    staging: DataFrame,
    locations: DataFrame,
    request_types: DataFrame,
    departments: DataFrame,
    statuses: DataFrame,
    how: str = "inner",
    dictionary: bool | None = None,
) -> DataFrame:
    """Look up the four dimension keys of each ticket.

    `inner` drops tickets that miss a dimension, `left` keeps them with a NULL key. The joins carry no hint.

    There are two plans. If all dimensions but one are small enough to be broadcast, each ticket is joined with the four
    of them: staging is shuffled once at most. If not, the distinct combinations of names are resolved first, in a
    `dictionary` that staging is joined with once; only combinations pass through the four joins. By default the size of
    the dimensions' files decides, before any job runs; a hot key is split by adaptive execution in either plan.
    """
    dimensions = (locations, request_types, departments, statuses)
    if dictionary is None:
        dictionary = sum(_too_large(dimension) for dimension in dimensions) > 1
    if not dictionary:
        return _joined(staging, *dimensions, how)
    resolved = _joined(staging.select(*NATURAL_KEYS).distinct(), *dimensions, how)
    named = resolved.select(*[F.col(name).alias(f"_{name}") for name in NATURAL_KEYS], *RESOLVED)
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in NATURAL_KEYS]
    return staging.join(named, reduce(Column.__and__, same)).drop(*[f"_{name}" for name in NATURAL_KEYS])


def _too_large(dimension: DataFrame) -> bool:
    """Whether Spark would not broadcast the files of a dimension."""
    spark = dimension.sparkSession
    threshold = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return input_bytes(dimension) > threshold


def _joined(
    tickets: DataFrame,
    locations: DataFrame,
    request_types: DataFrame,
    departments: DataFrame,
    statuses: DataFrame,
    how: str,
) -> DataFrame:
    """The tickets, or their names alone, joined with the four dimensions."""
    kinds = request_types.select(
        "request_category",
        F.col("request_type_name").alias("request_type"),
        "priority_level",
        "request_type_key",
    )
    return (
        tickets.join(
            locations.select("district_code", "neighborhood", "location_key"),
            ["district_code", "neighborhood"],
            how,
        )
        .join(kinds, ["request_category", "request_type", "priority_level"], how)
        .join(
            departments.select("department_name", "division_name", "department_key"),
            ["department_name", "division_name"],
            how,
        )
        .join(
            statuses.select(F.col("status_name").alias("status"), "status_key", "is_closed"), "status", how
        )
    )


def build_fact(
    staging: DataFrame,
    locations: DataFrame,
    request_types: DataFrame,
    departments: DataFrame,
    statuses: DataFrame,
    how: str = "inner",
    dictionary: bool | None = None,
) -> DataFrame:
    """One row per staged ticket.

    A breach is decided on the unrounded hours, and an open ticket has none.
    """
    dimensions = (locations, request_types, departments, statuses)
    return flagged_fact(staging, *dimensions, how=how, dictionary=dictionary).select(*FACT_COLUMNS)


def flagged_fact(
    staging: DataFrame,
    locations: DataFrame,
    request_types: DataFrame,
    departments: DataFrame,
    statuses: DataFrame,
    how: str = "inner",
    dictionary: bool | None = None,
) -> DataFrame:
    """The fact, and is_open: 1 if the ticket's status is a known one that is not closed, else 0."""
    keyed = attach_keys(staging, locations, request_types, departments, statuses, how, dictionary)
    hours = F.col("_hours")
    target = F.col("target_sla_hours")
    return (
        keyed.withColumn("_hours", hours_between(F.col("created_date"), F.col("closed_date")))
        .select(
            "ticket_number",
            date_key(F.col("created_date")).alias("created_date_key"),
            date_key(F.col("closed_date")).alias("closed_date_key"),
            "location_key",
            "request_type_key",
            "department_key",
            "status_key",
            F.col("created_date").alias("created_timestamp"),
            F.col("closed_date").alias("closed_timestamp"),
            F.round(hours, 2).cast("decimal(10,2)").alias("resolution_time_hours"),
            "target_sla_hours",
            F.round(hours - target, 2).cast("decimal(10,2)").alias("sla_variance_hours"),
            F.coalesce(hours > target, F.lit(False)).alias("is_sla_breached"),
            F.coalesce(F.col("is_repeat"), F.lit(False)).alias("is_repeat_incident"),
            "satisfaction_rating",
            F.coalesce(~F.col("is_closed"), F.lit(False)).cast("int").alias("is_open"),
        )
    )
