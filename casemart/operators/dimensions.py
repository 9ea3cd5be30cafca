"""Dimensions of the star schema, built from staged tickets.

The builders return rows without keys and run no job; the warehouse numbers the
rows when it stores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemart.functions import calendar
from casemart.functions.numeric import decimal_ratio, exact_sum, part_sums, whole_sum

# Fixed values of the dimension tables.
NORTH_DISTRICTS = ["DIST-01", "DIST-02"]
NORTH = "North Region"
SOUTH = "South Region"
DEPARTMENT_HEAD = "Dept Director"
TEAM_CAPACITY = 30
CLOSED_PREFIX = "Closed"
DAYS_BEFORE = 30
DAYS_AFTER = 60


# The key of each dimension, and the columns whose order it follows.
KEYS = {
    "dim_location": ("location_key", ["district_code", "neighborhood"]),
    "dim_request_type": (
        "request_type_key", ["request_category", "request_type_name", "priority_level"],
    ),
    "dim_department": ("department_key", ["department_name", "division_name"]),
    "dim_status": ("status_key", ["status_name"]),
}


def number_rows(rows: DataFrame, order: Sequence[str], name: str, path: str) -> DataFrame:
    """Add `name` = 1..n in the order of `order`, without one task seeing all rows.

    The rows are sorted across partitions and written to the folder `path` with
    an increasing id whose high bits name the partition. The sizes of the
    partitions before it then turn a row's place in its partition into its place
    in the table. The caller owns the folder, which the result reads.
    """
    spark = rows.sparkSession
    placed = rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumns(
        {"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    # One row per partition of the sort, however many rows the table has: a bound
    # that allows both the single-task sum and the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    number = (F.col("_offset") + F.col("_place") + 1).cast("int").alias(name)
    return placed.join(F.broadcast(offsets), "_part").select(number, *rows.columns)


def date_bounds(staging: DataFrame) -> DataFrame:
    """One row: the earliest and the latest moment in the tickets."""
    created = F.col("created_date")
    closed = F.coalesce(F.col("closed_date"), created)
    return staging.agg(
        F.min(F.least(created, closed)).alias("min_date"),
        F.max(F.greatest(created, closed)).alias("max_date"),
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day, from 30 days before the bounds to 60 days after."""
    first = F.date_sub(F.to_date("min_date"), DAYS_BEFORE)
    last = F.date_add(F.to_date("max_date"), DAYS_AFTER)
    days = bounds.filter(F.col("min_date").isNotNull()).select(
        F.explode(F.sequence(first, last)).alias("full_date")
    )
    day = F.col("full_date")
    year, month, weekday = F.year(day), F.month(day), F.weekday(day)
    # The fiscal year starts in October and is named after that year.
    fiscal_start = F.add_months(day, -9)
    return days.select(
        calendar.date_key(day).alias("date_key"),
        "full_date",
        year.alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        month.alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        (weekday + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 5).alias("is_weekend"),
        F.year(fiscal_start).alias("fiscal_year"),
        F.quarter(fiscal_start).alias("fiscal_quarter"),
    )


def dim_location(staging: DataFrame) -> DataFrame:
    """One row per district and neighborhood, with mean position and lowest zip.

    Zip codes are a key of the pass over staging, which makes it a hash aggregate
    of whole numbers; the lowest text of a group would need its rows sorted.
    """
    positions = [
        column
        for name in ["latitude", "longitude"]
        for column in [*part_sums(name, name, 6), F.count(name).alias(f"n_{name}")]
    ]
    by_zip = staging.groupBy("district_code", "neighborhood", "zip_code").agg(*positions)
    places = by_zip.groupBy("district_code", "neighborhood").agg(
        F.min("zip_code").alias("zip_code"),
        *[
            decimal_ratio(whole_sum(name, 6), F.sum(f"n_{name}"), 6).alias(name)
            for name in ["latitude", "longitude"]
        ],
    )
    zone = F.when(F.col("district_code").isin(NORTH_DISTRICTS), NORTH).otherwise(SOUTH)
    return places.withColumn("region_zone", zone)


def dim_request_type(staging: DataFrame) -> DataFrame:
    """One row per category, type and priority, with the mean target."""
    mean_target = decimal_ratio(exact_sum("target_sla_hours", 2), F.count("target_sla_hours"))
    return (
        staging.withColumnRenamed("request_type", "request_type_name")
        .groupBy("request_category", "request_type_name", "priority_level")
        .agg(mean_target.alias("default_sla_hours"))
    )


def dim_department(staging: DataFrame) -> DataFrame:
    """One row per department and division."""
    return (
        staging.select("department_name", "division_name")
        .distinct()
        .withColumns({"department_head": F.lit(DEPARTMENT_HEAD), "team_capacity": F.lit(TEAM_CAPACITY)})
    )


def dim_status(staging: DataFrame) -> DataFrame:
    """One row per status; a status that starts with `Closed` is closed."""
    closed = F.coalesce(F.col("status_name").startswith(CLOSED_PREFIX), F.lit(False))
    active = F.coalesce(~F.col("status_name").startswith(CLOSED_PREFIX), F.lit(False))
    return (
        staging.select(F.col("status").alias("status_name"))
        .distinct()
        .withColumns({"is_closed": closed, "is_active": active})
    )
