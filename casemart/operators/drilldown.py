"""Dashboard filters and the figures that follow from them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.functions.numeric import total
from casemart.functions.text import grouped_digits, place_label
from casemart.operators.marts import AGE_CLASSES
from casemart.operators.star import Star, keep_keys


def _wanted(choices: dict[str, str | None]) -> Column | None:
    """All chosen column values; None means no choice was made."""
    condition = None
    for name, value in choices.items():
        if value is not None:
            test = F.col(name) == value
            condition = test if condition is None else condition & test
    return condition


def _where(frame: DataFrame, **choices: str | None) -> DataFrame:
    condition = _wanted(choices)
    return frame if condition is None else frame.filter(condition)


def filter_star(
    star: Star,
    department: str | None = None,
    category: str | None = None,
    priority: str | None = None,
    district: str | None = None,
) -> Star:
    """The star restricted to the chosen values, so that all marts agree.

    The choices filter the dimensions, and the fact keeps the rows whose keys
    survive.
    """
    fact = star.fact
    for dimension, key, choices in [
        (star.departments, "department_key", {"department_name": department}),
        (
            star.request_types,
            "request_type_key",
            {"request_category": category, "priority_level": priority},
        ),
        (star.locations, "location_key", {"district_code": district}),
    ]:
        condition = _wanted(choices)
        if condition is not None:
            fact = keep_keys(fact, dimension.filter(condition).select(key), key)
    return replace(star, fact=fact, sums=star.sums if fact is star.fact else None)


def filter_departments(departments: DataFrame, department: str | None = None) -> DataFrame:
    """The rows of the department mart that the dashboard shows."""
    return _where(departments, department_name=department)


def filter_categories(
    categories: DataFrame, category: str | None = None, priority: str | None = None
) -> DataFrame:
    """The rows of the category mart that the dashboard shows."""
    return _where(categories, request_category=category, priority_level=priority)


def filter_caption(departments: DataFrame) -> DataFrame:
    """One row: the tickets shown, and the caption that says so."""
    shown = departments.agg(total(F.col("total_tickets")).alias("shown_tickets"))
    # Fixed value: the caption's wording.
    caption = F.concat(
        F.lit("Showing "), grouped_digits(F.col("shown_tickets")), F.lit(" Filtered Incidents")
    )
    return shown.withColumn("caption", caption)


def category_share(categories: DataFrame) -> DataFrame:
    """Tickets per category, over all types and priorities."""
    return categories.groupBy("request_category").agg(
        total(F.col("request_count")).alias("request_count")
    )


def filter_options(departments: DataFrame, categories: DataFrame, geography: DataFrame) -> DataFrame:
    """The values of each filter list in the order in which its mart shows them.

    A value first appears at its busiest row, so the order is by the largest
    count, then by name. A district is labelled with the neighborhood of that row.
    The marts may come in any order; the one task of a list sees a row per value.
    """
    in_district = Window.partitionBy("district_code").orderBy(F.desc("total_requests"), "neighborhood")
    busiest = geography.withColumn("_place", F.row_number().over(in_district)).filter("_place = 1")
    lists = [
        departments.select(
            F.lit("department").alias("filter_name"),
            F.lit(0).cast("bigint").alias("_busiest"),
            F.col("department_name").alias("value"),
            F.col("department_name").alias("label"),
        ).distinct(),
        categories.groupBy(F.col("request_category").alias("value"))
        .agg(F.max("request_count").alias("_busiest"))
        .select(F.lit("category").alias("filter_name"), "_busiest", "value", F.col("value").alias("label")),
        busiest.select(
            F.lit("district").alias("filter_name"),
            F.col("total_requests").alias("_busiest"),
            F.col("district_code").alias("value"),
            place_label(F.col("district_code"), F.col("neighborhood")).alias("label"),
        ),
    ]
    options = lists[0].unionByName(lists[1]).unionByName(lists[2])
    in_list = Window.partitionBy("filter_name").orderBy(F.desc("_busiest"), "value")
    return options.select(
        "filter_name", F.row_number().over(in_list).alias("position"), "value", "label"
    )


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def trend_series(trends: DataFrame) -> DataFrame:
    """Label, volume and breaches per month, as charted."""
    label = F.coalesce("year_month", "month_name").alias("label")
    return trends.select(label, _or_zero("ticket_volume"), _or_zero("sla_breaches"))


def workload_series(departments: DataFrame) -> DataFrame:
    """Label, tickets and mean hours per division, as charted."""
    label = F.coalesce("division_name", "department_name").alias("label")
    hours = F.coalesce(F.col("avg_resolution_hours"), F.lit(0.0)).alias("avg_resolution_hours")
    return departments.select(label, _or_zero("total_tickets"), hours)


def place_series(geography: DataFrame) -> DataFrame:
    """Label and tickets per neighborhood, as charted."""
    label = place_label(F.col("district_code"), F.col("neighborhood")).alias("label")
    return geography.select(label, _or_zero("total_requests"))


def backlog_series(backlog: DataFrame) -> DataFrame:
    """Label and tickets per age class, as charted."""
    classes = [_or_zero(name) for name, _, _ in AGE_CLASSES]
    return backlog.select(F.col("department_name").alias("label"), *classes)


def headlines(overview: DataFrame) -> DataFrame:
    """The printed summary: one labelled text per figure of the overview."""
    # The labels and units of the summary.
    lines = [
        ("Total Requests Processed", grouped_digits(F.col("total_requests"))),
        ("Total Resolved Tickets", grouped_digits(F.col("total_closed_requests"))),
        ("Current Open Backlog", grouped_digits(F.col("current_backlog"))),
        ("Avg Resolution Time", _with_unit("avg_resolution_hours", " hours")),
        ("SLA Compliance Rate", _with_unit("sla_compliance_pct", "%")),
        ("Total SLA Breaches", grouped_digits(F.col("total_sla_breaches"))),
        ("Repeat Incident Rate", _with_unit("repeat_incident_pct", "%")),
        ("Avg Satisfaction Score", _with_unit("avg_satisfaction_rating", " / 5.0")),
    ]
    rows = [
        F.struct(F.lit(place).alias("position"), F.lit(label).alias("label"), text.alias("figure"))
        for place, (label, text) in enumerate(lines, 1)
    ]
    return overview.select(F.inline(F.array(*rows)))


def _with_unit(column: str, unit: str) -> Column:
    return F.concat(F.col(column).cast("string"), F.lit(unit))
