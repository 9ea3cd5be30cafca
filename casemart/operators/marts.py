"""The six KPI marts.

Every mart first adds the fact up by integer dimension keys and only then joins
the dimensions. The pass over the fact is a narrow column scan and a partial
hash aggregate with no join in it; what is shuffled and joined is one row per
key combination, and a key that holds a third of the fact arrives as one row per
map task. The measures are sums and counts, so they can be added up again by
name after the join. A star whose sums are stored is not scanned at all: the
marts read the rows of their grain, which one scan wrote for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.functions.calendar import as_date
from casemart.functions.numeric import percentage, ratio, total, whole_sum
from casemart.operators.rollup import GRAIN_KEYS, GRAINS, tally
from casemart.operators.star import Star, keep_keys

# The view names and the age classes of the backlog, in days.
VIEWS = [
    "vw_kpi_operational_overview",
    "vw_kpi_department_performance",
    "vw_kpi_monthly_trends",
    "vw_kpi_geographic_distribution",
    "vw_kpi_category_breakdown",
    "vw_kpi_backlog_aging",
]
AGE_CLASSES = [
    ("aging_0_to_3_days", None, 3),
    ("aging_4_to_7_days", 4, 7),
    ("aging_8_to_14_days", 8, 14),
    ("aging_over_14_days", 15, None),
]
TRENDS_SHOWN = 12


def _tally(star: Star, grain: str) -> DataFrame:
    """The measures per key of a grain: as stored, or else from the fact."""
    keys = GRAINS[grain]
    if star.sums is None:
        return tally(star.fact, *keys)
    return star.sums.filter(F.col("grain") == grain).drop("grain", *[key for key in GRAIN_KEYS if key not in keys])


def _sum_where(condition: Column, column: Column) -> Column:
    return total(F.when(condition, column))


def _mean_hours(measure: str) -> Column:
    return ratio(whole_sum(measure), F.sum(f"n_{measure}"))


def _mean_rating() -> Column:
    return ratio(F.sum("ratings"), F.sum("n_ratings"))


_CLOSED = "is_closed"


def _closed() -> Column:
    return _sum_where(F.col(_CLOSED), F.col("n"))


def _compliance(base: str) -> Column:
    """Share of tickets without a breach: of the closed ones, or of all."""
    met = F.col("n") - F.col("breaches")
    if base == "closed":
        return percentage(_sum_where(F.col(_CLOSED), met), _closed())
    if base == "all":
        return percentage(total(met), total(F.col("n")))
    raise ValueError(f"compliance base must be 'closed' or 'all', not {base!r}")


def operational_overview(star: Star) -> DataFrame:
    """One row of totals, also when there are no tickets."""
    by_status = _tally(star, "teams").join(
        star.statuses.select("status_key", _CLOSED), "status_key"
    )
    return by_status.agg(
        total(F.col("n")).alias("total_requests"),
        _closed().alias("total_closed_requests"),
        _sum_where(~F.col(_CLOSED), F.col("n")).alias("current_backlog"),
        _mean_hours("hours").alias("avg_resolution_hours"),
        _mean_rating().alias("avg_satisfaction_rating"),
        total(F.col("breaches")).alias("total_sla_breaches"),
        _compliance("closed").alias("sla_compliance_pct"),
        total(F.col("repeats")).alias("total_repeat_incidents"),
        percentage(total(F.col("repeats")), total(F.col("n"))).alias("repeat_incident_pct"),
    )


def department_performance(star: Star, compliance_base: str = "closed") -> DataFrame:
    """Workload and resolution per department and division, ranked by volume."""
    by_team = (
        _tally(star, "teams")
        .join(star.statuses.select("status_key", _CLOSED), "status_key")
        .join(
            star.departments.select("department_key", "department_name", "division_name"),
            "department_key",
        )
    )
    teams = (
        by_team.groupBy("department_name", "division_name")
        .agg(
            total(F.col("n")).alias("total_tickets"),
            _closed().alias("closed_tickets"),
            _sum_where(~F.col(_CLOSED), F.col("n")).alias("open_backlog"),
            _mean_hours("hours").alias("avg_resolution_hours"),
            _mean_hours("targets").alias("avg_target_sla_hours"),
            total(F.col("breaches")).alias("sla_breach_count"),
            _compliance(compliance_base).alias("sla_compliance_pct"),
            _mean_rating().alias("avg_satisfaction"),
        )
    )
    # Only distinct volumes meet in one task: n of them need n(n+1)/2 tickets, so
    # 10^12 tickets have 1.4 million at most, whatever the number of divisions.
    volumes = by_team.groupBy("department_name", "division_name").agg(total(F.col("n")).alias("_volume"))
    by_volume = Window.orderBy(F.desc("_volume"))
    ranks = volumes.select("_volume").distinct().select(
        "_volume", F.dense_rank().over(by_volume).alias("workload_rank")
    )
    return teams.join(ranks, F.col("total_tickets") == F.col("_volume")).drop("_volume")


def monthly_trends(star: Star, first: int | None = None) -> DataFrame:
    """Volume per month of creation, and growth over the month before it.

    The month before is the previous month that has tickets. `first` keeps only
    that many of the earliest months.
    """
    created = F.col("date_key").alias("created_date_key")
    by_month = (
        _tally(star, "days")
        .join(star.dates.select(created, "year", "month", "month_name"), "created_date_key")
        .groupBy("year", "month", "month_name")
        .agg(
            total(F.col("n")).alias("ticket_volume"),
            total(F.col("breaches")).alias("sla_breaches"),
            _mean_hours("hours").alias("avg_resolution_hours"),
        )
    )
    # Twelve rows a year, so one task is enough.
    in_time = Window.orderBy("year", "month")
    previous = F.col("prev_month_volume")
    trends = (
        by_month.withColumn("prev_month_volume", F.lag("ticket_volume", 1).over(in_time))
        .select(
            F.concat_ws("-", "year", F.lpad(F.col("month").cast("string"), 2, "0")).alias("year_month"),
            "year",
            "month",
            "month_name",
            "ticket_volume",
            "prev_month_volume",
            percentage(F.col("ticket_volume") - previous, previous).alias("mom_volume_growth_pct"),
            "avg_resolution_hours",
            "sla_breaches",
        )
        .orderBy("year", "month")
    )
    return trends if first is None else trends.limit(first)


def geographic_distribution(star: Star) -> DataFrame:
    """Volume per district and neighborhood, busiest first."""
    return places(star).orderBy(F.desc("total_requests"), "district_code", "neighborhood")


def places(star: Star) -> DataFrame:
    """The rows of the geographic mart in no order."""
    weight = F.col("n").cast("decimal(18,0)")
    return (
        _tally(star, "places")
        .join(star.locations, "location_key")
        .groupBy("district_code", "neighborhood", "region_zone")
        .agg(
            total(F.col("n")).alias("total_requests"),
            total(F.col("breaches")).alias("sla_breaches"),
            _mean_hours("hours").alias("avg_resolution_hours"),
            total(F.col("repeats")).alias("repeat_count"),
            _weighted("latitude", weight).alias("district_lat"),
            _weighted("longitude", weight).alias("district_lng"),
        )
    )


def _weighted(position: str, weight: Column) -> Column:
    """The mean of a dimension column over the tickets that refer to it."""
    known = F.when(F.col(position).isNotNull(), weight)
    return ratio(F.sum(F.col(position) * weight), F.sum(known), 6)


def category_breakdown(star: Star) -> DataFrame:
    """Volume and breach rate per category, type and priority, busiest first."""
    return kinds(star).orderBy(
        F.desc("request_count"), "request_category", "request_type_name", "priority_level"
    )


def kinds(star: Star) -> DataFrame:
    """The rows of the category mart in no order."""
    return (
        _tally(star, "kinds")
        .join(star.request_types, "request_type_key")
        .groupBy("request_category", "request_type_name", "priority_level")
        .agg(
            total(F.col("n")).alias("request_count"),
            _mean_hours("hours").alias("avg_resolution_hours"),
            total(F.col("breaches")).alias("sla_breached_count"),
            percentage(total(F.col("breaches")), total(F.col("n"))).alias("breach_rate_pct"),
        )
    )


def backlog_aging(
    star: Star,
    as_of: date | str | Column | None = None,
    by: Sequence[str] = ("department_name", "request_category"),
) -> DataFrame:
    """Open tickets by age class on `as_of`; the first class takes future dates."""
    per_day = _open_days(star)
    teams = star.departments.select("department_key", "department_name", "division_name")
    aged = (
        per_day.join(teams, "department_key")
        .join(star.request_types.drop("default_sla_hours"), "request_type_key")
        .join(
            star.dates.select(F.col("date_key").alias("created_date_key"), "full_date"),
            "created_date_key",
        )
        .withColumn("age", F.datediff(as_date(as_of), F.col("full_date")))
    )
    return aged.groupBy(*by).agg(
        total(F.col("n")).alias("total_backlog_tickets"),
        *[_sum_where(_between(low, high), F.col("n")).alias(name) for name, low, high in AGE_CLASSES],
        F.max("age").alias("max_open_days"),
    )


def _open_days(star: Star) -> DataFrame:
    """Open tickets per department, request type and day of creation."""
    keys = ["department_key", "request_type_key", "created_date_key"]
    if "is_open" in star.fact.columns:
        # A folder of its own: closed tickets are not read.
        opened = star.fact.filter("is_open = 1")
    else:
        opened = keep_keys(star.fact, star.statuses.filter(~F.col(_CLOSED)).select("status_key"), "status_key")
    return opened.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _between(low: int | None, high: int | None) -> Column:
    age = F.col("age")
    if low is None:
        return age <= high
    if high is None:
        return age >= low
    return age.between(low, high)


def all_marts(
    star: Star, as_of: date | str | Column | None = None, months: int | None = None
) -> dict[str, DataFrame]:
    """The six marts by view name."""
    frames = [
        operational_overview(star),
        department_performance(star),
        monthly_trends(star, months),
        geographic_distribution(star),
        category_breakdown(star),
        backlog_aging(star, as_of),
    ]
    return dict(zip(VIEWS, frames, strict=True))


def register_views(star: Star, as_of: date | str | Column | None = None) -> None:
    """Make the star's tables and the marts available to spark.sql by name."""
    for name, frame in {**star.tables(), **all_marts(star, as_of)}.items():
        frame.createOrReplaceTempView(name)
