"""The six marts as SQL text, kept with each version of the warehouse.

The text names the version's tables only. It is written when the version is
built, so whoever opens the version reads the marts as they were defined then,
in any session and without this module. `marts.py` has the same marts as
DataFrames, for a star of any rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from casemart.operators.marts import AGE_CLASSES, VIEWS

TODAY = "current_date()"


def _ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """numerator / denominator rounded half away from zero by a whole-number division; NULL over 0."""
    divisor = f"nullif(cast({denominator} as decimal(18,0)), 0)"
    units = f"(abs({numerator}) * cast({2 * 10**digits} as decimal(8,0)) + {divisor}) div ({divisor} * 2)"
    return f"cast(signum({numerator}) as int) * ({units}) / {float(10**digits)}D"


def _share(part: str, whole: str) -> str:
    return _ratio(f"(cast({part} as decimal(18,0)) * 100)", whole)


def _total(value: str) -> str:
    return f"coalesce(sum({value}), 0)"


def _sum_of(name: str) -> str:
    """The decimal sum that the two whole-number sums of a measure stand for."""
    high, low = (f"cast(sum({name}_{half}) as decimal(20,0))" for half in ("high", "low"))
    return f"(({high} * 1048576 + {low}) * 0.01BD)"


def _mean(name: str) -> str:
    return _ratio(_sum_of(name), f"sum(n_{name})")


_CLOSED = "if(is_closed, n, null)"
_OPEN = "if(not is_closed, n, null)"
_KEPT_CLOSED = _share(_total("if(is_closed, n - breaches, null)"), _total(_CLOSED))
_RATING = _ratio("sum(ratings)", "sum(n_ratings)")

_OVERVIEW = f"""
select {_total("n")} as total_requests, {_total(_CLOSED)} as total_closed_requests,
    {_total(_OPEN)} as current_backlog, {_mean("hours")} as avg_resolution_hours,
    {_RATING} as avg_satisfaction_rating, {_total("breaches")} as total_sla_breaches,
    {_KEPT_CLOSED} as sla_compliance_pct, {_total("repeats")} as total_repeat_incidents,
    {_share(_total("repeats"), _total("n"))} as repeat_incident_pct
from mart_sums join dim_status using (status_key) where grain = 'teams'"""

_DEPARTMENTS = f"""
with teams as (
    select department_name, division_name, {_total("n")} as total_tickets, {_total(_CLOSED)} as closed_tickets,
        {_total(_OPEN)} as open_backlog, {_mean("hours")} as avg_resolution_hours,
        {_mean("targets")} as avg_target_sla_hours, {_total("breaches")} as sla_breach_count,
        {_KEPT_CLOSED} as sla_compliance_pct, {_RATING} as avg_satisfaction
    from mart_sums join dim_status using (status_key) join dim_department using (department_key)
    where grain = 'teams' group by department_name, division_name),
ranks as (
    select total_tickets, dense_rank() over (order by total_tickets desc) as workload_rank
    from (select distinct total_tickets from teams))
select teams.*, workload_rank from teams join ranks using (total_tickets)"""

_MONTHS = f"""
with months as (
    select year, month, month_name, {_total("n")} as ticket_volume, {_total("breaches")} as sla_breaches,
        {_mean("hours")} as avg_resolution_hours
    from mart_sums join dim_date on created_date_key = date_key where grain = 'days' group by year, month, month_name),
compared as (select *, lag(ticket_volume) over (order by year, month) as prev_month_volume from months)
select concat_ws('-', year, lpad(cast(month as string), 2, '0')) as year_month, year, month, month_name, ticket_volume,
    prev_month_volume, {_share("(ticket_volume - prev_month_volume)", "prev_month_volume")} as mom_volume_growth_pct,
    avg_resolution_hours, sla_breaches
from compared order by year, month"""


def _weighted(position: str) -> str:
    weight = "cast(n as decimal(18,0))"
    return _ratio(f"sum({position} * {weight})", f"sum(if({position} is not null, {weight}, null))", 6)


_PLACES = f"""
select district_code, neighborhood, region_zone, {_total("n")} as total_requests, {_total("breaches")} as sla_breaches,
    {_mean("hours")} as avg_resolution_hours, {_total("repeats")} as repeat_count,
    {_weighted("latitude")} as district_lat, {_weighted("longitude")} as district_lng
from mart_sums join dim_location using (location_key) where grain = 'places'
group by district_code, neighborhood, region_zone
order by total_requests desc, district_code, neighborhood"""

_KINDS = f"""
select request_category, request_type_name, priority_level, {_total("n")} as request_count,
    {_mean("hours")} as avg_resolution_hours, {_total("breaches")} as sla_breached_count,
    {_share(_total("breaches"), _total("n"))} as breach_rate_pct
from mart_sums join dim_request_type using (request_type_key) where grain = 'kinds'
group by request_category, request_type_name, priority_level
order by request_count desc, request_category, request_type_name, priority_level"""


def _age_class(name: str, low: int | None, high: int | None) -> str:
    limits = [f"age >= {low}"] * (low is not None) + [f"age <= {high}"] * (high is not None)
    return f"{_total(f'if({" and ".join(limits)}, n, null)')} as {name}"


_BACKLOG = f"""
with days as (
    select department_key, request_type_key, created_date_key, count(*) as n
    from fact_service_requests where is_open = 1 group by department_key, request_type_key, created_date_key),
aged as (
    select department_name, request_category, n, datediff({TODAY}, full_date) as age
    from days join dim_department using (department_key) join dim_request_type using (request_type_key)
    join dim_date on created_date_key = date_key)
select department_name, request_category, {_total("n")} as total_backlog_tickets,
    {", ".join(_age_class(*limits) for limits in AGE_CLASSES)}, max(age) as max_open_days
from aged group by department_name, request_category"""

DEFINITIONS = dict(zip(VIEWS, [_OVERVIEW, _DEPARTMENTS, _MONTHS, _PLACES, _KINDS, _BACKLOG], strict=True))


def definitions(spark: SparkSession) -> DataFrame:
    """name and text of the marts, as a version keeps them."""
    return spark.createDataFrame(list(DEFINITIONS.items()), "name STRING, text STRING")


def define(spark: SparkSession, tables: dict[str, DataFrame], texts: dict[str, str], as_of: date | str | None = None) -> None:
    """Make tables, and views defined by texts over them, available to spark.sql by name. Ages are as of today, or as_of."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    day = TODAY if as_of is None else f"date'{date.fromisoformat(str(as_of))}'"
    for name, text in texts.items():
        spark.sql(f"create or replace temporary view {name} as {text.replace(TODAY, day)}")
