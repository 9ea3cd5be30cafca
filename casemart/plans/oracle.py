"""Reference answers: each query of the catalogue as SQL over the same tables.

The SQL is written on its own terms (row numbers, joins of the whole fact, one
grouping per mart) and shares nothing with the Spark plans but the definitions.
"""

from __future__ import annotations

from casemart.plans.choices import AS_OF, CATEGORY, DEPARTMENT, DISTRICT, PRIORITY

# The characters that stripping removes, as SQL.
_WHITESPACE = " || ".join(
    f"chr({code})"
    for code in [
        *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
        8232, 8233, 8239, 8287, 12288,
    ]
)
_STRIPPED = [
    "department_name", "division_name", "request_category",
    "request_type", "status", "priority_level",
]
_RAW = [
    "ticket_number", "created_date", "closed_date", "target_sla_hours",
    "department_name", "division_name", "request_category", "request_type",
    "priority_level", "status", "district_code", "neighborhood", "zip_code",
    "latitude", "longitude", "satisfaction_rating", "is_repeat", "channel",
]
# Types that every client library hands over alike.
_CASTS = {
    "target_sla_hours": "double",
    "latitude": "double",
    "longitude": "double",
    "satisfaction_rating": "double",
    "is_repeat": "varchar",
}


def mean(measure: str, digits: int = 2) -> str:
    return (
        f"cast(round(cast(cast(sum({measure}) as double) / nullif(count({measure}), 0) "
        f"as decimal(28,10)), {digits}) as double)"
    )


def share(part: str, whole: str) -> str:
    return f"cast(round(cast(100.0 * ({part}) / nullif({whole}, 0) as decimal(28,10)), 2) as double)"


def _strip(column: str) -> str:
    return f"trim({column}, {_WHITESPACE})"


def _columns() -> str:
    """The raw columns in comparable types."""
    return ", ".join(
        f"cast({name} as {_CASTS[name]}) as {name}" if name in _CASTS else name for name in _RAW
    )


_TABLES = {
    "raw": """
        select 'SR-' || l_orderkey || '-' || l_linenumber as ticket_number,
            o_orderdate + to_hours(3 * l_linenumber) as created_date,
            case when o_orderstatus = 'F' then
                o_orderdate + to_hours(3 * l_linenumber) + to_microseconds(
                    cast(3 * floor(l_extendedprice) as bigint) * 1000000
                    * case when l_linenumber = 7 and l_returnflag = 'R' then -1 else 1 end)
            end as closed_date,
            cast(case o_orderpriority when '1-URGENT' then 12 when '2-HIGH' then 24
                when '3-MEDIUM' then 48 when '4-NOT SPECIFIED' then 72 when '5-LOW' then 168
                end as decimal(10,2)) as target_sla_hours,
            case when l_linenumber = 3 then '  ' || r_name || ' ' else r_name end
                as department_name,
            c_mktsegment as division_name,
            p_type as request_category,
            p_brand as request_type,
            o_orderpriority as priority_level,
            case when o_orderstatus = 'F' and l_returnflag = 'A' then 'Closed - Duplicate'
                when o_orderstatus = 'F' then 'Closed - Resolved'
                when o_orderstatus = 'P' then 'In Progress'
                when o_orderstatus = 'O' then 'Assigned' end as status,
            case when n_nationkey <> 7 then 'DIST-' || lpad(cast(n_nationkey as varchar), 2, '0')
                end as district_code,
            case when n_nationkey <> 7 then n_name end as neighborhood,
            case when n_nationkey not in (7, 9)
                then '368' || lpad(cast(n_nationkey as varchar), 2, '0') end as zip_code,
            cast(32.6 + (l_partkey % 200 - 100) * 0.0001 as decimal(10,6)) as latitude,
            cast(-85.48 + (l_suppkey % 10 - 5) * 0.001 as decimal(10,6)) as longitude,
            case when o_orderstatus = 'F' then 1 + cast(l_quantity as int) % 5 end
                as satisfaction_rating,
            case when l_linenumber <> 5 then l_tax >= 0.07 end as is_repeat,
            case when l_linenumber % 2 = 1 then 'Web' else 'Phone' end as channel,
            l_shipdate as arrival_date, l_partkey as arrival_part, l_suppkey as arrival_supplier
        from lineitem
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        join part on l_partkey = p_partkey""",
    "ranked": """
        select *, row_number() over (partition by ticket_number
            order by arrival_date, arrival_part, arrival_supplier) as place
        from raw""",
    "staged": f"""
        select ticket_number, created_date, closed_date, target_sla_hours,
            {", ".join(f"{_strip(name)} as {name}" for name in _STRIPPED)},
            coalesce(district_code, 'DIST-UNKNOWN') as district_code,
            coalesce(neighborhood, 'Unknown Neighborhood') as neighborhood,
            coalesce(zip_code, '00000') as zip_code,
            latitude, longitude, satisfaction_rating, is_repeat, channel
        from ranked where place = 1""",
    "bounds": """
        select min(least(created_date, coalesce(closed_date, created_date))) as min_date,
            max(greatest(created_date, coalesce(closed_date, created_date))) as max_date
        from staged""",
    "dates": """
        select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as full_date,
            cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
            'Q' || quarter(d) as quarter_name, cast(month(d) as int) as month,
            monthname(d) as month_name, cast(day(d) as int) as day_of_month,
            cast(isodow(d) as int) as day_of_week, dayname(d) as day_name,
            isodow(d) in (6, 7) as is_weekend,
            cast(case when month(d) >= 10 then year(d) else year(d) - 1 end as int) as fiscal_year,
            cast(case when month(d) >= 10 then 1 when month(d) <= 3 then 2
                when month(d) <= 6 then 3 else 4 end as int) as fiscal_quarter
        from (select unnest(generate_series(date_trunc('day', min_date) - interval 30 day,
            date_trunc('day', max_date) + interval 60 day, interval 1 day)) as d from bounds)""",
    "locations": """
        select cast(row_number() over (order by district_code, neighborhood) as int)
                as location_key,
            district_code, neighborhood, min(zip_code) as zip_code,
            cast(round(cast(cast(sum(latitude) as double) / count(latitude)
                as decimal(28,10)), 6) as decimal(10,6)) as latitude,
            cast(round(cast(cast(sum(longitude) as double) / count(longitude)
                as decimal(28,10)), 6) as decimal(10,6)) as longitude,
            case when district_code in ('DIST-01', 'DIST-02') then 'North Region'
                else 'South Region' end as region_zone
        from staged group by district_code, neighborhood""",
    "kinds": """
        select cast(row_number() over (order by request_category, request_type, priority_level)
                as int) as request_type_key,
            request_category, request_type as request_type_name, priority_level,
            cast(round(cast(cast(sum(target_sla_hours) as double) / count(target_sla_hours)
                as decimal(28,10)), 2) as decimal(10,2)) as default_sla_hours
        from staged group by request_category, request_type, priority_level""",
    "teams": """
        select cast(row_number() over (order by department_name, division_name) as int)
                as department_key,
            department_name, division_name, 'Dept Director' as department_head,
            30 as team_capacity
        from (select distinct department_name, division_name from staged)""",
    "statuses": """
        select cast(row_number() over (order by status) as int) as status_key,
            status as status_name, starts_with(status, 'Closed') as is_closed,
            not starts_with(status, 'Closed') as is_active
        from (select distinct status from staged)""",
    "timed": """
        select *, cast(date_diff('microsecond', created_date, closed_date) / 3600000000.0
            as decimal(28,10)) as spent
        from staged""",
    "fact": """
        select ticket_number, cast(strftime(created_date, '%Y%m%d') as int) as created_date_key,
            cast(strftime(closed_date, '%Y%m%d') as int) as closed_date_key,
            location_key, request_type_key, department_key, status_key,
            created_date as created_timestamp, closed_date as closed_timestamp,
            cast(round(spent, 2) as decimal(10,2)) as resolution_time_hours, target_sla_hours,
            cast(round(spent - target_sla_hours, 2) as decimal(10,2)) as sla_variance_hours,
            coalesce(spent > target_sla_hours, false) as is_sla_breached,
            coalesce(is_repeat, false) as is_repeat_incident, satisfaction_rating
        from timed
        join locations using (district_code, neighborhood)
        join kinds on timed.request_category = kinds.request_category
            and request_type = request_type_name
            and timed.priority_level = kinds.priority_level
        join teams using (department_name, division_name)
        join statuses on status = status_name""",
    "overview": f"""
        select count(*) as total_requests, count(*) filter (is_closed) as total_closed_requests,
            count(*) filter (not is_closed) as current_backlog,
            {mean("resolution_time_hours")} as avg_resolution_hours,
            {mean("satisfaction_rating")} as avg_satisfaction_rating,
            count(*) filter (is_sla_breached) as total_sla_breaches,
            {share("count(*) filter (is_closed and not is_sla_breached)",
                   "count(*) filter (is_closed)")} as sla_compliance_pct,
            count(*) filter (is_repeat_incident) as total_repeat_incidents,
            {share("count(*) filter (is_repeat_incident)", "count(*)")} as repeat_incident_pct
        from fact join statuses using (status_key)""",
    "performance": f"""
        select department_name, division_name, count(*) as total_tickets,
            count(*) filter (is_closed) as closed_tickets,
            count(*) filter (not is_closed) as open_backlog,
            {mean("resolution_time_hours")} as avg_resolution_hours,
            {mean("target_sla_hours")} as avg_target_sla_hours,
            count(*) filter (is_sla_breached) as sla_breach_count,
            {share("count(*) filter (is_closed and not is_sla_breached)",
                   "count(*) filter (is_closed)")} as sla_compliance_pct,
            {mean("satisfaction_rating")} as avg_satisfaction,
            cast(dense_rank() over (order by count(*) desc) as int) as workload_rank
        from fact join teams using (department_key) join statuses using (status_key)
        group by department_name, division_name""",
    "months": f"""
        select year, month, month_name, count(*) as ticket_volume,
            count(*) filter (is_sla_breached) as sla_breaches,
            {mean("resolution_time_hours")} as avg_resolution_hours
        from fact join dates on created_date_key = date_key
        group by year, month, month_name""",
    "trends": f"""
        select year || '-' || lpad(cast(month as varchar), 2, '0') as year_month, year, month,
            month_name, ticket_volume,
            lag(ticket_volume) over (order by year, month) as prev_month_volume,
            {share("ticket_volume - lag(ticket_volume) over (order by year, month)",
                   "lag(ticket_volume) over (order by year, month)")} as mom_volume_growth_pct,
            avg_resolution_hours, sla_breaches
        from months""",
    "geography": f"""
        select district_code, neighborhood, region_zone, count(*) as total_requests,
            count(*) filter (is_sla_breached) as sla_breaches,
            {mean("resolution_time_hours")} as avg_resolution_hours,
            count(*) filter (is_repeat_incident) as repeat_count,
            {mean("latitude", 6)} as district_lat, {mean("longitude", 6)} as district_lng
        from fact join locations using (location_key)
        group by district_code, neighborhood, region_zone""",
    "categories": f"""
        select request_category, request_type_name, priority_level, count(*) as request_count,
            {mean("resolution_time_hours")} as avg_resolution_hours,
            count(*) filter (is_sla_breached) as sla_breached_count,
            {share("count(*) filter (is_sla_breached)", "count(*)")} as breach_rate_pct
        from fact join kinds using (request_type_key)
        group by request_category, request_type_name, priority_level""",
    "open_tickets": f"""
        select department_name, request_category,
            cast(date_diff('day', full_date, date '{AS_OF}') as int) as age
        from fact join statuses using (status_key) join teams using (department_key)
        join kinds using (request_type_key) join dates on created_date_key = date_key
        where not is_closed""",
}

# Which tables each table is built from; WITH clauses name only what they need.
_NEEDS = {
    "raw": [],
    "ranked": ["raw"],
    "staged": ["ranked"],
    "bounds": ["staged"],
    "dates": ["bounds"],
    "locations": ["staged"],
    "kinds": ["staged"],
    "teams": ["staged"],
    "statuses": ["staged"],
    "timed": ["staged"],
    "fact": ["timed", "locations", "kinds", "teams", "statuses"],
    "overview": ["fact"],
    "performance": ["fact"],
    "months": ["fact", "dates"],
    "trends": ["months"],
    "geography": ["fact"],
    "categories": ["fact"],
    "open_tickets": ["fact", "dates"],
}


def _closure(names: list[str]) -> list[str]:
    needed: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += _NEEDS[name]
    return [name for name in _TABLES if name in needed]


def with_tables(names: str, select: str) -> str:
    tables = ",\n".join(f"{name} as ({_TABLES[name]})" for name in _closure(names.split()))
    return f"with {tables}\n{select}"


_AGES = (
    "count(*) as total_backlog_tickets, count(*) filter (age <= 3) as aging_0_to_3_days, "
    "count(*) filter (age between 4 and 7) as aging_4_to_7_days, "
    "count(*) filter (age between 8 and 14) as aging_8_to_14_days, "
    "count(*) filter (age > 14) as aging_over_14_days, max(age) as max_open_days"
)


def _null_check(table: str) -> str:
    return " union all ".join(
        f"select 'Null Check: {name}' as check_name, "
        f"case when count(*) filter ({name} is null) = 0 then 'PASSED' else 'FAILED' end as status, "
        f"'Found ' || count(*) filter ({name} is null) || ' nulls out of ' || count(*) || ' rows' "
        f"as details from {table}"
        for name in ["ticket_number", "created_date", "department_name", "request_category"]
    )


def _time_check(table: str) -> str:
    early = "count(*) filter (closed_date < created_date)"
    return (
        "select 'Timestamp Logic Check (closed >= created)' as check_name, "
        f"case when {early} = 0 then 'PASSED' else 'FAILED' end as status, "
        f"'Found ' || {early} || ' tickets with closed_date before created_date' as details "
        f"from {table}"
    )


def _unique_check(table: str) -> str:
    return (
        "select 'Uniqueness Check (ticket_number)' as check_name, "
        "case when n = 0 then 'PASSED' else 'FAILED' end as status, "
        "'Found ' || n || ' duplicate ticket numbers' as details from (select count(*) as n from "
        f"(select row_number() over (partition by ticket_number) as place from {table}) "
        "where place > 1)"
    )


def _full_audit(table: str) -> str:
    return " union all ".join([_null_check(table), _time_check(table), _unique_check(table)])


_FACT_SELECT = (
    "ticket_number, created_date_key, cast(closed_date_key as double) as closed_date_key, "
    "location_key, request_type_key, department_key, status_key, created_timestamp, closed_timestamp, "
    "cast(resolution_time_hours as double) as resolution_time_hours, "
    "cast(target_sla_hours as double) as target_sla_hours, "
    "cast(sla_variance_hours as double) as sla_variance_hours, "
    "is_sla_breached, is_repeat_incident, "
    "cast(satisfaction_rating as double) as satisfaction_rating"
)

# Tables of the star by stored name, with their keys and mandatory columns.
_STORED = {
    "dim_date": "dates",
    "dim_location": "locations",
    "dim_request_type": "kinds",
    "dim_department": "teams",
    "dim_status": "statuses",
    "fact_service_requests": "fact",
}
_KEYS = [
    ("dim_date", "date_key"),
    ("dim_date", "full_date"),
    ("dim_location", "location_key"),
    ("dim_location", "district_code, neighborhood"),
    ("dim_request_type", "request_type_key"),
    ("dim_request_type", "request_category, request_type_name, priority_level"),
    ("dim_department", "department_key"),
    ("dim_department", "department_name, division_name"),
    ("dim_status", "status_key"),
    ("dim_status", "status_name"),
    ("fact_service_requests", "ticket_number"),
]
_MANDATORY = {
    "dim_date": "date_key full_date year quarter quarter_name month month_name day_of_month "
    "day_of_week day_name is_weekend fiscal_year fiscal_quarter",
    "dim_location": "location_key district_code neighborhood region_zone",
    "dim_request_type": "request_type_key request_category request_type_name priority_level "
    "default_sla_hours",
    "dim_department": "department_key department_name division_name",
    "dim_status": "status_key status_name is_closed is_active",
    "fact_service_requests": "ticket_number created_date_key location_key request_type_key "
    "department_key status_key created_timestamp target_sla_hours is_sla_breached "
    "is_repeat_incident",
}
_LENGTHS = {
    "ticket_number": 50, "department_name": 100, "division_name": 100, "request_category": 100,
    "request_type": 150, "priority_level": 20, "status": 50, "district_code": 20,
    "neighborhood": 100, "zip_code": 20, "channel": 50,
}
_REFERENCES = [
    ("created_date_key", "dim_date", "date_key"),
    ("closed_date_key", "dim_date", "date_key"),
    ("location_key", "dim_location", "location_key"),
    ("request_type_key", "dim_request_type", "request_type_key"),
    ("department_key", "dim_department", "department_key"),
    ("status_key", "dim_status", "status_key"),
]
_ALL = "fact dates locations kinds teams statuses"


def _unpivoted(counts: list[tuple[str, str]], source: str) -> str:
    return " union all ".join(
        f"select '{rule}' as rule, count(*) filter ({broken}) as violations from {source}"
        for rule, broken in counts
    )


def _unique_rules() -> str:
    return " union all ".join(
        f"select '{table}({keys})' as rule, count(*) filter (place > 1) as violations from "
        f"(select row_number() over (partition by {keys}) as place from {_STORED[table]})"
        for table, keys in _KEYS
    )


def _not_null_rules() -> str:
    return " union all ".join(
        _unpivoted([(f"{table}.{name}", f"{name} is null") for name in names.split()], _STORED[table])
        for table, names in _MANDATORY.items()
    )


def _reference_rules() -> str:
    return " union all ".join(
        f"select '{column} -> {dimension}' as rule, count(*) as violations from fact "
        f"where {column} is not null and {column} not in (select {key} from {_STORED[dimension]})"
        for column, dimension, key in _REFERENCES
    )


_LOST = """
    select ticket_number, location_key, request_type_key, department_key, status_key
    from staged
    left join locations using (district_code, neighborhood)
    left join kinds on staged.request_category = kinds.request_category
        and request_type = request_type_name and staged.priority_level = kinds.priority_level
    left join teams using (department_name, division_name)
    left join statuses on status = status_name"""


def _lost_rules() -> str:
    keys = ["location_key", "request_type_key", "department_key", "status_key"]
    rows = _unpivoted([(f"no {key}", f"{key} is null") for key in keys], f"({_LOST})")
    return (
        f"{rows} union all select 'lost tickets' as rule, count(*) as violations from staged "
        "where not exists (select 1 from fact where fact.ticket_number = staged.ticket_number)"
    )


_OPTIONS = """
    select filter_name, cast(row_number() over (partition by filter_name
        order by busiest desc, value) as int) as position, value, label
    from (
        select distinct 'department' as filter_name, 0 as busiest, department_name as value,
            department_name as label from performance
        union all
        select 'category', max(request_count), request_category, request_category
            from categories group by request_category
        union all
        select 'district', total_requests, district_code,
            district_code || ' (' || neighborhood || ')'
            from (select *, row_number() over (partition by district_code
                order by total_requests desc, neighborhood) as place from geography)
            where place = 1)"""

_HEADLINES = """
    select * from (
        select cast(1 as int) as position, 'Total Requests Processed' as label,
            format('{:,}', total_requests) as figure from overview
        union all select 2, 'Total Resolved Tickets', format('{:,}', total_closed_requests)
            from overview
        union all select 3, 'Current Open Backlog', format('{:,}', current_backlog) from overview
        union all select 4, 'Avg Resolution Time', avg_resolution_hours || ' hours' from overview
        union all select 5, 'SLA Compliance Rate', sla_compliance_pct || '%' from overview
        union all select 6, 'Total SLA Breaches', format('{:,}', total_sla_breaches) from overview
        union all select 7, 'Repeat Incident Rate', repeat_incident_pct || '%' from overview
        union all select 8, 'Avg Satisfaction Score', avg_satisfaction_rating || ' / 5.0'
            from overview)"""

_TRENDS = (
    "select * replace (cast(prev_month_volume as double) as prev_month_volume) from trends"
)

_TOTALS = """
    select 'overview' as section, count(*) as records, cast(sum(total_requests) as bigint)
        as tickets, cast(sum(total_sla_breaches) as double) as breaches from overview
    union all select 'departments', count(*), cast(sum(total_tickets) as bigint),
        cast(sum(sla_breach_count) as double) from performance
    union all select 'monthly_trends', count(*), cast(sum(ticket_volume) as bigint),
        cast(sum(sla_breaches) as double) from {trends}
    union all select 'geo_distribution', count(*), cast(sum(total_requests) as bigint),
        cast(sum(sla_breaches) as double) from geography
    union all select 'categories', count(*), cast(sum(request_count) as bigint),
        cast(sum(sla_breached_count) as double) from categories
    union all select 'backlog_aging', count(*), cast(sum(n) as bigint), cast(null as double)
        from (select count(*) as n from open_tickets group by department_name, request_category)"""
_MARTS = "overview performance trends geography categories open_tickets"

_CHOSEN = f"""
    fact semi join (select department_key from teams where department_name = '{DEPARTMENT}')
        using (department_key)
    semi join (select request_type_key from kinds where priority_level = '{PRIORITY}')
        using (request_type_key)"""
_PLACED = f"""
    fact semi join (select location_key from locations where district_code = '{DISTRICT}')
        using (location_key)
    semi join (select request_type_key from kinds where request_category = '{CATEGORY}')
        using (request_type_key)"""


def _on(source: str, table: str) -> str:
    """A mart of the table set, over some of the fact's rows."""
    return _TABLES[table].replace("from fact", f"from (select * from {source}) as fact")


# The columns of the marts by payload section; text columns are named first.
_SECTIONS = {
    "overview": ("", "total_requests total_closed_requests current_backlog avg_resolution_hours "
        "avg_satisfaction_rating total_sla_breaches sla_compliance_pct total_repeat_incidents "
        "repeat_incident_pct", "from overview", "1"),
    "departments": ("department_name division_name", "total_tickets closed_tickets open_backlog "
        "avg_resolution_hours avg_target_sla_hours sla_breach_count sla_compliance_pct "
        "avg_satisfaction workload_rank", "from performance", "department_name, division_name"),
    "monthly_trends": ("year_month month_name", "year month ticket_volume prev_month_volume "
        "mom_volume_growth_pct avg_resolution_hours sla_breaches", "from trends", "year, month"),
    "geo_distribution": ("district_code neighborhood region_zone", "total_requests sla_breaches "
        "avg_resolution_hours repeat_count district_lat district_lng", "from geography",
        "total_requests desc, district_code, neighborhood"),
    "categories": ("request_category request_type_name priority_level", "request_count "
        "avg_resolution_hours sla_breached_count breach_rate_pct", "from categories",
        "request_count desc, request_category, request_type_name, priority_level"),
    "backlog_aging": ("department_name request_category", "total_backlog_tickets aging_0_to_3_days "
        "aging_4_to_7_days aging_8_to_14_days aging_over_14_days max_open_days",
        f"from (select department_name, request_category, {_AGES} from open_tickets group by all)",
        "department_name, request_category"),
}
_NAMES = {
    "overview": "''",
    "departments": "department_name || '|' || division_name",
    "monthly_trends": "year_month",
    "geo_distribution": "district_code || '|' || neighborhood",
    "categories": "request_category || '|' || request_type_name || '|' || priority_level",
    "backlog_aging": "department_name || '|' || request_category",
}


def _cells(place: str) -> str:
    """A row per value of every mart, with its position or its name."""
    parts = []
    for section, (texts, numbers, source, order) in _SECTIONS.items():
        own = f"row_number() over (order by {order})" if place == "position" else _NAMES[section]
        values = [
            f"{{'field': '{name}', 'number': cast(null as double), 'text': cast({name} as varchar)}}"
            for name in texts.split()
        ] + [
            f"{{'field': '{name}', 'number': cast({name} as double), 'text': cast(null as varchar)}}"
            for name in numbers.split()
        ]
        parts.append(
            f"select '{section}' as section, place as {place}, cell.field as field, "
            f"cell.number as number, cell.text as text from (select place, unnest(cells) as cell from "
            f"(select {own} as place, [{', '.join(values)}] as cells {source}))"
        )
    return " union all ".join(parts)


def _raw_fact() -> str:
    """The left-joined fact of raw tickets."""
    timed = _TABLES["timed"].replace("from staged", "from raw")
    fact = _TABLES["fact"].replace("\n        join", "\n        left join").replace("from timed", f"from ({timed}) as timed")
    keys = "location_key request_type_key department_key status_key".split()
    select = _FACT_SELECT
    for key in keys:
        select = select.replace(f"{key}, ", f"cast({key} as double) as {key}, ", 1)
    return f"select {select} from ({fact})"


_HOLED = {
    "dim_date": "month <> 3",
    "dim_location": "location_key % 2 = 0",
    "dim_request_type": "request_type_key % 3 <> 0",
    "dim_department": "department_key > 5",
    "dim_status": "is_closed",
}
_ALL_LENGTHS = {
    "staged": ("staging", _LENGTHS),
    "dates": ("dim_date", {"quarter_name": 10, "month_name": 20, "day_name": 20}),
    "locations": ("dim_location", {"district_code": 20, "neighborhood": 100, "zip_code": 20, "region_zone": 50}),
    "kinds": ("dim_request_type", {"request_category": 100, "request_type_name": 150, "priority_level": 20}),
    "teams": ("dim_department", {"department_name": 100, "division_name": 100, "department_head": 100}),
    "statuses": ("dim_status", {"status_name": 50}),
    "fact": ("fact_service_requests", {"ticket_number": 50}),
}
_RANGES = {
    "staged": ("staging", {"target_sla_hours": 8, "latitude": 4, "longitude": 4}),
    "locations": ("dim_location", {"latitude": 4, "longitude": 4}),
    "kinds": ("dim_request_type", {"default_sla_hours": 8}),
    "fact": ("fact_service_requests", {"resolution_time_hours": 8, "target_sla_hours": 8, "sla_variance_hours": 8}),
}
_NUMBERED = {"staging(raw_id)": "staged", "fact_service_requests(fact_id)": "fact"}


def _numbered_rules() -> str:
    """Keys that number the rows of a table."""
    return " union all ".join(
        f"select '{rule}' as rule, count(*) - count(distinct id) as violations from "
        f"(select row_number() over () as id from {table})"
        for rule, table in _NUMBERED.items()
    )


def _row_rules() -> str:
    """What rows of staging and of the fact break by themselves."""
    rules = [(f"fact_service_requests.{name}", f"{name} is null") for name in _MANDATORY["fact_service_requests"].split()]
    parts = [_unpivoted([("fact_service_requests.fact_id", "false"), *rules], "fact")]
    for table in ["staged", "fact"]:
        stored, lengths = _ALL_LENGTHS[table]
        parts.append(_unpivoted([(f"{stored}.{c}", f"length({c}) > {limit}") for c, limit in lengths.items()], table))
        stored, ranges = _RANGES[table]
        parts.append(_unpivoted([(f"{stored}.{c}", f"abs({c}) >= 1e{whole}") for c, whole in ranges.items()], table))
    return " union all ".join(parts)


def oracle_queries() -> dict[str, str]:
    """SQL by query name."""
    dim = with_tables
    return {
        "raw_tickets": dim("raw", f"select {_columns()} from raw"),
        "clean_fill_defaults": dim(
            "raw",
            "select ticket_number, arrival_date, arrival_part, arrival_supplier, "
            "coalesce(district_code, 'DIST-UNKNOWN') as district_code, "
            "coalesce(neighborhood, 'Unknown Neighborhood') as neighborhood, "
            "coalesce(zip_code, '00000') as zip_code from raw",
        ),
        "clean_trim_text": dim(
            "raw",
            "select ticket_number, arrival_date, arrival_part, arrival_supplier, "
            + ", ".join(f"{_strip(name)} as {name}" for name in _STRIPPED)
            + " from raw",
        ),
        "dedup_keep_first": dim("ranked", f"select {_columns()} from ranked where place = 1"),
        "clean_tickets": dim("staged", f"select {_columns()} from staged"),
        "dq_null_checks": dim("raw", _null_check("raw")),
        "dq_timestamp_logic": dim("raw", _time_check("raw")),
        "dq_uniqueness": dim("raw", _unique_check("raw")),
        "dq_audit_log": dim("raw", _full_audit("raw")),
        "dq_audit_after_cleaning": dim("staged", _full_audit("staged")),
        "dq_overall": dim(
            "raw",
            f"select cast(bool_and(status = 'PASSED') as boolean) as passed from ({_full_audit('raw')})",
        ),
        "date_bounds": dim("bounds", "select * from bounds"),
        "dim_date": dim(
            "dates", "select * replace (cast(full_date as varchar) as full_date) from dates"
        ),
        "dim_location": dim(
            "locations",
            "select * replace (cast(latitude as double) as latitude, "
            "cast(longitude as double) as longitude) from locations",
        ),
        "dim_request_type": dim(
            "kinds",
            "select * replace (cast(default_sla_hours as double) as default_sla_hours) from kinds",
        ),
        "dim_department": dim("teams", "select * from teams"),
        "dim_status": dim("statuses", "select * from statuses"),
        "fact_service_requests": dim("fact", f"select {_FACT_SELECT} from fact"),
        "fact_by_dictionary": dim("fact", f"select {_FACT_SELECT} from fact"),
        "observed_audit_log": dim("staged", f"{_null_check('staged')} union all {_time_check('staged')}"),
        "observed_audit_raw": dim("raw", f"{_null_check('raw')} union all {_time_check('raw')}"),
        "observed_rules": dim(f"{_ALL} staged", _row_rules()),
        "fact_left_join": dim(
            "fact",
            f"select {_FACT_SELECT} from ("
            + _TABLES["fact"].replace("\n        join", "\n        left join")
            + ")",
        ),
        "constraint_unique": dim(
            _ALL,
            f"{_unique_rules()} union all {_numbered_rules()}",
        ),
        "constraint_unique_raw": dim(
            "raw",
            " union all ".join(
                f"select 'raw({keys})' as rule, count(*) filter (place > 1) as violations from (select "
                f"row_number() over (partition by {keys}) as place from raw where {keys.split(', ')[0]} is not null)"
                for keys in ["ticket_number", "district_code, neighborhood", "status"]
            ),
        ),
        "constraint_not_null_raw": dim(
            "raw", _unpivoted([(f"raw.{name}", f"{name} is null") for name in _RAW], "raw")
        ),
        "constraint_fk_holed": dim(
            _ALL,
            " union all ".join(
                f"select '{column} -> {dimension}' as rule, count(*) as violations from fact where {column} "
                f"is not null and {column} not in (select {key} from {_STORED[dimension]} where {_HOLED[dimension]})"
                for column, dimension, key in _REFERENCES
            ),
        ),
        "constraint_lost_raw": dim(
            _ALL,
            _unpivoted(
                [(f"no {key}", f"{key} is null") for key in
                 ["location_key", "request_type_key", "department_key", "status_key"]],
                "(" + _LOST.replace("from staged", "from raw as staged") + ")",
            )
            + " union all select 'lost tickets' as rule, cast(sum(greatest(n - kept, 0)) as bigint) as violations from "
            "(select ticket_number, count(*) as n from raw group by all) left join "
            "(select ticket_number, count(*) as kept from fact group by all) using (ticket_number)",
        ),
        "constraint_length_raw": dim(
            "raw",
            _unpivoted(
                [(f"staging.{name}", f"length(repeat({name}, 12)) > {limit}") for name, limit in _LENGTHS.items()],
                "raw",
            ),
        ),
        "constraint_ranges": dim(
            f"{_ALL} staged",
            " union all ".join(
                _unpivoted([(f"{name}.{c}", f"abs({c}) >= 1e{whole}") for c, whole in columns.items()], table)
                for table, (name, columns) in _RANGES.items()
            ),
        ),
        "constraint_ranges_raw": dim(
            "raw",
            _unpivoted(
                [
                    ("staging.target_sla_hours", "cast(target_sla_hours as double) * 1000000 >= 1e8"),
                    ("staging.latitude", "abs(cast(latitude as double) * 307) >= 1e4"),
                    ("staging.longitude", "abs(cast(longitude as double) * 100) >= 1e4"),
                ],
                "raw",
            ),
        ),
        "location_conflicts_raw": dim(
            "raw",
            "select priority_level as district_code, division_name as neighborhood, "
            "count(distinct zip_code) as zip_codes, count(distinct zip_code) > 1 as is_conflict "
            "from raw group by all",
        ),
        "fact_left_join_unmatched": dim("raw locations kinds teams statuses", _raw_fact()),
        "views_of_published": dim(_MARTS, _cells("name")),
        "kpi_payload_json": dim(_MARTS, _cells("position")),
        "constraint_not_null": dim(
            _ALL,
            f"{_not_null_rules()} union all select 'fact_service_requests.fact_id' as rule, "
            "count(*) filter (id is null) as violations from (select row_number() over () as id from fact)",
        ),
        "constraint_fk_orphans": dim(_ALL, _reference_rules()),
        "constraint_lost_tickets": dim(_ALL, _lost_rules()),
        "constraint_length": dim(
            f"{_ALL} staged",
            " union all ".join(
                _unpivoted([(f"{name}.{c}", f"length({c}) > {limit}") for c, limit in columns.items()], table)
                for table, (name, columns) in _ALL_LENGTHS.items()
            ),
        ),
        "location_grain_conflicts": dim(
            "staged",
            "select district_code, neighborhood, count(distinct zip_code) as zip_codes, "
            "count(distinct zip_code) > 1 as is_conflict from staged group by all",
        ),
        "kpi_operational_overview": dim("overview", "select * from overview"),
        "kpi_department_performance": dim("performance", "select * from performance"),
        "dept_compliance_all": dim(
            "performance",
            "select department_name, division_name, total_tickets, avg_resolution_hours, "
            "sla_breach_count, avg_satisfaction, "
            + share("total_tickets - sla_breach_count", "total_tickets")
            + " as sla_compliance_pct from performance",
        ),
        "kpi_monthly_trends": dim("trends", _TRENDS),
        "kpi_monthly_trends_first12": dim("trends", f"{_TRENDS} order by year, month limit 12"),
        "kpi_geographic_distribution": dim("geography", "select * from geography"),
        "kpi_category_breakdown": dim("categories", "select * from categories"),
        "kpi_backlog_aging": dim(
            "open_tickets",
            f"select department_name, request_category, {_AGES} from open_tickets group by all",
        ),
        "backlog_by_department": dim(
            "open_tickets", f"select department_name, {_AGES} from open_tickets group by all"
        ),
        "kpi_headlines": dim("overview", _HEADLINES),
        "dash_filter_options": dim("performance categories geography", _OPTIONS),
        "dash_filtered_departments": dim(
            "performance", f"select * from performance where department_name = '{DEPARTMENT}'"
        ),
        "dash_filter_caption": dim(
            "performance",
            "select cast(sum(total_tickets) as bigint) as shown_tickets, 'Showing ' || "
            "format('{:,}', cast(sum(total_tickets) as bigint)) || ' Filtered Incidents' "
            f"as caption from performance where department_name = '{DEPARTMENT}'",
        ),
        "dash_filtered_categories": dim(
            "categories",
            f"select * from categories where request_category = '{CATEGORY}' "
            f"and priority_level = '{PRIORITY}'",
        ),
        "dash_category_share": dim(
            "categories",
            "select request_category, cast(sum(request_count) as bigint) as request_count "
            "from categories group by request_category",
        ),
        "dash_trend_series": dim(
            "trends", "select year_month as label, ticket_volume, sla_breaches from trends"
        ),
        "dash_workload_series": dim(
            "performance",
            "select division_name as label, total_tickets, "
            "coalesce(avg_resolution_hours, 0.0) as avg_resolution_hours from performance",
        ),
        "dash_place_series": dim(
            "geography",
            "select district_code || ' (' || neighborhood || ')' as label, total_requests "
            "from geography",
        ),
        "dash_backlog_series": dim(
            "open_tickets",
            "select label, aging_0_to_3_days, aging_4_to_7_days, aging_8_to_14_days, "
            f"aging_over_14_days from (select department_name as label, {_AGES} "
            "from open_tickets group by all)",
        ),
        "drilldown_overview": dim("fact", _on(_CHOSEN, "overview")),
        "drilldown_departments": dim("fact", _on(_PLACED, "performance")),
        "drilldown_categories": dim("fact", _on(_CHOSEN, "categories")),
        "drilldown_geography": dim("fact", _on(_CHOSEN, "geography")),
        "csv_roundtrip": dim("raw", f"select {_columns()} from raw"),
        "json_roundtrip": dim(_MARTS, _cells("position")),
        "views_by_name": dim(_MARTS, _TOTALS.replace("{trends}", "trends")),
        "pipeline_rerun_totals": dim(_MARTS, _TOTALS.replace("{trends}", "trends")),
    }
