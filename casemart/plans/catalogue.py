"""The registered queries, one per operator or report.

Each takes a session and a folder of tables. Raw tickets are derived from the
tables and landed once per session and folder, in the shared work folder, and so
is the warehouse; the queries read what they need from there, as they would read
any landed feed. Nothing is kept in memory, and a lost executor costs a re-read.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.operators import audit, cleaning, dimensions, drilldown, integrity, marts
from casemart.operators.fact import FACT_COLUMNS, build_fact
from casemart.operators.star import Star
from casemart.plans.choices import AS_OF, CATEGORY, DEPARTMENT, DISTRICT, PRIORITY
from casemart.plans.pipeline import run_pipeline
from casemart.plans.warehouse import Warehouse, build_warehouse, one_row, open_views, open_warehouse, write_counted
from casemart.schema import RAW_COLUMNS
from casemart.session import lower_splits, shuffles_released, sized_shuffles, work_folder
from casemart.sinks import exports
from casemart.sources.derived import ARRIVAL, derive_tickets
from casemart.sources.tickets import read_tickets

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Prepared:
    """Landed raw tickets and the warehouse built from them."""

    scratch: str
    raw: DataFrame
    warehouse: Warehouse

    # Lazy frames, opened once so that each query does not list the files again.
    @cached_property
    def staging(self) -> DataFrame:
        return self.warehouse.staging()

    @cached_property
    def star(self) -> Star:
        return self.warehouse.star()


_prepared: dict[tuple[str, str], Prepared] = {}
_lock = threading.Lock()


def scratch_folder(spark: SparkSession, folder: str) -> str:
    """This session's own folder for what is derived from `folder`."""
    name = hashlib.sha256(folder.encode()).hexdigest()[:12]
    return f"{work_folder(spark)}/casemart/{spark.sparkContext.applicationId}/{name}"


def land_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Write the derived raw tickets and read them back."""
    path = f"{scratch_folder(spark, folder)}/raw"
    tickets = derive_tickets(spark, folder)
    tickets.write.mode("overwrite").parquet(path)
    return spark.read.schema(tickets.schema).parquet(path)


def prepare(spark: SparkSession, folder: str) -> Prepared:
    """The landed tickets and the warehouse, built at the first call."""
    key = (spark.sparkContext.applicationId, folder)
    with _lock:
        if key not in _prepared:
            scratch = scratch_folder(spark, folder)
            with sized_shuffles(derive_tickets(spark, folder)), shuffles_released(spark):
                raw = land_tickets(spark, folder)
                warehouse = build_warehouse(spark, raw, ARRIVAL, f"{scratch}/warehouse")
            # The queries run later, when the block above is over.
            lower_splits(raw)
            _prepared[key] = Prepared(scratch, raw, warehouse)
        return _prepared[key]


def use(spark: SparkSession, folder: str, ready: Prepared) -> None:
    """Let the queries on `folder` read tables that are already there."""
    with _lock:
        _prepared[spark.sparkContext.applicationId, folder] = ready


# Client libraries disagree on a missing integer or boolean, not on a missing
# double or text.
_MAY_LACK_INTEGER = {"satisfaction_rating", "closed_date_key", "prev_month_volume", "breaches"}
_MAY_LACK_BOOLEAN = {"is_repeat"}


def comparable(frame: DataFrame) -> DataFrame:
    """The same values in types that every engine's client hands over alike."""

    def convert(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType) or field.name in _MAY_LACK_INTEGER:
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType) or field.name in _MAY_LACK_BOOLEAN:
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return frame.select(*[convert(field) for field in frame.schema])


def _on_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(prepare(spark, folder).raw))


def _on_staging(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(prepare(spark, folder).staging))


def _on_star(build: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(prepare(spark, folder).star))


def _fact_left(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare(spark, folder)
    star = ready.star
    fact = build_fact(
        ready.staging, star.locations, star.request_types, star.departments, star.statuses, "left"
    )
    return comparable(fact)


def _fact_left_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Raw tickets, with missing places and padded names, keep their rows without keys."""
    ready = prepare(spark, folder)
    star = ready.star
    fact = build_fact(
        ready.raw, star.locations, star.request_types, star.departments, star.statuses, "left"
    )
    keys = ["location_key", "request_type_key", "department_key", "status_key"]
    return comparable(fact).withColumns({key: F.col(key).cast("double") for key in keys})


def _fact_by_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The fact by way of resolved combinations of names, as for dimensions too large to broadcast."""
    ready = prepare(spark, folder)
    star = ready.star
    dimensions = (star.locations, star.request_types, star.departments, star.statuses)
    return comparable(build_fact(ready.staging, *dimensions, dictionary=True))


def _observed_log(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of staging, counted in the pass that wrote it."""
    return audit.row_log(one_row(spark, prepare(spark, folder).warehouse.counts("staging")))


def _observed_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The null and time checks of raw tickets, counted while they are written once more."""
    ready = prepare(spark, folder)
    return audit.row_log(one_row(spark, write_counted(ready.raw, f"{ready.scratch}/counted", audit.row_counts(ready.raw.schema))))


def _observed_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The rules that rows of staging and of the fact break by themselves, counted in the passes that wrote them."""
    warehouse = prepare(spark, folder).warehouse
    names = ["staging", "fact_service_requests"]
    rules = {name: integrity.row_rules(name, warehouse.table(name).columns) for name in names}
    logs = [integrity.rule_log(one_row(spark, warehouse.counts(name)), rules[name]) for name in names]
    return reduce(DataFrame.unionByName, logs)


def _lost_raw(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare(spark, folder)
    return integrity.check_lost_tickets(ready.raw, ready.star)


def _unique_raw(raw: DataFrame) -> DataFrame:
    keys = [["ticket_number"], ["district_code", "neighborhood"], ["status"]]
    rules = [integrity.unique_violations(raw, own, f"raw({', '.join(own)})") for own in keys]
    return reduce(DataFrame.unionByName, rules)


def _holed(star: Star) -> Star:
    """A star whose dimensions lack some of the rows that the fact refers to."""
    return replace(
        star,
        dates=star.dates.filter("month <> 3"),
        locations=star.locations.filter("location_key % 2 = 0"),
        request_types=star.request_types.filter("request_type_key % 3 <> 0"),
        departments=star.departments.filter("department_key > 5"),
        statuses=star.statuses.filter("is_closed"),
    )


def _long_texts(raw: DataFrame) -> DataFrame:
    """Tickets with every text twelve times over, so that limits are broken."""
    texts = [field.name for field in raw.schema if isinstance(field.dataType, T.StringType)]
    return raw.withColumns({name: F.repeat(name, F.lit(12)) for name in texts})


def _large_numbers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "target_sla_hours": F.col("target_sla_hours").cast("double") * 1_000_000,
            "latitude": F.col("latitude").cast("double") * 307,
            "longitude": F.col("longitude").cast("double") * 100,
        }
    )


def _places_with_many_zips(raw: DataFrame) -> DataFrame:
    return integrity.zip_codes_per_location(
        raw.select(
            F.col("priority_level").alias("district_code"),
            F.col("division_name").alias("neighborhood"),
            "zip_code",
        )
    )


def _unique(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare(spark, folder)
    return integrity.check_unique({"staging": ready.staging, **ready.star.tables()})


def _lost(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare(spark, folder)
    return integrity.check_lost_tickets(ready.staging, ready.star)


def _clean(tickets: DataFrame) -> DataFrame:
    return cleaning.clean(tickets, ARRIVAL).select(*RAW_COLUMNS)


def _compliance_over_all(star: Star) -> DataFrame:
    return marts.department_performance(star, "all").select(
        "department_name", "division_name", "total_tickets", "avg_resolution_hours",
        "sla_breach_count", "avg_satisfaction", "sla_compliance_pct",
    )


def _shown_departments(star: Star) -> DataFrame:
    return drilldown.filter_departments(marts.department_performance(star), DEPARTMENT)


def _options(star: Star) -> DataFrame:
    return drilldown.filter_options(star.departments, marts.kinds(star), marts.places(star))


def _chosen(star: Star) -> Star:
    return drilldown.filter_star(star, department=DEPARTMENT, priority=PRIORITY)


def _placed(star: Star) -> Star:
    return drilldown.filter_star(star, district=DISTRICT, category=CATEGORY)


def cells(section: str, frame: DataFrame, place: str) -> DataFrame:
    """A row per value of a mart: section, place, field, and the value as number or text."""
    values = []
    for field in frame.schema:
        if field.name == place:
            continue
        text = isinstance(field.dataType, T.StringType)
        number = F.lit(None).cast("double") if text else F.col(field.name).cast("double")
        words = F.col(field.name) if text else F.lit(None).cast("string")
        values.append(F.struct(F.lit(field.name).alias("field"), number.alias("number"), words.alias("text")))
    return frame.select(F.lit(section).alias("section"), F.col(place), F.inline(F.array(*values)))


def _document(spark: SparkSession, folder: str, indent: bool) -> DataFrame:
    """Every value of the payload, from its files."""
    ready = prepare(spark, folder)
    frames = marts.all_marts(ready.star, AS_OF)
    path = f"{ready.scratch}/payload_{indent}"
    exports.write_payload(frames, path, indent)
    records = exports.read_payload(spark, path)
    # Every field of a record as text; the marts' types say which ones are numbers.
    fields = F.from_json("record", T.MapType(T.StringType(), T.StringType()), {"mode": "FAILFAST"})
    values = records.select("section", "position", F.explode(fields).alias("field", "value"))
    texts = [
        f"{section}.{field.name}"
        for section, view in zip(exports.SECTIONS, marts.VIEWS, strict=True)
        for field in exports.plain(frames[view]).schema
        if isinstance(field.dataType, T.StringType)
    ]
    is_text = F.concat_ws(".", "section", "field").isin(texts)
    number, text = F.when(~is_text, F.col("value").cast("double")), F.when(is_text, F.col("value"))
    return values.select("section", "position", "field", number.alias("number"), text.alias("text"))


# What names a record of each section.
_NAMES = {
    "overview": [],
    "departments": ["department_name", "division_name"],
    "monthly_trends": ["year_month"],
    "geo_distribution": ["district_code", "neighborhood"],
    "categories": ["request_category", "request_type_name", "priority_level"],
    "backlog_aging": ["department_name", "request_category"],
}


def _views_of_published(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of the six views of a warehouse that is opened by its place."""
    ready = prepare(spark, folder)
    open_views(spark, ready.warehouse.root, AS_OF)
    parts = []
    for section, view in zip(exports.SECTIONS, marts.VIEWS, strict=True):
        frame = exports.plain(spark.table(view))
        name = F.concat_ws("|", *_NAMES[section])
        parts.append(cells(section, frame.select(name.alias("name"), *frame.columns), "name"))
    return reduce(DataFrame.unionByName, parts)


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare(spark, folder)
    path = f"{ready.scratch}/csv"
    exports.write_tickets(ready.raw, path)
    return comparable(read_tickets(spark, path, "csv", escaped=True).select(*RAW_COLUMNS))


# The ticket and breach counts of each mart, where it has them.
_MEASURES = {
    "overview": ("total_requests", "total_sla_breaches"),
    "departments": ("total_tickets", "sla_breach_count"),
    "monthly_trends": ("ticket_volume", "sla_breaches"),
    "geo_distribution": ("total_requests", "sla_breaches"),
    "categories": ("request_count", "sla_breached_count"),
    "backlog_aging": ("total_backlog_tickets", None),
}


def totals(sections: dict[str, DataFrame]) -> DataFrame:
    """Records, tickets and breaches per section: equal totals mean no doubling."""
    rows = []
    for section, frame in sections.items():
        tickets, breaches = _MEASURES[section]
        rows.append(
            frame.agg(
                F.lit(section).alias("section"),
                F.count(F.lit(1)).alias("records"),
                F.sum(tickets).alias("tickets"),
                (F.sum(breaches) if breaches else F.lit(None).cast("bigint")).alias("breaches"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def _views_by_name(spark: SparkSession, folder: str) -> DataFrame:
    marts.register_views(prepare(spark, folder).star, AS_OF)
    found = {
        section: spark.sql(f"SELECT * FROM {view}")
        for section, view in zip(exports.SECTIONS, marts.VIEWS, strict=True)
    }
    return comparable(totals(found))


def _rerun(spark: SparkSession, folder: str) -> DataFrame:
    ready = prepare(spark, folder)
    root = f"{ready.scratch}/rerun"
    for _ in range(2):
        run_pipeline(spark, ready.raw, root, AS_OF, arrival=ARRIVAL)
    found = marts.all_marts(open_warehouse(spark, root).star(), AS_OF)
    return comparable(totals(dict(zip(exports.SECTIONS, found.values(), strict=True))))


def all_queries() -> dict[str, Query]:
    """Queries by name."""
    return {
        "raw_tickets": _on_raw(lambda raw: raw.select(*RAW_COLUMNS)),
        "clean_fill_defaults": _on_raw(
            lambda raw: cleaning.fill_places(raw).select(
                "ticket_number", *ARRIVAL, *cleaning.PLACE_DEFAULTS
            )
        ),
        "clean_trim_text": _on_raw(
            lambda raw: cleaning.strip_text(raw).select(
                "ticket_number", *ARRIVAL, *cleaning.STRIPPED
            )
        ),
        "dedup_keep_first": _on_raw(
            lambda raw: cleaning.keep_first(raw, ARRIVAL).select(*RAW_COLUMNS)
        ),
        "clean_tickets": _on_raw(_clean),
        "dq_null_checks": _on_raw(audit.check_nulls),
        "dq_timestamp_logic": _on_raw(audit.check_time_order),
        "dq_uniqueness": _on_raw(audit.check_uniqueness),
        "dq_audit_log": _on_raw(audit.audit),
        "dq_audit_after_cleaning": _on_staging(audit.audit),
        "dq_overall": _on_raw(lambda raw: audit.passed(audit.audit(raw))),
        "date_bounds": _on_staging(dimensions.date_bounds),
        "dim_date": _on_staging(lambda staging: dimensions.dim_date(dimensions.date_bounds(staging))),
        "dim_location": _on_star(lambda star: star.locations),
        "dim_request_type": _on_star(lambda star: star.request_types),
        "dim_department": _on_star(lambda star: star.departments),
        "dim_status": _on_star(lambda star: star.statuses),
        "fact_service_requests": _on_star(lambda star: star.fact.select(*FACT_COLUMNS)),
        "fact_by_dictionary": _fact_by_dictionary,
        "fact_left_join": _fact_left,
        "fact_left_join_unmatched": _fact_left_unmatched,
        "constraint_unique": _unique,
        "constraint_unique_raw": _on_raw(_unique_raw),
        "constraint_not_null": _on_star(lambda star: integrity.check_not_null(star.tables())),
        "constraint_not_null_raw": _on_raw(
            lambda raw: integrity.check_not_null({"raw": raw}, {"raw": RAW_COLUMNS})
        ),
        "constraint_fk_orphans": _on_star(integrity.check_foreign_keys),
        "constraint_fk_holed": _on_star(lambda star: integrity.check_foreign_keys(_holed(star))),
        "constraint_lost_tickets": _lost,
        "constraint_lost_raw": _lost_raw,
        "observed_audit_log": _observed_log,
        "observed_audit_raw": _observed_raw,
        "observed_rules": _observed_rules,
        "constraint_length": lambda spark, folder: integrity.check_text_limits(
            {"staging": prepare(spark, folder).staging, **prepare(spark, folder).star.tables()}
        ),
        "constraint_length_raw": _on_raw(
            lambda raw: integrity.check_text_limits({"staging": _long_texts(raw)})
        ),
        "constraint_ranges": lambda spark, folder: integrity.check_number_ranges(
            {"staging": prepare(spark, folder).staging, **prepare(spark, folder).star.tables()}
        ),
        "constraint_ranges_raw": _on_raw(
            lambda raw: integrity.check_number_ranges({"staging": _large_numbers(raw)})
        ),
        "location_grain_conflicts": _on_staging(integrity.zip_codes_per_location),
        "location_conflicts_raw": _on_raw(_places_with_many_zips),
        "kpi_operational_overview": _on_star(marts.operational_overview),
        "kpi_department_performance": _on_star(marts.department_performance),
        "dept_compliance_all": _on_star(_compliance_over_all),
        "kpi_monthly_trends": _on_star(marts.monthly_trends),
        "kpi_monthly_trends_first12": _on_star(
            lambda star: marts.monthly_trends(star, marts.TRENDS_SHOWN)
        ),
        "kpi_geographic_distribution": _on_star(marts.geographic_distribution),
        "kpi_category_breakdown": _on_star(marts.category_breakdown),
        "kpi_backlog_aging": _on_star(lambda star: marts.backlog_aging(star, AS_OF)),
        "backlog_by_department": _on_star(
            lambda star: marts.backlog_aging(star, AS_OF, by=["department_name"])
        ),
        "kpi_headlines": _on_star(
            lambda star: drilldown.headlines(marts.operational_overview(star))
        ),
        "dash_filter_options": _on_star(_options),
        "dash_filtered_departments": _on_star(_shown_departments),
        "dash_filter_caption": _on_star(
            lambda star: drilldown.filter_caption(_shown_departments(star))
        ),
        "dash_filtered_categories": _on_star(
            lambda star: drilldown.filter_categories(
                marts.category_breakdown(star), CATEGORY, PRIORITY
            )
        ),
        "dash_category_share": _on_star(
            lambda star: drilldown.category_share(marts.category_breakdown(star))
        ),
        "dash_trend_series": _on_star(
            lambda star: drilldown.trend_series(marts.monthly_trends(star))
        ),
        "dash_workload_series": _on_star(
            lambda star: drilldown.workload_series(marts.department_performance(star))
        ),
        "dash_place_series": _on_star(
            lambda star: drilldown.place_series(marts.geographic_distribution(star))
        ),
        "dash_backlog_series": _on_star(
            lambda star: drilldown.backlog_series(
                marts.backlog_aging(star, AS_OF, by=["department_name"])
            )
        ),
        "drilldown_overview": _on_star(lambda star: marts.operational_overview(_chosen(star))),
        "drilldown_departments": _on_star(lambda star: marts.department_performance(_placed(star))),
        "drilldown_categories": _on_star(lambda star: marts.category_breakdown(_chosen(star))),
        "drilldown_geography": _on_star(lambda star: marts.geographic_distribution(_chosen(star))),
        "kpi_payload_json": lambda spark, folder: _document(spark, folder, indent=False),
        "csv_roundtrip": _csv_roundtrip,
        "json_roundtrip": lambda spark, folder: _document(spark, folder, indent=True),
        "views_by_name": _views_by_name,
        "views_of_published": _views_of_published,
        "pipeline_rerun_totals": _rerun,
    }
