import re
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casemart.operators import dimensions, integrity, marts, rollup
from casemart.operators.fact import FACT_COLUMNS, build_fact
from tickets import DEFAULTS, keyed, numbered, raw, star

START = DEFAULTS["created_date"]


def days(spark, *moments):
    bounds = spark.createDataFrame(
        [(min(moments), max(moments))], "min_date timestamp_ntz, max_date timestamp_ntz"
    )
    return {row["full_date"]: row for row in dimensions.dim_date(bounds).collect()}


def test_calendar_span(spark):
    found = days(spark, datetime(2024, 1, 10, 23), datetime(2024, 1, 12))
    assert min(found) == date(2023, 12, 11) and max(found) == date(2024, 3, 12)
    assert len(found) == 93


def test_fiscal_year_starts_in_october(spark):
    found = days(spark, datetime(2023, 10, 1), datetime(2024, 7, 1))
    fiscal = {
        day: (found[day]["fiscal_year"], found[day]["fiscal_quarter"])
        for day in [date(2023, 9, 30), date(2023, 10, 1), date(2024, 1, 1), date(2024, 7, 31)]
    }
    assert list(fiscal.values()) == [(2022, 4), (2023, 1), (2023, 2), (2023, 4)]


def test_week_days(spark):
    sunday = days(spark, datetime(2024, 1, 7))[date(2024, 1, 7)]
    assert (sunday["day_of_week"], sunday["day_name"], sunday["is_weekend"]) == (7, "Sunday", True)
    friday = days(spark, datetime(2024, 1, 7))[date(2024, 1, 5)]
    assert (friday["day_of_week"], friday["is_weekend"], friday["date_key"]) == (5, False, 20240105)
    assert (friday["quarter_name"], friday["month_name"]) == ("Q1", "January")


def test_bounds_span_closes_too(spark):
    rows = numbered({"closed_date": datetime(2025, 6, 1)}, {"closed_date": datetime(2024, 1, 1)})
    bounds = dimensions.date_bounds(raw(spark, *rows)).first()
    assert tuple(bounds) == (datetime(2024, 1, 1), datetime(2025, 6, 1))


def test_no_tickets_no_calendar(spark):
    empty = raw(spark, {}).limit(0)
    assert dimensions.dim_date(dimensions.date_bounds(empty)).count() == 0
    assert dimensions.dim_location(empty).count() == 0


def test_location_has_one_row_per_neighborhood(spark):
    rows = numbered(
        {"zip_code": "20459", "latitude": Decimal("53.540001")},
        {"zip_code": "20457", "latitude": Decimal("53.540002")},
        {"district_code": "DIST-03", "neighborhood": "Hills"},
    )
    staging = raw(spark, *rows)
    found = keyed("dim_location", dimensions.dim_location(staging)).orderBy("location_key").collect()
    assert [(row["location_key"], row["district_code"]) for row in found] == [
        (1, "DIST-01"), (2, "DIST-03"),
    ]
    assert found[0]["zip_code"] == "20457" and found[0]["latitude"] == Decimal("53.540002")
    assert [row["region_zone"] for row in found] == ["North Region", "South Region"]
    assert integrity.location_conflicts(staging).collect()[0]["zip_codes"] == 2
    assert star(spark, *rows).fact.count() == 3


def test_status_prefix_is_case_sensitive(spark):
    rows = numbered({"status": "closed - x"}, {"status": "Closed - y"}, {"status": "Assigned"})
    found = {row["status_name"]: row for row in star(spark, *rows).statuses.collect()}
    assert found["closed - x"]["is_active"] and not found["closed - x"]["is_closed"]
    assert found["Closed - y"]["is_closed"] and not found["Closed - y"]["is_active"]
    assert [found[name]["status_key"] for name in sorted(found)] == [1, 2, 3]


def test_request_type_and_department(spark):
    rows = numbered({"target_sla_hours": Decimal("24.00")}, {"target_sla_hours": Decimal("24.01")})
    found = star(spark, *rows)
    assert found.request_types.first()["default_sla_hours"] == Decimal("24.01")
    assert tuple(found.departments.first()) == (1, "Harbour Office", "Piers", "Dept Director", 30)


def test_numbers_run_on_across_partitions(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered_rows = dimensions.number_rows(rows, ["v"], "k", str(tmp_path / "sorted")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted((row["v"], row["k"]) for row in numbered_rows) == [(v, v + 1) for v in range(1000)]


def fact_of(spark, *rows, how="inner"):
    found = star(spark, *rows, how=how)
    assert found.fact.columns == FACT_COLUMNS
    return found.fact.orderBy("ticket_number").collect()


def test_measures_of_a_closed_ticket(spark):
    (row,) = fact_of(spark, {})
    assert (row["created_date_key"], row["closed_date_key"]) == (20240506, 20240506)
    assert row["resolution_time_hours"] == Decimal("3.00")
    assert row["sla_variance_hours"] == Decimal("-45.00")
    assert row["is_sla_breached"] is False


def test_breach_is_decided_before_rounding(spark):
    rows = numbered(
        {"closed_date": START + timedelta(hours=48)},
        {"closed_date": START + timedelta(hours=48, seconds=14)},
        {"closed_date": START + timedelta(hours=48, microseconds=1)},
    )
    found = fact_of(spark, *rows)
    assert [row["is_sla_breached"] for row in found] == [False, True, True]
    assert [str(row["resolution_time_hours"]) for row in found] == ["48.00", "48.00", "48.00"]


def test_open_ticket_has_no_measures(spark):
    (row,) = fact_of(spark, {"closed_date": None, "status": "Assigned", "is_repeat": None})
    assert row["closed_date_key"] is None and row["resolution_time_hours"] is None
    assert row["sla_variance_hours"] is None
    assert row["is_sla_breached"] is False and row["is_repeat_incident"] is False


def test_negative_durations_reach_the_fact(spark):
    (row,) = fact_of(spark, {"closed_date": START - timedelta(hours=1, seconds=18)})
    assert row["resolution_time_hours"] == Decimal("-1.01")
    assert row["sla_variance_hours"] == Decimal("-49.01")


def test_unmatched_tickets(spark):
    rows = numbered({}, {"department_name": None}, {"status": None, "division_name": None})
    assert [row["ticket_number"] for row in fact_of(spark, *rows)] == ["SR-1"]
    outer = fact_of(spark, *rows, how="left")
    assert [row["department_key"] is None for row in outer] == [False, True, True]
    found = star(spark, *rows)
    lost = integrity.check_lost_tickets(raw(spark, *rows), found)
    assert {row["rule"]: row["violations"] for row in lost.collect()} == {
        "no location_key": 0,
        "no request_type_key": 0,
        "no department_key": 2,
        "no status_key": 1,
        "lost tickets": 2,
    }
    kept = star(spark, *rows, how="left")
    lost = integrity.check_lost_tickets(raw(spark, *rows), kept)
    assert {row["rule"]: row["violations"] for row in lost.collect()}["lost tickets"] == 0


def test_lost_tickets_are_found_in_the_fact(spark):
    rows = [*numbered({}, {}, {}), {"ticket_number": None}]
    found = star(spark, *rows)
    holed = replace(found, fact=found.fact.filter("coalesce(ticket_number, '') <> 'SR-2'"))

    def lost(tables):
        checks = integrity.check_lost_tickets(raw(spark, *rows), tables).collect()
        return {row["rule"]: row["violations"] for row in checks}["lost tickets"]

    assert (lost(found), lost(holed)) == (0, 1)
    without_null = replace(found, fact=found.fact.filter("ticket_number IS NOT NULL"))
    assert lost(without_null) == 1


def test_constraints_hold_on_a_good_star(spark):
    found = star(spark, *numbered({}, {"district_code": "DIST-02", "neighborhood": "North"}))
    checks = integrity.check_unique(found.tables()).unionByName(
        integrity.check_not_null(found.tables())
    )
    assert checks.filter("violations > 0").count() == 0
    assert integrity.check_foreign_keys(found).filter("violations > 0").count() == 0


def test_constraints_report_violations(spark):
    found = star(spark, {}, {}, {"ticket_number": None}, {"ticket_number": None})
    unique = {row["rule"]: row["violations"] for row in integrity.check_unique(found.tables()).collect()}
    assert unique["fact_service_requests(ticket_number)"] == 1
    missing = {
        row["rule"]: row["violations"] for row in integrity.check_not_null(found.tables()).collect()
    }
    assert missing["fact_service_requests.ticket_number"] == 2


def test_orphans_are_counted_by_fact_row(spark):
    found = star(spark, *numbered({}, {}, {"status": "Assigned", "closed_date": None}))
    tables = found.tables()
    holed = type(found)(
        found.fact, found.dates.limit(0), found.locations, found.request_types,
        found.departments, tables["dim_status"].filter("is_closed"),
    )
    rules = {row["rule"]: row["violations"] for row in integrity.check_foreign_keys(holed).collect()}
    assert rules["created_date_key -> dim_date"] == 3
    assert rules["closed_date_key -> dim_date"] == 2
    assert rules["status_key -> dim_status"] == 1
    assert rules["location_key -> dim_location"] == 0


def test_number_ranges(spark):
    wide = spark.sql("SELECT 99999999.99 AS target_sla_hours, -10000.0 AS latitude, NULL AS longitude")
    found = integrity.check_number_ranges({"staging": wide}).collect()
    assert {row["rule"]: row["violations"] for row in found} == {
        "staging.target_sla_hours": 0, "staging.latitude": 1, "staging.longitude": 0,
    }


def test_text_limits(spark):
    rows = numbered({"priority_level": "x" * 20}, {"priority_level": "x" * 21})
    limits = integrity.check_text_limits({"staging": raw(spark, *rows)})
    broken = {row["rule"]: row["violations"] for row in limits.collect() if row["violations"]}
    assert broken == {"staging.priority_level": 1}


def test_equal_counts_and_other_tickets(spark):
    """As many rows in the fact as in staging, but two tickets are others; and one is there twice."""
    rows = numbered(*[{} for _ in range(40)])
    staging = raw(spark, *rows)
    other = F.when(F.col("ticket_number").isin("SR-3", "SR-17"), F.lit("SR-other")).otherwise(F.col("ticket_number"))
    for buckets in [1, 3, 4096]:
        found = integrity.lost_tickets(staging, staging.withColumn("ticket_number", other), buckets)
        assert found.first()[0] == 2
        assert integrity.lost_tickets(staging, staging, buckets).first()[0] == 0
        assert integrity.lost_tickets(staging.union(staging), staging, buckets).first()[0] == 40
        assert integrity.lost_tickets(staging, staging.limit(0), buckets).first()[0] == 40
        assert integrity.lost_tickets(staging.limit(0), staging, buckets).first()[0] == 0


def test_equal_buckets_are_not_counted_per_ticket(spark):
    staging = raw(spark, *numbered(*[{} for _ in range(40)]))
    found = integrity.lost_tickets(staging, staging)
    found.collect()
    ran = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ticket_number" not in "".join(re.findall(r"Exchange hashpartitioning\(([^)]*)", ran)), ran


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dictionary_gives_the_same_fact(spark, how):
    rows = numbered({}, {}, {"department_name": None}, {"status": None, "division_name": None}, {"status": "Assigned", "closed_date": None})
    staging, found = raw(spark, *rows), star(spark, *rows)
    dimensions = (found.locations, found.request_types, found.departments, found.statuses)
    facts = [build_fact(staging, *dimensions, how, dictionary) for dictionary in (False, True)]
    one, other = (sorted(map(str, fact.collect())) for fact in facts)
    assert one == other and len(one) == (3 if how == "inner" else 5)


def test_stored_sums_give_the_same_marts(spark):
    rows = numbered({}, {"status": "Assigned", "closed_date": None}, {"division_name": "Tugs", "satisfaction_rating": None}, {"status": None})
    for how in ["inner", "left"]:
        found = star(spark, *rows, how=how)
        summed = replace(found, sums=rollup.mart_sums(found.fact))
        for name, mart in marts.all_marts(summed, "2025-02-01").items():
            expected = marts.all_marts(found, "2025-02-01")[name]
            assert sorted(map(str, mart.collect())) == sorted(map(str, expected.collect())), name
        nothing = replace(found, fact=found.fact.limit(0), sums=rollup.mart_sums(found.fact.limit(0)))
        assert marts.operational_overview(nothing).first()["total_requests"] == 0
