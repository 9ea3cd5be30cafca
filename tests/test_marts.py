from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from casemart.operators import drilldown, marts
from tickets import DEFAULTS, numbered, star

START = DEFAULTS["created_date"]
OPEN = {"closed_date": None, "status": "Assigned", "satisfaction_rating": None}
LATE = {"closed_date": START + timedelta(hours=60)}


@pytest.fixture(scope="module")
def city(spark):
    """Two departments, three divisions, two districts, four kinds of request."""
    rows = numbered(
        {},
        LATE,
        {**OPEN, "is_repeat": True},
        {"division_name": "Waste", "request_category": "Sanitation", "request_type": "Dumping"},
        {"division_name": "Waste", "request_category": "Sanitation", "request_type": "Dumping", **LATE},
        {
            "department_name": "Parks", "division_name": "Trees", "priority_level": "High",
            "district_code": "DIST-03", "neighborhood": "Hills", "satisfaction_rating": 2,
        },
        {
            "department_name": "Parks", "division_name": "Trees", "priority_level": "High",
            "district_code": "DIST-03", "neighborhood": "Hills", **OPEN,
            "created_date": datetime(2025, 3, 1),
        },
        # Closed by its status, with no closing time.
        {"closed_date": None, "request_type": "Streetlight"},
    )
    return star(spark, *rows)


def test_overview(city):
    row = marts.operational_overview(city).first().asDict()
    assert row == {
        "total_requests": 8,
        "total_closed_requests": 6,
        "current_backlog": 2,
        "avg_resolution_hours": 25.8,
        "avg_satisfaction_rating": 3.67,
        "total_sla_breaches": 2,
        "sla_compliance_pct": 66.67,
        "total_repeat_incidents": 1,
        "repeat_incident_pct": 12.5,
    }


def test_departments(city):
    found = {row["division_name"]: row for row in marts.department_performance(city).collect()}
    piers = found["Piers"]
    assert (piers["total_tickets"], piers["closed_tickets"], piers["open_backlog"]) == (4, 3, 1)
    assert (piers["sla_compliance_pct"], piers["avg_resolution_hours"]) == (66.67, 31.5)
    assert {name: row["workload_rank"] for name, row in found.items()} == {
        "Piers": 1, "Waste": 2, "Trees": 2,
    }


def test_rank_has_no_gap_after_a_tie(spark):
    rows = [{"division_name": name} for name in ["A", "A", "A", "B", "B", "C", "C", "D"]]
    found = marts.department_performance(star(spark, *numbered(*rows))).collect()
    assert {row["division_name"]: row["workload_rank"] for row in found} == {
        "A": 1, "B": 2, "C": 2, "D": 3,
    }


def test_compliance_over_all_tickets(city):
    found = marts.department_performance(city, "all").collect()
    shares = {row["division_name"]: row["sla_compliance_pct"] for row in found}
    assert shares == {"Piers": 75.0, "Waste": 50.0, "Trees": 100.0}
    with pytest.raises(ValueError):
        marts.department_performance(city, "open")


def test_trends_compare_with_the_last_month_that_has_tickets(city):
    first, second = marts.monthly_trends(city).collect()
    assert (first["year_month"], first["ticket_volume"]) == ("2024-05", 7)
    assert first["prev_month_volume"] is None and first["mom_volume_growth_pct"] is None
    assert (second["year_month"], second["month_name"]) == ("2025-03", "March")
    assert (second["prev_month_volume"], second["mom_volume_growth_pct"]) == (7, -85.71)
    assert [row["year_month"] for row in marts.monthly_trends(city, 1).collect()] == ["2024-05"]


def test_geography(city):
    busy, quiet = marts.geographic_distribution(city).collect()
    assert (busy["district_code"], busy["total_requests"], busy["sla_breaches"]) == ("DIST-01", 6, 2)
    assert (busy["region_zone"], busy["repeat_count"]) == ("North Region", 1)
    assert (quiet["neighborhood"], quiet["district_lat"], quiet["district_lng"]) == ("Hills", 53.54, 9.98)


def test_categories_divide_by_all_tickets(city):
    found = marts.category_breakdown(city).collect()
    assert [row["request_count"] for row in found] == [3, 2, 2, 1]
    assert found[0]["breach_rate_pct"] == 33.33


def test_backlog_ages(city):
    found = {
        row["department_name"]: row for row in marts.backlog_aging(city, date(2024, 5, 13)).collect()
    }
    works, parks = found["Harbour Office"], found["Parks"]
    assert (works["aging_4_to_7_days"], works["max_open_days"]) == (1, 7)
    # Created after the date: a negative age falls in the first class.
    assert (parks["aging_0_to_3_days"], parks["max_open_days"]) == (1, -292)


@pytest.mark.parametrize(
    ("age", "column"),
    [
        (0, "aging_0_to_3_days"), (3, "aging_0_to_3_days"), (4, "aging_4_to_7_days"),
        (7, "aging_4_to_7_days"), (8, "aging_8_to_14_days"), (14, "aging_8_to_14_days"),
        (15, "aging_over_14_days"),
    ],
)
def test_age_class_borders(city, age, column):
    on_day = (START + timedelta(days=age)).date()
    row = marts.backlog_aging(city, on_day).filter("department_name = 'Harbour Office'").first()
    classes = [name for name, _, _ in marts.AGE_CLASSES]
    assert [name for name in classes if row[name]] == [column]


def test_open_ticket_past_its_target_is_backlog_not_breach(spark):
    found = star(spark, *numbered(OPEN))
    assert marts.operational_overview(found).first()["total_sla_breaches"] == 0
    assert marts.backlog_aging(found, "2026-01-01").first()["aging_over_14_days"] == 1


def test_backlog_by_department_uses_today_by_default(city):
    rows = marts.backlog_aging(city, by=["department_name"]).collect()
    assert {row["department_name"]: row["total_backlog_tickets"] for row in rows} == {
        "Harbour Office": 1, "Parks": 1,
    }


def test_mean_ending_in_half_a_cent(spark):
    rows = numbered(
        {"target_sla_hours": Decimal("0.01")}, {"target_sla_hours": Decimal("2.00")}
    )
    found = marts.department_performance(star(spark, *rows)).first()
    assert found["avg_target_sla_hours"] == 1.01


def test_marts_agree_on_totals(city):
    found = marts.all_marts(city, "2025-04-01")
    views = marts.VIEWS
    total = found[views[0]].first()
    for view, tickets, breaches in [
        (views[1], "total_tickets", "sla_breach_count"),
        (views[2], "ticket_volume", "sla_breaches"),
        (views[3], "total_requests", "sla_breaches"),
        (views[4], "request_count", "sla_breached_count"),
    ]:
        rows = found[view].collect()
        assert sum(row[tickets] for row in rows) == total["total_requests"]
        assert sum(row[breaches] for row in rows) == total["total_sla_breaches"]
    aging = found[views[5]].collect()
    assert sum(row["total_backlog_tickets"] for row in aging) == total["current_backlog"]
    for row in aging:
        assert sum(row[name] for name, _, _ in marts.AGE_CLASSES) == row["total_backlog_tickets"]


def test_marts_of_nothing(spark):
    nothing = star(spark, {})
    nothing = type(nothing)(nothing.fact.limit(0), *list(nothing.tables().values())[:5])
    overview = marts.operational_overview(nothing).collect()
    assert len(overview) == 1 and overview[0]["total_requests"] == 0
    assert overview[0]["avg_resolution_hours"] is None and overview[0]["sla_compliance_pct"] is None
    for name, mart in marts.all_marts(nothing, "2025-01-01").items():
        assert name == marts.VIEWS[0] or mart.count() == 0


def test_unmatched_tickets_leave_the_marts(spark):
    rows = numbered({}, {"status": None}, {"department_name": None})
    outer = star(spark, *rows, how="left")
    assert outer.fact.count() == 3
    assert marts.operational_overview(outer).first()["total_requests"] == 2
    assert [row["total_tickets"] for row in marts.department_performance(outer).collect()] == [1]


def test_filters_apply_to_every_mart(city):
    parks = drilldown.filter_star(city, department="Parks")
    assert marts.operational_overview(parks).first()["total_requests"] == 2
    assert [r["neighborhood"] for r in marts.geographic_distribution(parks).collect()] == ["Hills"]
    north = drilldown.filter_star(city, district="DIST-01", priority="Low", category="Sanitation")
    assert marts.operational_overview(north).first()["total_requests"] == 2
    assert drilldown.filter_star(city).fact is city.fact
    nobody = drilldown.filter_star(city, department="Nobody", priority="Low")
    assert marts.operational_overview(nobody).first()["total_requests"] == 0


def test_mart_filters_and_caption(city):
    departments = marts.department_performance(city)
    shown = drilldown.filter_departments(departments, "Harbour Office")
    assert tuple(drilldown.filter_caption(shown).first()) == (6, "Showing 6 Filtered Incidents")
    nobody = drilldown.filter_departments(departments, "Nobody")
    assert drilldown.filter_caption(nobody).first()["caption"] == "Showing 0 Filtered Incidents"
    categories = marts.category_breakdown(city)
    assert drilldown.filter_categories(categories, "Moorings", "High").count() == 1
    shares = drilldown.category_share(categories).collect()
    assert {tuple(row) for row in shares} == {("Moorings", 6), ("Sanitation", 2)}


def test_filter_options_keep_the_marts_order(city):
    options = drilldown.filter_options(
        marts.department_performance(city),
        marts.category_breakdown(city),
        marts.geographic_distribution(city),
    )
    rows = options.orderBy("filter_name", "position").collect()
    assert [(row["filter_name"], row["value"], row["label"]) for row in rows] == [
        ("category", "Moorings", "Moorings"),
        ("category", "Sanitation", "Sanitation"),
        ("department", "Harbour Office", "Harbour Office"),
        ("department", "Parks", "Parks"),
        ("district", "DIST-01", "DIST-01 (Old Quay)"),
        ("district", "DIST-03", "DIST-03 (Hills)"),
    ]


def test_headlines(city):
    rows = drilldown.headlines(marts.operational_overview(city)).collect()
    figures = {row["label"]: row["figure"] for row in rows}
    assert figures["Avg Resolution Time"] == "25.8 hours"
    assert figures["SLA Compliance Rate"] == "66.67%"
    assert figures["Total Requests Processed"] == "8"
    assert len(rows) == 8


def test_views_by_name(spark, city):
    marts.register_views(city, "2025-04-01")
    assert spark.sql("SELECT total_requests FROM vw_kpi_operational_overview").first()[0] == 8
    assert spark.sql("SELECT count(*) FROM fact_service_requests").first()[0] == 8
