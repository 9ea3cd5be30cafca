"""The marts against plain Python on random tickets, hot keys included."""

from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from random import Random

import pytest

from casemart import run_pipeline
from casemart.operators import drilldown, marts
from tickets import ARRIVAL, DEFAULTS, raw

AS_OF = date(2025, 4, 1)
CENT = Decimal("0.01")


def random_tickets(seed, size=900):
    pick = Random(seed)
    rows = []
    for _ in range(size):
        hot = pick.random() < 0.34
        closed = pick.random() < 0.7
        created = datetime(2024, 11, 1) + timedelta(seconds=pick.randrange(150 * 86400))
        spent = timedelta(seconds=pick.randrange(-20_000, 400_000))
        district = None if hot else pick.choice(["DIST-01", "DIST-02", "DIST-03", "dist-01", ""])
        rows.append(
            {
                **DEFAULTS,
                "ticket_number": pick.choice(["SR-HOT", None]) if hot else f"SR-{pick.randrange(500)}",
                "created_date": created,
                "closed_date": created + spent if closed and pick.random() < 0.95 else None,
                "target_sla_hours": Decimal(pick.choice([600, 1200, 2401])) / 100,
                "department_name": pick.choice(["Works", " Works ", "Parks", "\tWater\n"]),
                "division_name": pick.choice(["East", "West"]),
                "request_category": pick.choice(["Roads", "Trees"]),
                "request_type": pick.choice(["Pothole", "Branch", "Other"]),
                "priority_level": pick.choice(["High", "Low"]),
                "status": pick.choice(["Closed - Resolved", "Closed"]) if closed
                else pick.choice(["Assigned", "closed?"]),
                "district_code": district,
                "neighborhood": None if district is None else f"Area {district}",
                "satisfaction_rating": pick.choice([None, 1, 2, 3, 4, 5]),
                "is_repeat": pick.choice([None, True, False, False]),
            }
        )
    return rows


def cleaned(rows):
    seen, kept = set(), []
    for row in rows:
        if row["ticket_number"] not in seen:
            seen.add(row["ticket_number"])
            row = dict(row)
            for name in ["department_name", "status"]:
                row[name] = row[name].strip()
            for name, value in [
                ("district_code", "DIST-UNKNOWN"), ("neighborhood", "Unknown Neighborhood"),
            ]:
                row[name] = value if row[name] is None else row[name]
            row["closed"] = row["status"].startswith("Closed")
            row["hours"] = None
            row["breached"] = False
            if row["closed_date"] is not None:
                spent = row["closed_date"] - row["created_date"]
                exact = Decimal(spent // timedelta(seconds=1)) / 3600
                row["hours"] = exact.quantize(CENT, ROUND_HALF_UP)
                row["breached"] = exact > row["target_sla_hours"]
            kept.append(row)
    return kept


def rounded(part, whole):
    return float((Decimal(part) / whole).quantize(CENT, ROUND_HALF_UP)) if whole else None


def mean(values):
    known = [value for value in values if value is not None]
    return rounded(sum(known), len(known)) if known else None


def groups(rows, *names):
    found = defaultdict(list)
    for row in rows:
        found[tuple(row[name] for name in names)].append(row)
    return found


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark, tmp_path_factory):
    rows = random_tickets(request.param)
    root = str(tmp_path_factory.mktemp("random"))
    tickets = raw(spark, *rows).repartition(6)
    run = run_pipeline(spark, tickets, root, AS_OF, export=False, arrival=ARRIVAL)
    return cleaned(rows), run


def closed_share(rows):
    closed = [row for row in rows if row["closed"]]
    return rounded(100 * sum(not row["breached"] for row in closed), len(closed))


def test_overview(case):
    rows, run = case
    found = run.marts[marts.VIEWS[0]].first()
    repeats = sum(row["is_repeat"] is True for row in rows)
    assert tuple(found) == (
        len(rows),
        sum(row["closed"] for row in rows),
        sum(not row["closed"] for row in rows),
        mean([row["hours"] for row in rows]),
        mean([row["satisfaction_rating"] for row in rows]),
        sum(row["breached"] for row in rows),
        closed_share(rows),
        repeats,
        rounded(100 * repeats, len(rows)),
    )


def test_departments(case):
    rows, run = case
    expected = groups(rows, "department_name", "division_name")
    volumes = sorted({len(group) for group in expected.values()}, reverse=True)
    found = run.marts[marts.VIEWS[1]].collect()
    assert len(found) == len(expected)
    for row in found:
        group = expected[row["department_name"], row["division_name"]]
        assert row["total_tickets"] == len(group)
        assert row["closed_tickets"] == sum(r["closed"] for r in group)
        assert row["avg_resolution_hours"] == mean([r["hours"] for r in group])
        assert row["avg_target_sla_hours"] == mean([r["target_sla_hours"] for r in group])
        assert row["avg_satisfaction"] == mean([r["satisfaction_rating"] for r in group])
        assert row["sla_compliance_pct"] == closed_share(group)
        assert row["workload_rank"] == volumes.index(len(group)) + 1


def test_trends(case):
    rows, run = case
    for row in rows:
        row["month"] = row["created_date"].strftime("%Y-%m")
    expected = groups(rows, "month")
    found = run.marts[marts.VIEWS[2]].orderBy("year", "month").collect()
    assert [row["year_month"] for row in found] == sorted(month for (month,) in expected)
    before = None
    for row in found:
        group = expected[row["year_month"],]
        assert row["ticket_volume"] == len(group) and row["prev_month_volume"] == before
        growth = None if before is None else rounded(100 * (len(group) - before), before)
        assert row["mom_volume_growth_pct"] == growth
        assert row["sla_breaches"] == sum(r["breached"] for r in group)
        before = len(group)


def test_geography_and_categories(case):
    rows, run = case
    places = groups(rows, "district_code", "neighborhood")
    for row in run.marts[marts.VIEWS[3]].collect():
        group = places.pop((row["district_code"], row["neighborhood"]))
        assert (row["total_requests"], row["avg_resolution_hours"]) == (
            len(group), mean([r["hours"] for r in group]),
        )
        north = row["district_code"] in ("DIST-01", "DIST-02")
        assert row["region_zone"] == ("North Region" if north else "South Region")
    assert not places
    kinds = groups(rows, "request_category", "request_type", "priority_level")
    for row in run.marts[marts.VIEWS[4]].collect():
        group = kinds.pop((row["request_category"], row["request_type_name"], row["priority_level"]))
        breaches = sum(r["breached"] for r in group)
        assert (row["request_count"], row["breach_rate_pct"]) == (
            len(group), rounded(100 * breaches, len(group)),
        )
    assert not kinds


def test_backlog(case):
    rows, run = case
    expected = groups([row for row in rows if not row["closed"]], "department_name", "request_category")
    found = run.marts[marts.VIEWS[5]].collect()
    assert len(found) == len(expected)
    for row in found:
        group = expected[row["department_name"], row["request_category"]]
        ages = [(AS_OF - r["created_date"].date()).days for r in group]
        assert row["total_backlog_tickets"] == len(ages) and row["max_open_days"] == max(ages)
        assert row["aging_0_to_3_days"] == sum(age <= 3 for age in ages)
        assert row["aging_4_to_7_days"] == sum(4 <= age <= 7 for age in ages)
        assert row["aging_8_to_14_days"] == sum(8 <= age <= 14 for age in ages)
        assert row["aging_over_14_days"] == sum(age > 14 for age in ages)


def test_drilldown(case):
    rows, run = case
    chosen = drilldown.filter_star(
        run.warehouse.star(), department="Works", category="Roads", priority="High", district="DIST-UNKNOWN"
    )
    expected = [
        row for row in rows
        if row["department_name"] == "Works" and row["request_category"] == "Roads"
        and row["priority_level"] == "High" and row["district_code"] == "DIST-UNKNOWN"
    ]
    assert marts.operational_overview(chosen).first()["total_requests"] == len(expected)


def test_hot_ticket_is_one_ticket(case):
    rows, run = case
    staged = run.warehouse.staging()
    assert run.staged_rows == len(rows)
    assert staged.filter("ticket_number = 'SR-HOT'").count() == 1
    assert staged.filter("ticket_number IS NULL").count() == 1
