from datetime import datetime

from casemart.operators import audit, cleaning
from casemart.schema import RAW_COLUMNS
from tickets import ARRIVAL, DEFAULTS, numbered, raw

MISSING_PLACE = {"district_code": None, "neighborhood": None, "zip_code": None}


def statuses(log):
    return {row["check_name"]: row["status"] for row in log.collect()}


def details(log):
    return {row["check_name"]: row["details"] for row in log.collect()}


def test_cleaning_fills_and_strips(spark):
    row = {"department_name": " Harbour Office  ", **MISSING_PLACE}
    cleaned = cleaning.clean(raw(spark, row), ARRIVAL).first()
    assert cleaned["district_code"] == "DIST-UNKNOWN"
    assert cleaned["neighborhood"] == "Unknown Neighborhood"
    assert cleaned["zip_code"] == "00000"
    assert cleaned["department_name"] == "Harbour Office"


def test_cleaning_keeps_columns(spark):
    assert cleaning.clean(raw(spark, {}), ARRIVAL).columns == [*RAW_COLUMNS, "arrival"]


def test_strip_handles_all_space_and_null(spark):
    rows = numbered(
        {"department_name": "\t Roads \n"},
        {"department_name": " Roads "},
        {"department_name": None},
    )
    found = cleaning.strip_text(raw(spark, *rows)).orderBy("arrival").collect()
    assert [row["department_name"] for row in found] == ["Roads", "Roads", None]


def test_strip_skips_absent_columns(spark):
    frame = raw(spark, {"status": " Open "}).drop("department_name")
    assert cleaning.strip_text(frame).first()["status"] == "Open"


def test_empty_text_is_not_missing(spark):
    assert cleaning.fill_places(raw(spark, {"district_code": ""})).first()["district_code"] == ""


def test_first_row_of_a_ticket_stays(spark):
    rows = [
        {"ticket_number": None, "channel": "first null"},
        {"ticket_number": "SR-1", "channel": "first"},
        {"ticket_number": "SR-1", "channel": "second"},
        {"ticket_number": None, "channel": "second null"},
        {"ticket_number": "SR-1", "channel": "third"},
    ]
    shuffled = raw(spark, *rows).repartition(5, "channel")
    kept = cleaning.keep_first(shuffled, ARRIVAL).collect()
    assert {row["channel"] for row in kept} == {"first", "first null"}


def test_uniqueness_counts_null_as_a_ticket(spark):
    numbers = [None, None, "SR-1", "SR-1", "SR-1"]
    frame = raw(spark, *[{"ticket_number": number} for number in numbers])
    log = details(audit.check_uniqueness(frame))
    assert log == {"Uniqueness Check (ticket_number)": "Found 3 duplicate ticket numbers"}


def test_time_order_counts_only_early_closes(spark):
    moment = DEFAULTS["created_date"]
    rows = numbered(
        {"closed_date": moment},
        {"closed_date": datetime(2024, 5, 5)},
        {"created_date": None},
        {"closed_date": None},
    )
    log = details(audit.check_time_order(raw(spark, *rows)))
    expected = "Found 1 tickets with closed_date before created_date"
    assert log == {"Timestamp Logic Check (closed >= created)": expected}


def test_null_check_per_column(spark):
    rows = numbered({}, {"department_name": None})
    log = audit.check_nulls(raw(spark, *rows))
    assert statuses(log)["Null Check: department_name"] == "FAILED"
    assert statuses(log)["Null Check: created_date"] == "PASSED"
    assert details(log)["Null Check: department_name"] == "Found 1 nulls out of 2 rows"


def test_null_check_skips_absent_columns(spark):
    log = statuses(audit.check_nulls(raw(spark, {}).drop("department_name")))
    assert "Null Check: department_name" not in log and len(log) == 3


def test_null_check_takes_nan_as_missing(spark):
    frame = spark.sql("SELECT double('NaN') AS a UNION ALL SELECT 1.0D UNION ALL SELECT NULL")
    assert details(audit.check_nulls(frame, ["a"])) == {"Null Check: a": "Found 2 nulls out of 3 rows"}


def test_full_audit(spark):
    good = audit.audit(raw(spark, *numbered({}, {})))
    bad = audit.audit(raw(spark, {}, {}))
    assert [row["check_name"] for row in good.collect()] == [
        "Null Check: ticket_number",
        "Null Check: created_date",
        "Null Check: department_name",
        "Null Check: request_category",
        "Timestamp Logic Check (closed >= created)",
        "Uniqueness Check (ticket_number)",
    ]
    assert audit.passed(good).first()["passed"] is True
    assert audit.passed(bad).first()["passed"] is False


def test_audit_of_nothing_passes(spark):
    log = audit.audit(raw(spark, {}).limit(0))
    assert log.count() == 6 and audit.passed(log).first()["passed"] is True
