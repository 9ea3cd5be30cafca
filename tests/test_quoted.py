"""CSV records that hold line breaks, in files that are cut anywhere."""

import csv
import io
from random import Random

import pytest

from casemart.schema import RAW_COLUMNS
from casemart.sources.quoted import csv_records, read_quoted_tickets
from casemart.sources.tickets import read_tickets
from tickets import DEFAULTS


def text_of(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def corpus():
    pick = Random(3)
    words = ["plain", 'says "no"', "two\nlines", '"\n"', "", "a,b", "\n\nthree\n", "é"]
    return [[str(k), *(pick.choice(words) for _ in range(3))] for k in range(60)]


@pytest.fixture()
def cuts(spark):
    """Sets the bytes of a split; the size is the session's again afterwards."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {name: spark.conf.get(name, None) for name in names}

    def cut(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield cut
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("size", [7, 11, 64, 500, 100_000])
def test_records_equal_those_of_a_csv_reader(spark, tmp_path, cuts, size):
    rows = corpus()
    for name, part in [("a.csv", rows[:40]), ("b.csv", rows[40:]), ("empty.csv", [])]:
        (tmp_path / name).write_text(text_of(part), encoding="utf-8")
    cuts(size)
    found = csv_records(spark, str(tmp_path))
    records = [row["record"] for row in found.collect()]
    assert sorted(next(csv.reader(io.StringIO(r, newline=""))) for r in records) == sorted(rows)
    if size == 64:
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 8


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_tickets_equal_those_of_multi_line(spark, tmp_path, cuts, ending):
    pandas = pytest.importorskip("pandas")
    channels = ["plain", "W\nX", 'says "no"\n', None, "a,b\n\nc"]
    rows = [{**DEFAULTS, "ticket_number": f"SR-{n}", "channel": channels[n % 5], "satisfaction_rating": 5 if n % 3 else None} for n in range(40)]
    frame = pandas.DataFrame([dict(zip(RAW_COLUMNS, row.values(), strict=True)) for row in rows])
    frame.to_csv(tmp_path / "tickets.csv", index=False, lineterminator=ending)
    expected = read_tickets(spark, str(tmp_path), "csv", multiLine=True)
    whole = sorted(map(str, expected.select(*RAW_COLUMNS).collect()))
    cuts(600)
    found = read_quoted_tickets(spark, str(tmp_path))
    assert found.dtypes == expected.dtypes
    assert sorted(map(str, found.select(*RAW_COLUMNS).collect())) == whole
    order = [row["ticket_number"] for row in found.orderBy("arrival_file", "arrival_block", "arrival_row").collect()]
    assert order == [f"SR-{n}" for n in range(40)]


def test_other_headers_stop_the_read(spark, tmp_path):
    (tmp_path / "tickets.csv").write_text("one,two\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="malformed header"):
        read_quoted_tickets(spark, str(tmp_path)).collect()
