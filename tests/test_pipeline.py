import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from casemart import open_views, open_warehouse, run_pipeline, session
from casemart.operators import marts
from casemart.operators.cleaning import clean
from casemart.plans import pipeline
from casemart.plans import warehouse as plans
from casemart.schema import RAW, RAW_COLUMNS, TABLES
from casemart.session import work_folder
from casemart.sinks import exports
from casemart.sources.tickets import ARRIVAL as FILE_ARRIVAL
from casemart.sources.tickets import read_tickets
from tickets import ARRIVAL, DEFAULTS, numbered, raw

ROWS = numbered(
    {"department_name": " Harbour Office  "},
    {"closed_date": None, "status": "Assigned", "satisfaction_rating": None},
    {"district_code": None, "neighborhood": None, "zip_code": None, "channel": 'a "b", c'},
    {"division_name": "Tugs", "request_type": ""},
)


def sections(run):
    return {name: sorted(map(str, frame.collect())) for name, frame in run.marts.items()}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))
    tickets = raw(spark, *ROWS, {"ticket_number": "SR-1", "channel": "repeated"})
    return run_pipeline(spark, tickets, root, "2025-02-01", arrival=ARRIVAL)


def test_run_reports(run):
    assert run.staged_rows == 4
    assert run.audit_log.filter("status = 'FAILED'").count() == 0 and run.audit_log.count() == 5
    # The raw tickets repeat a number; cleaning settles that.
    (failed,) = run.raw_audit.filter("status = 'FAILED'").collect()
    assert failed["check_name"] == "Uniqueness Check (ticket_number)"
    assert failed["details"] == "Found 1 duplicate ticket numbers"
    assert run.integrity.filter("violations > 0").count() == 0
    # Unique keys, mandatory columns, foreign keys, lost tickets, text limits, number ranges.
    assert run.integrity.count() == 12 + 40 + 6 + 5 + 26 + 9
    assert run.headlines.filter("label = 'Total Requests Processed'").first()["figure"] == "4"


def test_stored_tables_have_the_declared_types(spark, run):
    for name, ddl in TABLES.items():
        stored = spark.read.parquet(run.warehouse.path(name))
        declared = spark.createDataFrame([], ddl)
        assert dict(stored.dtypes) == dict(declared.dtypes), name


def test_fact_is_stored_by_month(run):
    fact = run.warehouse.star().fact
    folders = fact.select("created_month", "is_open").distinct().collect()
    assert sorted(map(tuple, folders)) == [(202405, 0), (202405, 1)]
    assert fact.select("fact_id").distinct().count() == 4


def test_second_run_replaces_the_first(spark, run):
    tickets = raw(spark, *ROWS, {"ticket_number": "SR-1", "channel": "repeated"})
    again = run_pipeline(spark, tickets, run.warehouse.root, "2025-02-01", arrival=ARRIVAL)
    assert sections(again) == sections(run)
    assert open_warehouse(spark, run.warehouse.root).version == again.warehouse.version
    assert again.warehouse.version > run.warehouse.version


def test_failed_build_publishes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tickets = raw(spark, *ROWS)
    first = plans.build_warehouse(spark, tickets, ARRIVAL, root)

    def fail(*_, **__):
        raise RuntimeError("executor lost for good")

    monkeypatch.setattr(plans, "write_fact", fail)
    with pytest.raises(RuntimeError):
        plans.build_warehouse(spark, tickets, ARRIVAL, root)
    assert open_warehouse(spark, root).version == first.version


def test_repeated_dimension_key_stops_the_build(spark, tmp_path, monkeypatch):
    doubled = plans.dimensions.dim_status
    monkeypatch.setattr(
        plans.dimensions, "dim_status", lambda staging: doubled(staging).union(doubled(staging))
    )
    with pytest.raises(ValueError, match="dim_status"):
        plans.build_warehouse(spark, raw(spark, *ROWS), ARRIVAL, str(tmp_path))


def test_unpublished_root(spark, tmp_path):
    (tmp_path / "published").mkdir()
    with pytest.raises(ValueError, match="no version"):
        open_warehouse(spark, str(tmp_path))


def document(folder):
    """The payload as JSON: its files in the order of their names."""
    parts = sorted(path for path in Path(folder).glob("part-*"))
    return "".join(path.read_text() for path in parts)


def test_export_files(spark, run):
    lines = spark.read.text(run.warehouse.path("export/vw_kpi_monthly_trends")).collect()
    (record,) = [json.loads(line[0]) for line in lines]
    assert record["prev_month_volume"] is None and record["year_month"] == "2024-05"
    text = document(run.warehouse.path("export/kpi_payload"))
    found = json.loads(text)
    assert list(found) == exports.SECTIONS
    assert found["overview"]["total_requests"] == 4
    assert found["monthly_trends"][0]["mom_volume_growth_pct"] is None
    counts = [row["request_count"] for row in found["categories"]]
    assert counts == sorted(counts, reverse=True)
    assert [row["division_name"] for row in found["departments"]] == ["Piers", "Tugs"]
    assert len(text.splitlines()) == 11 + sum(len(found[s]) for s in exports.SECTIONS[1:])


def test_payload_comes_back_equal(spark, run, tmp_path):
    for indent in [True, False]:
        path = str(tmp_path / f"payload{indent}")
        exports.write_payload(run.marts, path, indent)
        records = exports.read_payload(spark, path)
        for section, view in zip(exports.SECTIONS, marts.VIEWS, strict=True):
            schema = exports.plain(run.marts[view]).schema
            found = exports.payload_section(records, section, schema)
            assert found.columns == ["position", *run.marts[view].columns]
            assert sorted(map(str, found.drop("position").collect())) == sorted(
                map(str, exports.plain(run.marts[view]).collect())
            )
            places = sorted(row["position"] for row in found.collect())
            assert places == list(range(1, len(places) + 1))


def test_large_marts_are_exported_in_order(spark, run, tmp_path):
    category = marts.VIEWS[4]
    few = run.marts[category]
    many = few.limit(1).crossJoin(spark.range(0, 250_000, 1, 7).withColumnRenamed("id", "n"))
    many = many.withColumns({"request_count": F.col("n") * 7919 % 1000, "request_type_name": F.col("n").cast("string")})
    path = str(tmp_path / "large")
    exports.write_payload({**run.marts, category: many.select(*few.columns)}, path)
    found = json.loads(document(path))["categories"]
    assert len(found) == 250_000
    keys = [(-row["request_count"], row["request_category"], row["request_type_name"]) for row in found]
    assert keys == sorted(keys)


def test_empty_marts_are_exported(run, tmp_path):
    path = str(tmp_path / "empty")
    exports.write_payload({view: frame.limit(0) for view, frame in run.marts.items()}, path)
    found = json.loads(document(path))
    assert found == {"overview": {}, **{section: [] for section in exports.SECTIONS[1:]}}


def test_failed_export_leaves_the_run_published(spark, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("disk full")

    monkeypatch.setattr(pipeline, "write_payload", fail)
    with pytest.raises(RuntimeError, match="disk full"):
        run_pipeline(spark, raw(spark, *ROWS), str(tmp_path), "2025-02-01", arrival=ARRIVAL)
    assert open_warehouse(spark, str(tmp_path)).star().fact.count() == 4


def test_export_keeps_all_months_unless_told(spark, tmp_path):
    rows = numbered(*[{"created_date": datetime(2023 + n // 12, n % 12 + 1, 3), "closed_date": None} for n in range(14)])
    for months, shown in [(None, 14), (12, 12)]:
        root = str(tmp_path / str(months))
        run = run_pipeline(spark, raw(spark, *rows), root, "2025-02-01", arrival=ARRIVAL, months=months)
        assert len(json.loads(document(run.warehouse.path("export/kpi_payload")))["monthly_trends"]) == shown


def test_version_published_last_is_current(spark, tmp_path):
    root = str(tmp_path)
    first, second = plans.new_version(spark, root), plans.new_version(spark, root)
    plans.publish(second)
    plans.publish(first)
    assert open_warehouse(spark, root).version == first.version


def test_views_of_a_published_warehouse(spark, run):
    spark.catalog.dropTempView("vw_kpi_operational_overview")
    open_views(spark, run.warehouse.root, "2025-02-01")
    assert spark.table("vw_kpi_operational_overview").first()["total_requests"] == 4


def test_views_outlive_the_session_and_follow_what_is_published(spark, run, tmp_path):
    """A new session reads the marts after one call; the text is the version's own."""
    root = str(tmp_path / "house")
    tickets = raw(spark, *ROWS)
    plans.build_warehouse(spark, tickets, ARRIVAL, root)
    for rows in [ROWS, [*ROWS, *numbered({}, {})[:1], {"ticket_number": "SR-9", "closed_date": None, "status": "Assigned"}]]:
        plans.build_warehouse(spark, raw(spark, *rows), ARRIVAL, root)
        other = spark.newSession()
        assert not [t for t in other.catalog.listTables() if t.name.startswith("vw_kpi")]
        star = open_views(other, root, "2025-02-01").star()
        for name, mart in marts.all_marts(star, "2025-02-01").items():
            view = other.sql(f"SELECT * FROM {name}")
            assert dict(view.dtypes) == dict(mart.dtypes), name
            assert sorted(map(str, view.select(*mart.columns).collect())) == sorted(map(str, mart.collect())), name
    house = plans.open_warehouse(spark, root)
    texts = spark.read.json(house.path("views"))
    changed = texts.withColumn("text", F.when(F.col("name") == marts.VIEWS[0], F.lit("select 7 as total_requests")).otherwise(F.col("text"))).collect()
    spark.createDataFrame(changed, "name STRING, text STRING").write.mode("overwrite").json(house.path("views"))
    open_views(other, root)
    assert other.table(marts.VIEWS[0]).first()["total_requests"] == 7


def test_plain_types(spark):
    frame = spark.sql("SELECT DATE'2025-01-01' AS d, 1.50BD AS m, TIMESTAMP_NTZ'2025-01-01 02:03:04' AS t")
    assert tuple(exports.plain(frame).first()) == ("2025-01-01", 1.5, "2025-01-01 02:03:04")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_ticket_files_come_back_equal(spark, tmp_path, fmt):
    tickets = raw(spark, *ROWS).select(*RAW_COLUMNS)
    path = str(tmp_path / fmt)
    if fmt == "csv":
        exports.write_tickets(tickets, path)
    else:
        tickets.write.format(fmt).save(path)
    found = read_tickets(spark, path, fmt)
    if fmt == "csv":
        tickets = tickets.withColumn("request_type", F.nullif("request_type", F.lit("")))
    assert found.columns == [*RAW_COLUMNS, *FILE_ARRIVAL]
    assert [field.dataType for field in found.schema][:18] == [field.dataType for field in RAW]
    assert sorted(map(str, found.select(*RAW_COLUMNS).collect())) == sorted(map(str, tickets.collect()))


def test_line_breaks_in_text_come_back(spark, tmp_path):
    texts = ["a\nb", "c\r\nd", "e\\nf", "\\", 'g "h"\n', "\\\\n\\r\r"]
    tickets = raw(spark, *numbered(*[{"channel": text} for text in texts])).select(*RAW_COLUMNS)
    exports.write_tickets(tickets, str(tmp_path / "escaped"))
    found = read_tickets(spark, str(tmp_path / "escaped"), "csv", escaped=True)
    assert sorted(map(str, found.select(*RAW_COLUMNS).collect())) == sorted(map(str, tickets.collect()))


def test_quoted_line_breaks(spark, tmp_path):
    pandas = pytest.importorskip("pandas")
    rows = [{**DEFAULTS, "ticket_number": f"SR-{n}", "channel": f"W\nX{n}"} for n in range(2)]
    frame = pandas.DataFrame([dict(zip(RAW_COLUMNS, row.values(), strict=True)) for row in rows])
    frame.to_csv(tmp_path / "tickets.csv", index=False)
    found = read_tickets(spark, str(tmp_path), "csv", multiLine=True)
    assert sorted(row["channel"] for row in found.select("channel").collect()) == ["W\nX0", "W\nX1"]
    # Without multiLine the read fails, also when only whole cells are asked for.
    for columns in [RAW_COLUMNS, ["ticket_number", "status"]]:
        with pytest.raises(Exception, match="(?i)malformed"):
            read_tickets(spark, str(tmp_path), "csv").select(*columns).collect()


def test_fractional_ratings_are_refused(spark, tmp_path):
    exports.write_tickets(raw(spark, {}), str(tmp_path / "good"))
    header, *lines = [row[0] for row in spark.read.text(str(tmp_path / "good")).collect()]
    (line,) = set(lines) - {header}
    for rating in ["4.0", "4.7"]:
        path = tmp_path / f"{rating}.csv"
        path.write_text(header + "\n" + line.replace(",4,", f",{rating},") + "\n")
    assert read_tickets(spark, str(tmp_path / "4.0.csv"), "csv").first()["satisfaction_rating"] == 4
    with pytest.raises(Exception, match="malformed satisfaction_rating"):
        read_tickets(spark, str(tmp_path / "4.7.csv"), "csv").collect()
    lenient = read_tickets(spark, str(tmp_path / "4.7.csv"), "csv", mode="PERMISSIVE")
    assert lenient.first()["satisfaction_rating"] is None


def test_csv_from_pandas(spark, tmp_path):
    pandas = pytest.importorskip("pandas")
    rows = [dict(zip(RAW_COLUMNS, {**DEFAULTS, **row}.values(), strict=True)) for row in ROWS]
    frame = pandas.DataFrame(rows).drop(columns=["created_date", "closed_date"])
    for name in ["created_date", "closed_date"]:
        frame[name] = [row[name] and row[name].strftime("%Y-%m-%d %H:%M:%S") for row in rows]
    frame[RAW_COLUMNS].to_csv(tmp_path / "tickets.csv", index=False)
    text = (tmp_path / "tickets.csv").read_text()
    assert ",4.0," in text and '"a ""b"", c"' in text and ",False," in text
    found = read_tickets(spark, str(tmp_path), "csv").select(*RAW_COLUMNS)
    expected = raw(spark, *ROWS).select(*RAW_COLUMNS)
    expected = expected.withColumn("request_type", F.nullif("request_type", F.lit("")))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_bad_input_stops_the_read(spark, tmp_path):
    exports.write_tickets(raw(spark, *ROWS), str(tmp_path / "good"))
    page = spark.read.text(str(tmp_path / "good")).collect()
    lines = [row[0] for row in page]
    moved = lines[0].replace("ticket_number,created_date", "created_date,ticket_number")
    wrong = lines[1].replace("2024-05-06 08:30:00", "yesterday")
    for name, text in [("header", [moved, *lines[1:]]), ("value", [lines[0], wrong])]:
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join(text) + "\n")
        with pytest.raises(Exception, match="(?i)header|malformed"):
            read_tickets(spark, str(path), "csv").collect()
    lenient = read_tickets(spark, str(tmp_path / "value.csv"), "csv", mode="PERMISSIVE")
    assert lenient.first()["created_date"] is None


def test_arrival_follows_the_file(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    line = "SR-{n},2025-01-01 10:00:00,,24.0,Works,Roads,Infra,Pothole,High,Assigned,,,,32.6,-85.4,,false,{c}"
    rows = [line.format(n=n % 50, c=f"row {n}") for n in range(500)]
    (tmp_path / "a.csv").write_text("\n".join([header, *rows]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([header, *[r.replace("row", "later") for r in rows]]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        tickets = read_tickets(spark, str(tmp_path), "csv")
        assert tickets.rdd.getNumPartitions() > 5
        kept = clean(tickets, FILE_ARRIVAL).select("ticket_number", "channel").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {row["ticket_number"]: row["channel"] for row in kept} == {
        f"SR-{n}": f"row {n}" for n in range(50)
    }


def test_pipeline_from_files(spark, tmp_path):
    exports.write_tickets(raw(spark, *ROWS), str(tmp_path / "in"))
    run = run_pipeline(
        spark, str(tmp_path / "in"), str(tmp_path / "house"), "2025-02-01", export=False, fmt="csv"
    )
    assert run.staged_rows == 4
    assert not (tmp_path / "house" / "versions" / run.warehouse.version / "export").exists()


def test_pipeline_of_nothing(spark, tmp_path):
    tickets = raw(spark, {}).limit(0)
    run = run_pipeline(spark, tickets, str(tmp_path), "2025-02-01", arrival=ARRIVAL)
    assert run.staged_rows == 0
    assert run.marts[marts.VIEWS[0]].first()["total_requests"] == 0


def test_shuffles_grow_with_the_input(spark, tmp_path):
    path = str(tmp_path / "in")
    exports.write_tickets(raw(spark, *ROWS), path)
    tickets = read_tickets(spark, path, "csv")
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with session.sized_shuffles(tickets) as number:
        assert number == 8
    joined = tickets.join(read_tickets(spark, path, "csv").select("ticket_number"), "ticket_number")
    with session.sized_shuffles(joined, bytes_per_partition=10) as number:
        size = sum(p.stat().st_size for p in Path(path).glob("part-*"))
        assert number == -(-2 * size // 10) and spark.conf.get(setting) == str(number)
        with session.sized_shuffles(tickets):
            assert spark.conf.get(setting) == str(number)
        assert spark.conf.get(setting) == str(number)
    assert spark.conf.get(setting, None) is None
    with session.sized_shuffles(tickets, bytes_per_partition=10, most_partitions=20) as number:
        assert number == 20
    # Rows that the program made have no known size.
    with session.sized_shuffles(raw(spark, *ROWS), bytes_per_partition=1) as number:
        assert number == 8


def test_scans_take_no_more_than_a_partition_into_a_task(spark, tmp_path):
    raw(spark, *ROWS * 50).repartition(6).write.parquet(str(tmp_path / "in"))
    tickets = spark.read.parquet(str(tmp_path / "in"))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    with session.sized_shuffles(tickets):
        assert int(spark.conf.get(setting)) == session.BYTES_PER_PARTITION < 1 << 25
    with session.sized_shuffles(tickets, bytes_per_partition=2000):
        assert clean(tickets, ARRIVAL).drop(*ARRIVAL).distinct().count() == clean(raw(spark, *ROWS), ARRIVAL).count()
        assert tickets.filter("true").rdd.getNumPartitions() >= 6
        # Never raised.
        with session.sized_shuffles(tickets, bytes_per_partition=1 << 30):
            assert spark.conf.get(setting) == "2000"
    with session.sized_shuffles(tickets, bytes_per_partition=1, most_partitions=2):
        assert int(spark.conf.get(setting)) > 2000
    assert spark.conf.get(setting) == before


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_command_line(spark, tmp_path, capsys):
    from casemart.__main__ import main

    late = {"ticket_number": "SR-9", "closed_date": None, "status": "Assigned", "division_name": None}
    exports.write_tickets(raw(spark, *ROWS[:3], late), str(tmp_path / "in"))
    house = str(tmp_path / "house")
    main([str(tmp_path / "in"), house, "--format", "csv", "--as-of", "2025-02-01", "--keep-unmatched"])
    lines = capsys.readouterr().out.splitlines()
    assert lines[0] == "4 tickets staged"
    assert "[PASSED] staged, Null Check: ticket_number: Found 0 nulls out of 4 rows" in lines
    assert "[PASSED] raw, Null Check: ticket_number: Found 0 nulls out of 4 rows" in lines
    # The ticket without a division is kept, so it is not lost.
    assert "[FAILED] no department_key: 1 violations" in lines
    assert not any("lost tickets" in line for line in lines)
    assert "Total Requests Processed: 4" in lines
    assert open_warehouse(spark, house).star().fact.count() == 4


def shuffle_blocks(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().iterator()
    found = set()
    while blocks.hasNext():
        name = blocks.next().name()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_blocks(spark)
    run_pipeline(spark, raw(spark, *ROWS), str(tmp_path / "house"), "2025-02-01", arrival=ARRIVAL)
    assert not shuffle_blocks(spark) - before
