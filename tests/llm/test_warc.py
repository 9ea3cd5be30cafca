import gzip
import hashlib

from corpus import frame, prose

from casemart.llm import warc

ROWS = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (9, "http://a/9", "x" * 1000), (9, "http://a/9b", "x" * 1000),
    (3, None, "y" * 999), (4, "http://a/4\r\nWARC-Type: revisit", "y" * 999), (5, "http://a/5", None), (6, "", ""),
    (None, "http://a/n", "z" * 1200), (None, "http://a/m", "z" * 1200), (7, "http://a/7", "z" * 1200), (8, "http://é/8", "é\r\n\r\nWARC/1.1\r\n" * 300),
    (10, "u", "w" * 2000), (None, "u", "w" * 2000),
]
DDL = "page_id long, url string, html string"


def expected(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        digest = hashlib.sha1(raw).hexdigest()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        revisit = len(raw) >= 1000 and page is not None and page < max(same)
        out.append((page, len(raw), digest, "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(map(str, out))


def test_pages_come_back(spark):
    pages = frame(spark, ROWS, DDL)
    assert sorted(str(tuple(r)) for r in warc.archived_pages(pages).collect()) == expected(ROWS)
    extra = pages.selectExpr("*", "1 AS payload", "'a' AS record_type", "2 AS _digest", "3 AS record_id").repartition(5)
    assert sorted(str(tuple(r)) for r in warc.archived_pages(extra).collect()) == expected(ROWS)
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_many_pages_share_a_payload(spark):
    rows = [(k, f"http://h/{k}", "same" * 300 if k % 3 else prose(k, 200)) for k in range(300)]
    assert sorted(str(tuple(r)) for r in warc.archived_pages(frame(spark, rows, DDL)).collect()) == expected(rows)


def test_predicates_reach_the_reader(spark, tmp_path):
    for compression in ["none", "gzip"]:
        path = str(tmp_path / compression)
        warc.write_pages(frame(spark, ROWS, DDL), path, compression)
        every = warc.read_records(spark, path)
        assert every.count() == len(ROWS)
        revisits = every.filter("record_type = 'revisit' AND refers_to = 'urn:page:9'")
        assert sorted(r["record_id"] for r in revisits.collect()) == ["urn:page:1", "urn:page:2"]
        plan = revisits._jdf.queryExecution().executedPlan().toString()
        assert "Filter (" not in plan
        assert every.filter("target_uri LIKE 'http://a/9%'").count() == 2
        assert every.filter("record_id IN ('urn:page:4', 'urn:page:5')").count() == 2
        assert every.filter("payload_bytes > 1100").count() == 6  # left to Spark
        heads = warc.read_records(spark, path, "record_id string, payload_bytes long")
        assert {r["payload_bytes"] for r in heads.filter("record_id = 'urn:page:1'").collect()} == {1000}


def test_excluded_payloads_are_not_read(tmp_path):
    import io

    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": "u", "refers_to": None, "payload_digest": "00", "payload_bytes": 500_000, "payload": b"p" * 500_000}
    data = b"".join(warc.record_bytes({**row, "record_id": f"urn:page:{k}"}) for k in range(4))

    class Counted(io.BytesIO):
        taken = 0

        def read(self, size=-1):
            out = super().read(size)
            self.taken += len(out)
            return out

    reader = warc.WarcReader("", ["record_id", "payload"], 1)
    reader.wanted = [("record_id", "in", {"urn:page:2"})]
    file = Counted(data)
    ((name, payload),) = reader._records(file)
    assert name == "urn:page:2" and len(payload) == 500_000 and file.taken == 500_000


def test_unlisted_files_are_not_read(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(frame(spark, ROWS[:2], DDL), path)
    (tmp_path / "w" / "left-by-a-failed-task.warc").write_bytes(b"WARC/1.1\r\nbroken")
    assert warc.read_records(spark, path).count() == 2


def test_foreign_archives(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nFolded: a\r\n b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record * 2)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    found = warc.read_records(spark, str(tmp_path)).collect()
    assert len(found) == 4 and {bytes(r["payload"]) for r in found} == {b"hello"}
    assert found[0]["headers"]["Folded"] == "a b" and found[0]["record_type"] == "resource"
    assert warc.read_records(spark, str(tmp_path / "a.warc")).count() == 2


def test_partitions_are_planned_by_bytes(tmp_path):
    for k, size in enumerate([90, 10, 50, 50, 40]):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * size)
    reader = warc.WarcReader(str(tmp_path), [], 100)
    assert sorted(len(p.paths) for p in reader.partitions()) == [1, 2, 2]


def test_a_second_append_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "two")
    for rows in (ROWS[:2], ROWS[4:7]):
        warc.write_pages(frame(spark, rows, DDL), path)
    assert warc.read_records(spark, path).count() == 5
    warc.page_records(frame(spark, ROWS[:2], DDL)).write.format("warc").mode("overwrite").save(path)
    assert warc.read_records(spark, path).count() == 2


def test_the_query_reads_revisits_without_payloads(spark):
    plan = warc.archived_pages(frame(spark, ROWS, DDL))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "BatchScan" in line]
    assert len(scans) == 2 and sum("payload#" in line for line in scans) == 1 and "Filter (" not in plan
