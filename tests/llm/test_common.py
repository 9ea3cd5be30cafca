import time

from corpus import EDGES, clashing, frame, prose

from casemart.llm import common as C


def test_without_rows_is_an_anti_join(spark, monkeypatch):
    """With filters that fit, and with one that is so small that most documents pass it."""
    rows = [(k, prose(k, 8)) for k in range(300)] + EDGES
    docs = clashing(spark, rows)
    keyed = C.F.xxhash64("doc_id", "text").alias("row")
    named = docs.filter("doc_id % 7 = 3 OR doc_id IS NULL").select("doc_id", keyed)
    expected = sorted(str((d, t)) for d, t in rows if d is not None and d % 7 != 3)
    for most in [C.MOST_BITS, 32]:
        monkeypatch.setattr(C, "MOST_BITS", most)
        kept = C.without_rows(docs, named)
        assert kept.columns == docs.columns
        assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == expected
    assert C.without_rows(docs, named.limit(0)).count() == len(rows)
    assert C.without_rows(docs.limit(0), named).count() == 0
    # Another text under the same id stays.
    other = frame(spark, [(3, "another text")])
    assert C.without_rows(other, named).count() == 1


def test_stored_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before = files()
    kept = C.stored(spark.range(5000).repartition(4, "id").groupBy((C.F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(C.CLEANUP, None) != "true"
    assert sum(r["count"] for r in kept.collect()) == 5000
