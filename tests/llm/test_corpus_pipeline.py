import sys
from pathlib import Path

import pytest
from corpus import EDGES, clashing, frame, prose

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from casemart.llm import catalogue, oracle  # noqa: E402


def test_stage_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "best_fit_packing"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of tables with planted cases."""
    folder = tmp_path_factory.mktemp("tables")
    item = prose(900, 40, 5000)
    rows = [(k, prose(k, 80, 5000)) for k in range(30)]
    rows += [(100, prose(0, 80, 5000)), (101, prose(1, 80, 5000).replace(" ", "  ")), (102, prose(40, 80, 5000) + " " + item)]
    rows += [(103, prose(41, 80, 5000) + " token = abcdefghijklmnop"), (104, prose(42, 80, 5000).replace(" ", " ### ")), (105, "short")]
    rows += [(200 + k, prose(300 + k, 80, 5000).replace(" ", " ### ")) for k in range(30)] + EDGES
    clashing(spark, rows).withColumnRenamed("kept", "lang").write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1) for k in range(30)] + [(200 + k, 0) for k in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    frame(spark, [(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_take_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append({r["doc_id"] for r in docs.collect()})
    good = {*range(30), 100, 101, 102, 103}
    assert seen[0] == good
    assert seen[1] == good - {100, 101}
    assert seen[2] == seen[3] == good - {100, 101, 102}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "[SECRET:assign]" in texts[103] and "abcdefghijklmnop" not in texts[103]
    assert texts[5] == prose(5, 80, 5000)
    pieces = corpus_pipeline.run(spark, tables)
    assert {r["doc_id"] for r in pieces.collect()} == seen[3]


def test_queries_are_registered():
    names = list(catalogue.all_queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(oracle.oracle_queries()) <= set(names)
