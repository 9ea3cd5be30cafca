import hashlib
from collections import Counter

from corpus import EDGES, clashing, frame, lower, prose

from casemart.llm import line_dedup as L


def key(line):
    return lower(line.strip("\x20\t\n\x0b\f\r"))


def plain(rows, least, shortest=1):
    found = Counter(k for _, t in rows for k in {key(line) for line in (t or "").split("\n")} if len(k) >= shortest)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if found[key(line)] < least]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def corpus():
    """Lines shared by 3 documents or more, in other cases and with other spaces; one line alone, first, last, doubled."""
    rows = [(k, f"  Shared LINE é\t\n{prose(k, 6)}\n\n{'Twice' if k % 2 else 'once'}\nshared line é\x0b") for k in range(20, 26)]
    rows += [(30, "shared line é"), (31, "shared line É\nTWICE"), (32, "\n"), (33, "x\ntwice"), (34, "a\r\nb\n\n"), (35, "nbsp\xa0\nnbsp")]
    return rows + [(40, "x\n" * 3000 + "once"), (41, "x"), (41, "x"), (42, "Zeile eins")] + EDGES


def test_equal_to_plain_python(spark):
    rows = corpus()
    for docs in [frame(spark, rows), clashing(spark, rows).withColumn("n_lines", L.F.lit("own")).withColumn("places", L.F.lit("own"))]:
        for least, shortest in [(3, 1), (2, 1), (1, 1), (3, 3), (10_000, 1)]:
            found = L.line_dedup(docs, least, shortest).collect()
            expected = [(d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, n, gone, t in plain(rows, least, shortest)]
            assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_texts_and_other_columns_stay(spark):
    docs = clashing(spark, corpus()).withColumn("n_lines", L.F.lit("own"))
    kept = L.without_common_lines(docs, 3)
    assert kept.columns == [*docs.columns, "_n_lines", "n_dropped"]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in kept.collect()])) == sorted(map(str, [(d, t) for d, _, _, t in plain(corpus(), 3)]))


def test_empty_table(spark):
    assert L.line_dedup(frame(spark, [])).count() == 0


def test_no_python_and_counted_before_the_shuffle(spark):
    plan = L.common_keys(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_count" in plan
