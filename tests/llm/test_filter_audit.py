import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from corpus import EDGES, prose, words

from casemart.llm import filter_audit as A


def fails(text):
    text = text or ""
    w = words(text)
    capitals = len(re.findall("[A-Z]", text))
    return {f for f, failed in zip("ABCD", [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * capitals > 5 * len(text), re.search("[#$%&*|]", text)], strict=True) if failed}


def plain(rows, labels):
    """Each order applied to each document, one after the other."""
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    failed = []
    for d, text, source in rows:
        again = d is not None and any(e is not None and e < d and (t or "") == (text or "") for e, t, _ in rows)
        failed.append((d, source or "", fails(text) | ({"E"} if again else set())))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {p for _, p, _ in failed}:
            left = [(d, f) for d, p, f in failed if p == part]
            inside = list(left)
            for step, name in enumerate(order, 1):
                gone = [d for d, f in left if name in f]
                left = [(d, f) for d, f in left if name not in f]
                shapley[part, name] += len(gone)
                all_fail = sum(name in f for _, f in inside)
                out[part, order, step] = [len(left), len(gone), all_fail - len(gone), sum(f == {name} for _, f in inside), len([d for d in gone if d in good and d is not None]), len([d for d in gone if d in toxic and d is not None])]
    return {(part, order, step, *counts, shapley[part, order[step - 1]]) for (part, order, step), counts in out.items()}


def corpus():
    texts = [prose(k, 45 + k) + (" #" if k % 3 == 0 else "") + (" LOUD WORDS HERE" * 3 if k % 4 == 0 else "") + " again" * (60 if k % 5 == 0 else 0) for k in range(12)]
    rows = [(k, texts[k % 12], ["one", "two", None, ""][k % 4] if k % 7 else "hot") for k in range(100, 160)]
    rows += [(d, t, "edges") for d, t in EDGES] + [(None, texts[0], "one"), (100, texts[0], "one")]
    labels = [(k, k % 3 and 1, k % 2) for k in range(100, 150)] + [(100, 0, 1), (101, None, None), (None, 1, 1), (7, 1, 1), (7, 1, 0), (9999, 1, 1)]
    return rows, labels


def with_source(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_equal_to_plain_python(spark):
    rows, labels = corpus()
    docs, said = with_source(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    clash = docs
    for name in ["good", "toxic", "digest", "failed", "survivors", "least", "part", "n"]:
        clash = clash.withColumn(name, A.F.lit("own"))
    expected = plain(rows, labels)
    for table in [docs, clash]:
        found = A.filter_audit(table, said.withColumn("part", A.F.lit("own"))).collect()
        assert len(found) == len(expected)
        assert {tuple(r) for r in found} == expected


def test_empty_tables(spark):
    rows, labels = corpus()
    nothing, said = with_source(spark, []), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert A.filter_audit(nothing, said).count() == 0
    found = A.filter_audit(with_source(spark, rows), said.limit(0)).collect()
    assert {tuple(r) for r in found} == plain(rows, [])


def test_survival_words():
    assert [int(A.SURVIVAL[f]).bit_count() for f in range(32)] == [1 << (5 - f.bit_count()) for f in range(32)]
    assert A.SURVIVAL[31] == 1 and A.SURVIVAL[0] == 2**32 - 1


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 1000, 99_999])
def test_popcounts(n):
    drawn = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert A.popcounts(drawn).tolist() == [int((drawn >> np.uint32(k) & np.uint32(1)).sum()) for k in range(32)]
