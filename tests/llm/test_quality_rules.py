from collections import Counter

import numpy as np
from corpus import EDGES, WORD, clashing, frame, prose, words

from casemart.llm import quality as Q


def counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    "a b c a b c", "a a a a", "x y z\nx y z\n \nx y z", "a b\ta b\x0ba b\x0ca b\ra b", "é|è <b> # é|è <b> #",
    "one two three four one two three", "\n\n", "a b c d a b c e a b", "nbsp\xa0is no space", "a b",
]


def corpus():
    rows = [*EDGES, *((200 + k, t) for k, t in enumerate(TEXTS))]
    return rows + [(300 + k, prose(k, 40 + 3 * k) + "\n" + prose(k % 3, 12)) for k in range(20)]


def test_counts_equal_plain_python(spark):
    rows = corpus()
    for docs in [frame(spark, rows), clashing(spark, rows)]:
        found = Q.quality(docs, []).collect()
        expected = []
        for d, t in rows:
            c = counts(t)
            failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
            expected.append((d, *c, failed, not failed))
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert Q.quality(frame(spark, rows).limit(0), []).count() == 0


def labelled(spark):
    """Bad texts are loud, or full of symbols; some labels are missing, null, doubled or contradictory."""
    rows, labels = [], []
    for k in range(240):
        text = prose(k, 80)
        bad = k % 4 == 0
        if bad:
            text = text.upper() if k % 8 else text.replace(" ", " ### ")
        rows.append((k, text))
        if k % 10 != 9:
            labels.append((k, 0 if bad else 1))
    labels += [(0, 1), (1, None), (None, 0), (5000, 0), (4, 0)]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_separate_held_out_rows(spark):
    docs, labels = labelled(spark)
    rules = Q.fit_rules(docs, labels)
    assert rules and {c.feature for rule in rules for c in rule} <= set(Q.FEATURES)
    found = {r["doc_id"]: r["kept"] for r in Q.quality(docs, rules).collect()}
    assert all(found[k] == (k % 4 != 0) for k in range(240) if k % 10 == 9)


def test_no_labels_no_rules(spark):
    docs, labels = labelled(spark)
    assert Q.fit_rules(docs, labels.limit(0)) == []
    assert Q.fit_rules(docs, labels.filter("quality = 1")) == []
    assert Q.fit_rules(docs.limit(0), labels) == []


def test_sample_is_bounded(spark):
    docs, labels = labelled(spark)
    assert isinstance(Q.fit_rules(docs, labels, sample_rows=7), list)


def test_verdict_is_the_first_rule_that_covers():
    values = np.zeros((90, len(Q.FEATURES)))
    values[:, 0] = np.arange(90)
    bad = (values[:, 0] > 60) | (values[:, 0] < 15)
    rules = Q.learn_rules(values, bad)
    verdicts = np.zeros(90, bool)
    for rule in rules:
        verdicts |= Q.covers(rule, values)
    assert (verdicts == bad).all() and len(rules) == 2


def test_noise_is_not_learned():
    pick = np.random.default_rng(1)
    values = pick.random((600, len(Q.FEATURES)))
    rules = Q.learn_rules(values, pick.random(600) < 0.1)
    assert sum(Q.covers(rule, values).sum() for rule in rules) <= 12


def test_kept_rows_keep_their_columns(spark):
    docs = clashing(spark, corpus())
    kept = Q.keep_good(docs, [(Q.Condition("symbol_share", True, 0.2),)])
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {8, *range(300, 320)}


def test_no_python_in_the_plan(spark):
    docs, labels = labelled(spark)
    text = Q.quality(docs, [(Q.Condition("words", False, 3.0),)])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
