from random import Random

import numpy as np
from corpus import EDGES, clashing, frame
from pyspark.sql import functions as F

from casemart.llm import language_id as L

SYLLABLES = {"aa": "ka to mi ru ne so".split(), "bb": "str ung sch ein der".split(), "cc": "què ção ñor él ía".split()}


def speech(language, seed, size=40, loud=False):
    pick = Random(seed)
    text = " ".join("".join(pick.choice(SYLLABLES[language]) for _ in range(pick.randint(1, 3))) for _ in range(size))
    return text.upper() if loud else text


def corpus():
    rows, n = [], 1000
    for k in range(60):
        for language in SYLLABLES:
            rows.append((n, speech(language, n, loud=k % 7 == 0), language))
            n += 1
    return rows


def fitted(spark, rows):
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), dimensions=512, sample=30)


def test_held_out_accuracy(spark):
    rows = corpus()
    model = fitted(spark, rows[:120])
    found = {r["doc_id"]: r for r in L.predict(frame(spark, [r[:2] for r in rows]), model).collect()}
    assert np.mean([found[d]["lang_pred"] == lang for d, _, lang in rows[120:]]) == 1.0
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_edges(spark):
    rows = corpus()
    odd = [(None, "no id ka to", "aa"), (1, None, "aa"), (2, "ka to", None), (3, "", "bb"), (4, "12 ?!", "bb")]
    model = fitted(spark, rows + odd + rows[:5])
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"]
    for docs in [frame(spark, EDGES), clashing(spark, EDGES)]:
        held = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
        found = L.predict(docs, model, held)
        assert found.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
        by_text = list(zip([t for _, t in EDGES], found.collect()))
        for text, row in by_text:
            lettered = any(c.isalpha() for c in text or "")
            assert (row["lang_pred"] == "und") == (not lettered)
            assert lettered or (row["score"] == 0 and row["rejected"])
    assert L.predict(frame(spark, EDGES).limit(0), model).count() == 0
    empty = fitted(spark, odd[:0] + [(1, None, None)])
    assert {r["lang_pred"] for r in L.predict(frame(spark, EDGES), empty).collect()} == {"und"}


def test_far_texts_are_rejected(spark):
    rows = corpus()
    model = fitted(spark, rows)
    strange = [(1, "zxq wvp jjk " * 30), (2, speech("aa", 5))]
    found = {r["doc_id"]: r["rejected"] for r in L.predict(frame(spark, strange), model).collect()}
    assert found[1] and not found[2]


def test_centroids_are_the_best_of_their_rows():
    pick = np.random.default_rng(1)
    a, b = np.eye(8)[0], np.eye(8)[1]
    x = np.stack([(a if i % 2 else b) + 0.05 * pick.random(8) for i in range(40)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    means, own = L.spherical_k_means(x, 2)
    assert len(means) == 2 and len(set(own[::2])) == 1 and own[0] != own[1]
    assert np.allclose(np.linalg.norm(means, axis=1), 1)


def test_trigrams_do_not_cross_texts():
    import pyarrow as pa

    apart = [list(L.counts(pa.array([t], pa.string()), 256))[0][1][0] for t in ["ab", "cd é", None, "x"]]
    together = next(L.counts(pa.array(["ab", "cd é", None, "x"]), 256))[1]
    assert (np.stack(apart) == together).all()


def test_the_sample_is_bounded_and_complete(spark):
    """One id for a whole language, rows repeated a thousand times, null ids: each language has its share of different rows."""
    rows = [(7, speech("aa", k), "aa") for k in range(400)] + [(8, speech("bb", 1), "bb")] * 1000 + [(k, speech("bb", k), "bb") for k in range(5)]
    rows += [(None, speech("cc", k), "cc") for k in range(50)] + [(k, speech("cc", k), "dd") for k in range(3000)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sizes = {}
    for r in L.sampled(train, 40).collect():
        sizes.setdefault(r["lang"], []).append(r["text"])
    # The row of id 8 and that of id 1 have one text; the others are all different.
    assert {k: len(v) for k, v in sizes.items()} == {"aa": 40, "bb": 6, "cc": 40, "dd": 40}
    again = L.sampled(train.repartition(5), 40)
    assert sorted((r["lang"], r["text"]) for r in again.collect()) == sorted((k, t) for k, v in sizes.items() for t in v)
    assert set(fitted(spark, rows).languages) == {"aa", "bb", "cc", "dd"}


def test_capitals_of_other_scripts():
    import pyarrow as pa

    for text in ["Съешь Ещё Этих Мягких Булок", "Ξεσκεπάζω Την Ψυχοφθόρα", "Žluťoučký Kůň Ąę", "Été À Öl", "Plain Words"]:
        upper, lower = (next(L.counts(pa.array([t]), 4096))[1] for t in (text.upper(), text.lower()))
        if "Ξ" not in text:  # capital sigma has two small forms, and accents are dropped in capitals
            assert (upper == lower).all(), text
        assert (next(L.counts(pa.array([text]), 4096))[1] == lower).all(), text
