"""Words that disclose protected entities, against plain counting."""

import math
import re
from collections import Counter
from random import Random

from corpus import clashing, frame, prose

from casemart.llm import pii

TERM = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def plain(rows, chance=pii.CHANCE, generalise=pii.GENERALISE, remove=pii.REMOVE):
    """Revealing terms (removed or not), and the spans of each text, by counting all pairs of entity and term."""
    total = len(rows)
    base = {t: pii.base_spans(t) for _, t in rows}

    def terms(text):
        free = [m for m in TERM.finditer(text or "") if all(m.end() <= a or m.start() >= b for _, a, b in base[text])]
        return [(m.start(), m.end(), m[0].lower() if m[0].isascii() else m[0]) for m in free]

    def name(kind, value):
        return (kind, value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value))

    n_term = Counter(w for _, t in rows for w in {w for *_, w in terms(t)})
    n_entity, texts, together, both, distance = Counter(), Counter(), Counter(), Counter(), {}
    classes = {}
    for t, copies in Counter(t for _, t in rows).items():
        own = {}
        for kind, a, b in base[t]:
            own.setdefault(name(kind, t[a:b]), []).append(a)
        for e in own:
            classes.setdefault(e, set()).add(t)
        n_entity.update({e: copies for e in own})
        texts.update(own.keys())
    group = {e: frozenset(t) for e, t in classes.items()}
    for t, copies in Counter(t for _, t in rows).items():
        found = terms(t)
        starts = [s for s, *_ in found]
        own = {}
        for kind, a, b in base[t]:
            own.setdefault(group[name(kind, t[a:b])], []).append(sum(s < a for s in starts))
        for g, places in own.items():
            words = {}
            for i, (_, _, w) in enumerate(found):
                words[w] = min(words.get(w, 10**9), min(abs(i - p) for p in places))
            for w, d in words.items():
                together[g, w] += copies
                both[g, w] += 1
                distance[g, w] = min(distance.get((g, w), 10**9), d)
    of = {group[e]: (n_entity[e], texts[e]) for e in group}
    best = {}
    for (g, w), k in both.items():
        n_e, m = of[g]
        by_chance = m * n_term[w] / total
        bound = min(by_chance / k, math.exp(k - by_chance) * (by_chance / k) ** k if k > by_chance else 1.0)
        whole = math.log2(total / n_e)
        d = math.log2(total * together[g, w] / (n_e * n_term[w])) / whole if whole > 0 else 0.0
        if bound * 2.0 ** distance[g, w] <= chance and d >= generalise - 1e-12:
            best[w] = max(best.get(w, 0), d)
    spans = {}
    for _, t in rows:
        added = [("removed" if best[w] >= remove else "generalised", a, b) for a, b, w in terms(t) if w in best]
        spans[t] = pii.joined(sorted(base[t] + added, key=lambda s: (s[1], pii._ORDER[s[0]])))
    return best, spans


def corpus():
    """Names beside addresses, some of one document, some of many; copies; addresses that stand together."""
    pick, rows = Random(5), []
    for k in range(260):
        text = prose(k, 30, 600)
        if k % 6 == 0:
            person = k % 48 // 6
            text = f"{prose(k, 9, 600)} Quillfeather{person} wrote from person{person}@corp.example {text}"
        if k % 40 == 1:
            text += f" lone{k}@corp.example and 10.0.{k % 200}.7 Zephyrina{k}"
        if k % 40 == 2:
            text += f" seen with Zephyrina{k - 1}"
        if k % 5 == 0:
            text += " contact office@corp.example"
        rows.append((k, text))
    rows += [(500 + k, rows[41][1]) for k in range(6)] + [(3, rows[3][1])] * 2 + [(None, "x 10.1.2.3 y"), (700, None), (701, ""), (702, "Ünï cödé a@b.c " + prose(9, 400))]
    pick.shuffle(rows)
    return rows


def test_disclosures_equal_plain_counting(spark):
    rows = corpus()
    best, spans = plain(rows)
    assert any(w.startswith("quillfeather") for w in best) and any(w.startswith("zephyrina") for w in best)
    for docs in [frame(spark, rows), clashing(spark, rows)]:
        found = pii.personal_data(docs).collect()
        assert sorted(str((r["doc_id"], r["spans"])) for r in found) == sorted(str((d, spans[t])) for d, t in rows)


def test_a_name_of_one_document_is_found_in_others(spark):
    rows = [(k, prose(k, 40, 300)) for k in range(1200)]
    rows[10] = (10, prose(10, 20, 300) + " Zephyrina Quillfeather q7@unique.example " + prose(11, 20, 300))
    rows[11] = (11, prose(12, 20, 300) + " said Zephyrina Quillfeather yesterday")
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(spark, rows)).collect()}
    text = dict(rows)
    for k in (10, 11):
        for word in ("Zephyrina", "Quillfeather"):
            at = text[k].index(word)
            assert f"generalised:{at}:{at + len(word)}" in found[k] or f"removed:{at}:{at + len(word)}" in found[k]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert all("Zephyrina" not in clean[k] and "Quillfeather" not in clean[k] for k in (10, 11)) and "<EMAIL>" in clean[10]
    assert clean[20] == text[20]


def test_many_entities_in_one_text(spark):
    """Entities of the same documents are one class: a list of addresses and names is not paired address by name."""
    rows = [(k, prose(k, 40, 300)) for k in range(300)]
    rows.append((900, " ".join(f"user{k}@corp.example Name{k}x" for k in range(3000))))
    docs = frame(spark, rows)
    texts = pii.stored(pii._texts_with_entities(pii._found(docs)), "holders")
    classes = pii.stored(pii.entity_classes(texts), "entities")
    assert classes.count() == 3000 and classes.select("klass").distinct().count() == 1
    assert pii.disclosures(docs, texts, classes).filter("disclosure > 0.99").count() >= 3000
