from corpus import EDGES, clashing, frame, prose

from casemart.llm import decontamination as D

ITEM = "If Anna buys 12 apples for 3.50 dollars each and sells 5 of them to Bob, how much money did Anna spend on the apples that she kept?"
OTHER = prose(7, 40)
ITEMS = [(1, ITEM), (2, OTHER), (3, None), (4, ""), (5, "too short"), (None, prose(8, 30))]
AROUND = prose(50, 60, 5000), prose(51, 50, 5000)


def wrapped(text):
    return f"{AROUND[0]}\n{text}\n{AROUND[1]}"


def rebuilt(values):
    """The item with other names and numbers."""
    text = ITEM
    for old, new in values:
        text = text.replace(old, new)
    return text


DOCS = [
    (10, wrapped(ITEM)), (11, wrapped(rebuilt([("Anna", "Zoe"), ("Bob", "Max"), ("12", "77"), ("3.50", "1.25"), ("5 of", "9 of")]))),
    (12, wrapped(OTHER)), (12, wrapped(OTHER)), (13, prose(60, 300)), (14, wrapped(OTHER.upper())),
    # Anna becomes two people: the template fits, the slots don't.
    (15, wrapped("If Carl buys 12 apples for 12 dollars each and sells 12 of them to Carl, how much money did Dora spend on the apples that she kept?")),
    (16, wrapped(" ".join(OTHER.split()[:12]))), (17, wrapped(prose(8, 30))), (None, wrapped(OTHER)),
]
CLEAN = {13, 15, 16}


def test_items_are_found(spark):
    for docs in [frame(spark, DOCS), clashing(spark, DOCS)]:
        items = clashing(spark, ITEMS).withColumnRenamed("item_id", "x").withColumnRenamed("doc_id", "item_id")
        found = {(r["doc_id"], r["item_id"]): r for r in D.contaminated(docs, items).collect()}
        assert set(found) == {(10, 1), (11, 1), (12, 2), (14, 2), (17, None), (None, 2)}
        assert found[10, 1]["kind"] == "verbatim" and found[11, 1]["kind"] == "reparameterised"
        assert found[11, 1]["slots"] == found[11, 1]["consistent_slots"] >= 5
        assert found[12, 2]["cover"] == 1.0


def test_decontaminate_keeps_clean_rows(spark):
    rows = DOCS + EDGES
    docs = clashing(spark, rows)
    items = frame(spark, ITEMS, "item_id long, text string")
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(str(row) for row in [*EDGES, *(r for r in DOCS if r[0] in CLEAN)])
    assert D.decontaminate(docs, items.limit(0)).count() == len(rows)
    assert D.contaminated(docs.limit(0), items).count() == 0


def test_a_passage_repeated_in_a_long_text(spark):
    rows = [(1, (wrapped(OTHER) + "\n") * 60)]
    (row,) = D.contaminated(frame(spark, rows), frame(spark, ITEMS, "item_id long, text string")).collect()
    assert row["cover"] == 1.0 and row["first_term"] < 200


def test_templates():
    import pyarrow as pa

    texts = ["Anna Smith paid 3.50 dollars. Then Bob ran 5km, 1,000 km", "", None, "é 12a."]
    template = D.Template(pa.array(texts))
    kinds = [template.kind[a:b].tolist() for a, b in zip(template.first, template.first[1:])]
    W, N, U, P = 0, 1, 2, 3
    assert kinds == [[W, P, W, N, U, W, P, W, N, N, U], [], [], [W, N]]


def test_windows_go_with_their_texts(spark):
    plain = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, 2, plain), (2, 3, "x. " + plain), (3, 4, "1 2 3 a b 4 5")]
    found = D._windows(spark.createDataFrame(rows, "id long, row long, text string")).collect()
    own = {r["place"]: r["window"] for r in found if r["id"] == 1}
    assert sorted(own) == list(range(6))
    assert {r["place"]: r["window"] for r in found if r["id"] == 2 and r["place"]} == {p + 1: w for p, w in own.items()}
    assert not [r for r in found if r["id"] == 3]  # too few words


DENSE = [
    (1, "What is 12 + 7 * 3 - 4 / 2? Answer 31"), (2, "Capital of France?"), (3, "Sum of 3 5 8 13 21 34 55 89 144 233"),
    (4, "Then Karl gave Otto and Emma the old Schlüssel of Ulm before Ida came"), (5, ITEM), (6, "of a"),
]


def test_dense_and_short_items(spark):
    items = frame(spark, DENSE, "item_id long, text string")
    rows = [(10 * i, wrapped(text)) for i, text in DENSE] + [(10 * i + 1, wrapped(text.lower())) for i, text in DENSE]
    rows += [(100, wrapped("What is 99 + 7 * 3 - 5 / 2? Answer 8")), (101, wrapped("Sum of 3 5 9 14 22")), (102, wrapped("capital of Spain"))]
    # An insertion of ten terms, and the same two halves too far apart.
    halves = ITEM.split(" ")[:13], ITEM.split(" ")[13:]
    rows += [(110, wrapped(" ".join([*halves[0], prose(70, 10), *halves[1]]))), (111, wrapped(" ".join([*halves[0], prose(71, 200), *halves[1]])))]
    found = {(r["doc_id"], r["item_id"]): r for r in D.contaminated(frame(spark, rows), items).collect()}
    copies = {(10 * i + low, i) for i, _ in DENSE if i != 6 for low in (0, 1)}
    assert set(found) == copies | {(110, 5)}
    assert all(found[pair]["kind"] == "verbatim" and found[pair]["cover"] == 1.0 for pair in copies)


def test_a_slotted_item_with_few_plain_stretches(spark):
    item = "Add 5 to 7 9 11 13 15 17 19 then write the whole result of these steps down"
    docs = [(1, wrapped(item.replace("9 11 13", "2 4 6"))), (2, wrapped("Add 8 to 1 2 3 4 5 6 20 then write the whole result of these steps down")), (3, wrapped("then write the whole result today"))]
    found = {r["doc_id"]: r["kind"] for r in D.contaminated(frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(found) == {1, 2} and found[2] == "reparameterised"


def plain_answer(docs, items):
    """All pairs, all windows of both, without hash join, filter or probes."""
    import pyarrow as pa

    def terms(text):
        template = D.Template(pa.array([text], pa.string()))
        return list(zip(template.kind.tolist(), template.value.tolist())), int(template.reach()[0])

    found = set()
    for item_id, text in items:
        own, reach = terms(text)
        size = D.WINDOW if len(own) >= D.WINDOW else len(own)
        if len(own) < D.LEAST_TERMS:
            continue
        for doc_id, other in docs:
            theirs, _ = terms(other)
            matches = []
            for p in range(len(theirs) - size + 1):
                for q in range(len(own) - size + 1):
                    a, b = theirs[p : p + size], own[q : q + size]
                    typed = [x if x[0] == 0 else x[0] for x in a] == [x if x[0] == 0 else x[0] for x in b]
                    if [x[1] for x in a] == [x[1] for x in b] or typed and sum(x[0] == 0 for x in a) >= min(D.LEAST_WORDS, size):
                        matches.append((p, q, [x[1] for x in a], [x[1] if x[0] else 0 for x in b]))
            least = D.needed(len(own), reach, D.COVER)
            if any(x["covered"] >= least and x["consistent"] >= D.CONSISTENT * x["slots"] for x in D.occurrences(matches, len(own))):
                found.add((doc_id, item_id))
    return found


def test_against_all_pairs(spark):
    from random import Random

    pick = Random(5)
    phrase = "how many of them does she have in the end"

    def made():
        names, numbers = ["Anna", "Bob", "Carl", "Dora"], [str(pick.randrange(50)) for _ in range(4)]
        parts = [f"{pick.choice(names)} has {pick.choice(numbers)} red apples", phrase, " ".join(pick.choices(numbers, k=6)), prose(pick.randrange(99), 6, 30), f"and pays {pick.choice(numbers)} dollars"]
        return " ".join(pick.sample(parts, pick.randrange(1, 5)))

    items = [(i, made()) for i in range(40)]
    docs = [(i, f"{prose(i, 20, 30)} {made()} {pick.choice(items)[1]}".replace("Anna", pick.choice(["Anna", "Zoe", "anna"]))) for i in range(60)]
    found = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == plain_answer(docs, items) and len(found) > 60


def test_probes_are_in_every_cover():
    from itertools import combinations
    from random import Random

    pick = Random(3)
    for _ in range(60):
        windows = [(pick.randrange(1, 9), 100 + i, i, 5) for i in range(pick.randrange(1, 9))]
        least = pick.choice([3, 5, 6, 7.5, 9])
        probes = set(D.probe_windows(windows, least))
        for k in range(1, len(windows) + 1):
            for chosen in combinations(windows, k):
                if len({t for w in chosen for t in range(w[2], w[2] + 5)}) >= least:
                    assert probes & {w[1] for w in chosen}
