"""Small documents for the tests, and plain Python answers."""

from __future__ import annotations

import re
from collections import defaultdict
from random import Random

# Words of letters alone.
NAMES = ["".join("bdfgklmnprstvz"[(i // 14**k) % 14] + "aeiou"[(i + k) % 5] for k in range(4)) for i in range(5000)]
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def frame(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


def clashing(spark, rows):
    """The same documents with extra columns whose names operators use for their own."""
    names = "row class component leader n part kept kind score spans place _key _row _stats _doc window held_out item_id sequence_id piece"
    ddl = "doc_id long, text string, " + ", ".join(f"`{name}` string" for name in names.split())
    return spark.createDataFrame([(*row, *["x"] * len(names.split())) for row in rows], ddl)


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Ünï cödé — 日本語 🙂"), (None, "a null id with some words in it"),
    (None, None), (6, "same id, first text of it"), (6, "same id, first text of it"), (6, "same id, another text"),
    (7, "x" * 30_000), (8, "word " * 12_000), (9, ".,;!?"),
]


def prose(seed, size, vocabulary=400):
    pick = Random(seed)
    return " ".join(f"{NAMES[pick.randrange(vocabulary) % len(NAMES)]}{'.' * (pick.random() < 0.1)}" for _ in range(size))


def edited(text, seed, edits):
    pick = Random(seed)
    out = text.split(" ")
    for _ in range(edits):
        out[pick.randrange(len(out))] = f"new{pick.randrange(10**6)}"
    return " ".join(out)


def components(pairs, nodes):
    of = {n: n for n in nodes}

    def root(x):
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        of[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_groups(rows):
    """component_id and set size by (doc_id, text), by comparing all sets that share a shingle."""
    sets = {row: shingles(row[1]) for row in set(rows)}
    holders = defaultdict(list)
    for row, own in sets.items():
        for s in own:
            holders[s].append(row)
    pairs = set()
    for held in holders.values():
        for a in held:
            for b in held:
                both = len(sets[a] & sets[b])
                if a is not b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    pairs.add((a, b))
    number = {row: i for i, row in enumerate(sorted(sets, key=str))}
    back = sorted(sets, key=str)
    of = components([(number[a], number[b]) for a, b in pairs], number.values())
    groups = defaultdict(list)
    for row in sets:
        groups[of[number[row]]].append(row[0])
    least = {k: min([d for d in ids if d is not None], default=None) for k, ids in groups.items()}
    return {back[i]: (least[of[i]] if sets[back[i]] else back[i][0], len(sets[back[i]])) for i in of}
