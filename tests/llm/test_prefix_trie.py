import hashlib
import zlib
from collections import defaultdict
from random import Random

import numpy as np
import pytest
from corpus import prose

from casemart.llm import prefix_trie as T

DDL = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    """Nodes as tuples of turns; every figure by going through all members and all nodes."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        whole[c] = tuple(turns.get(base, [])[:h]) + tuple(own[h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, found in members.items():
        cost = (len(found) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += children[node] == 0
    out = set()
    for node, found in members.items():
        ends = ",".join(str(c) for c in found if len(whole[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.add((found[0], len(node), parent, len(found), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def corpus():
    pick, rows = Random(5), []
    for c in range(120):
        shared = pick.randrange(3)
        for turn in range(pick.randrange(1, 12)):
            text = f"{'é' * shared}{turn}" if pick.random() < 0.7 else prose(1000 * c + turn, 3)
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += [(1000 + k, turn, "user", f"the same {turn}") for k in range(60) for turn in range(4)]
    rows += [(2000, None, None, None), (2000, None, "", "a null turn"), (2000, 3, "user", "x"), (2000, 3, "user", "x"), (2000, 3, "a", "tie")]
    rows += [(None, 0, "user", "no id"), (-7, 0, "user", "a negative id"), (-5, 0, "user", "0"), (-5, 1, "us", "er0"), (3001, 0, "r", "x" * 50_000)]
    rows += [(4000 + k, turn, "r", str(turn)) for k in (0, 1) for turn in range(300)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, chunk", [(400_000, 1000), (40, 7)])
def test_equal_to_plain_python(spark, shard, chunk):
    rows = corpus()
    frame = spark.createDataFrame(rows, DDL).withColumn("digest", T.F.lit("own")).withColumn("end", T.F.lit("own")).withColumn("turns", T.F.lit("own"))
    found = T.prefix_trie(frame, shard, chunk).collect()
    expected = plain(rows)
    assert len(found) == len(expected)
    assert {tuple(r) for r in found} == expected


def test_empty_table(spark):
    assert T.prefix_trie(spark.createDataFrame([], DDL)).count() == 0
    assert T.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], DDL)).count() == 0


def test_a_lone_conversation_without_turns(spark):
    """7 takes its first turns from 5, which isn't there."""
    assert zlib.crc32(b"7") % 9 > 0
    found = T.prefix_trie(spark.createDataFrame([(7, 0, "user", "x")], DDL)).collect()
    assert [tuple(r) for r in found] == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 60_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(0, 2**64, (n, 2), dtype=np.uint64)
    keys[n // 2 :, 0] = 7  # half of the digests are equal in one half
    table = T.PerfectHash(keys)
    assert sorted(table.slots(keys)) == list(range(n))
    with pytest.raises(ValueError):
        table.slots(keys[:1] + np.uint64(1))
    with pytest.raises(ValueError):
        T.PerfectHash(np.concatenate([keys, keys[:1]]))


def test_a_digest_of_two_prefixes_is_refused():
    rows = [(1, 1, [T.ROOT, b"a" * 16, b"b" * 16], np.array([1, 1]), 0, True), (2, 1, [T.ROOT, b"c" * 16, b"b" * 16], np.array([1, 1]), 1, True)]
    with pytest.raises(ValueError):
        T.node_table(rows)
