"""Filter interaction audit (op 12): what each of five filters removes, in every order, from truth-table survival words.

A document fails some of the filters A-E; of the 32 subsets of filters it survives those without a failed one. Its survival
word has a bit for each subset, 32 in all, and there is one word for each of the 32 patterns of failures. The number of documents
with a bit set is the number of survivors of that subset, and every figure of the report is a difference of two such numbers:
step k of an order removes survivors(first k-1 filters) - survivors(first k filters).

1. facts: one pass over the texts gives doc_id, part, the failures A-D and a SHA-256 of the text; written to the shared folder.
   Texts are not read again.
2. E: the smallest doc_id of each digest that is there twice (map tasks send one row per digest); joined back, as are the labels.
   Spark broadcasts these two tables if their size allows it, and splits hot digests if not.
3. words: a task counts the bits of its words by carry-save adders, for each part and for all, good and toxic documents: three
   words of a weight give one of it and one of twice the weight, until two are left. It sends 96 numbers per part.
4. report: the numbers of a part are added up, and its 600 rows (120 orders, 5 steps) are written out.

Null texts are empty: they fail A only, or E if an empty text has a smaller id. A null part is the empty string. A null doc_id is
neither smaller nor larger than another, so it fails no E and has no labels. Repeated rows, and rows with one id, count each and
do not make each other fail E. A document is good (toxic) if one of its labels says 1. Parts have rows for all orders and steps,
zeros included; an empty table has no parts. Words of a text are told apart by 64-bit hashes, texts by SHA-256. Long texts
are processed alone, in some 20 times their size of memory. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import blocks, raw_text, span_hashes, stored, word_spans

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 50
#: Percent of words that are distinct, at least; percent of characters that are A-Z, at most; characters that no text may hold.
DISTINCT, CAPITALS, MARKS = 65, 5, "#$%&*|"
#: Parts whose counts a task holds before it sends them.
TASK_PARTS = 10_000
KINDS = ["kept", "good", "toxic"]

_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in MARKS]] = True
#: By pattern of failures: bit s is set if no failed filter is in subset s.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if s & failed == 0) for failed in range(SUBSETS)], np.uint32)


def failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits 0-3 for the filters A-D that each text fails."""
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    hashes = span_hashes(data, starts, ends)
    order = np.lexsort((hashes, text_of))
    h, t = hashes[order], text_of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    distinct = np.bincount(t[new], minlength=len(n_words))

    def inside(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    points = inside((data & 0xC0) != 0x80)
    capitals = inside((data >= 65) & (data <= 90))
    fails = [n_words < LEAST_WORDS, 100 * distinct < DISTINCT * n_words, 100 * capitals > CAPITALS * points, inside(_MARK[data]) > 0]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        failed = pa.array(failures(*raw_text(block.column("text"))), pa.int32())
        yield pa.RecordBatch.from_arrays([*(block.column(c) for c in ("doc_id", "part", "digest")), failed], ["doc_id", "part", "digest", "failed"])


def filter_facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and the failures A-D of each document."""
    text = F.coalesce("text", F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    read = docs.select("doc_id", part.alias("part"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    return read.mapInArrow(_judge, "doc_id long, part string, digest binary, failed int")


def judged(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits 0-4), good and toxic of each document."""
    copies = facts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "least")
    said = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    marks = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(*said)
    every = facts.join(copies, "digest", "left").join(marks, "doc_id", "left")
    again = F.coalesce((F.col("doc_id") > F.col("least")).cast("int"), F.lit(0))
    flags = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
    return every.select("part", (F.col("failed") + 16 * again).alias("failed"), *flags)


def popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits, by carry-save adders."""
    counts, weight = np.zeros(32, np.int64), 1
    places = np.arange(32, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) >= 3:
            k = len(words) // 3
            a, b, c = words[:k], words[k : 2 * k], words[2 * k : 3 * k]
            either = a ^ b
            carries.append((a & b) | (either & c))
            words = np.concatenate([either ^ c, words[3 * k :]])
        for word in words:
            counts += weight * ((word >> places) & np.uint32(1)).astype(np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        survivors = np.stack(list(held.values())).reshape(-1)
        lists = pa.ListArray.from_arrays(np.arange(0, len(survivors) + 1, len(KINDS) * SUBSETS, dtype=np.int32), survivors)
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), lists], ["part", "survivors"])

    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        code = parts.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        words = SURVIVAL[batch.column("failed").to_numpy()[order]]
        flags = [batch.column(c).to_numpy(zero_copy_only=False)[order] for c in KINDS[1:]]
        ends = np.cumsum(np.bincount(code, minlength=len(parts.dictionary)))
        for name, stop, start in zip(parts.dictionary.to_pylist(), ends, [0, *ends[:-1]], strict=True):
            own = words[start:stop]
            counts = np.stack([popcounts(own), *(popcounts(own[f[start:stop]]) for f in flags)])
            held[name] = held[name] + counts if name in held else counts
        if len(held) >= TASK_PARTS:
            yield flush()
            held.clear()
    if held:
        yield flush()


def survivors(rows: DataFrame) -> DataFrame:
    """part and, for all, good and toxic documents one after the other, the survivors of each of the 32 subsets."""
    partial = rows.mapInArrow(_counted, "part string, survivors array<long>")
    n = len(KINDS) * SUBSETS
    sums = partial.groupBy("part").agg(*(F.sum(F.get("survivors", F.lit(k))).alias(f"s{k}") for k in range(n)))
    return sums.select("part", F.array(*(f"s{k}" for k in range(n))).alias("survivors"))


def _orders() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All orders, and by order and step: the filter, the subset before the step and the subset after it."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    filters = np.array([[FILTERS.index(c) for c in order] for order in orders])
    after = np.cumsum(1 << filters, axis=1)
    return orders, filters, after - (1 << filters), after


ORDERS, FILTER_AT, BEFORE, AFTER = _orders()
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = np.repeat(ORDERS, len(FILTERS))
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    single, every = 1 << np.arange(len(FILTERS)), SUBSETS - 1
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("survivors").to_pylist(), strict=True):
            kept, good, toxic = np.array(counts, np.int64).reshape(len(KINDS), SUBSETS)
            removed = kept[BEFORE] - kept[AFTER]
            fails = kept[0] - kept[single]
            unique = kept[every - single] - kept[every]
            shapley = np.array([removed[FILTER_AT == f].sum() for f in range(len(FILTERS))])
            by_step = [kept[AFTER], removed, fails[FILTER_AT] - removed, unique[FILTER_AT], good[BEFORE] - good[AFTER], toxic[BEFORE] - toxic[AFTER], shapley[FILTER_AT]]
            columns = [pa.array([part] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(steps)]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c.reshape(-1), pa.int64()) for c in by_step)], ["part", "filter_order", "step", *COUNTS])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step (its filter is that letter of the order), with the counts of COUNTS: survivors
    after the step; removed by it; failing its filter but removed before; failing its filter only; good and toxic documents among those
    removed; and what its filter removes, added up over all orders."""
    facts = stored(filter_facts(docs), "filter_facts")
    return survivors(judged(facts, labels)).mapInArrow(_reported, REPORT)

