"""Benchmark decontamination (op 6): template canonicalisation with slot consistency.

1. Template. A text is the sequence of its terms (runs of letters and digits, lower-cased). Terms with a digit become the
   slot <number>, words of `UNITS` the slot <unit>, words inside a sentence with a capital at their start alone the slot <name>.
2. Windows of `WINDOW` terms are hashed twice: as templates, with slots as types, if they have `LEAST_WORDS` plain words or
   more (others say nothing), and literally, with the values of all terms, whatever they are. An all-word window is the same in
   both, so a copy in small letters, whose names are plain words, meets the literal windows of the item. An item of fewer than
   WINDOW terms, but `LEAST_TERMS` or more, is one window of its own length.
3. Documents and benchmark items meet in a hash join. A filter, sized by the number of the benchmark's windows and sent to all
   tasks, keeps the other windows of documents from being shuffled. Pairs come from probes alone: of each item, windows
   are left out in the order of how many items have them, as long as those left out cover fewer terms than a document must
   hold. So every match has a probe, and a phrase that many items share makes no pairs unless it is most of them. Then
   all windows of the pairs found are joined.
4. Alignment. The matches of a document and an item are put on diagonals (place in the document less place in the item);
   neighbouring diagonals, within `SHIFT` terms, are one occurrence of the item. Occurrences of parts of an item that follow each
   other in both, with no more terms between them in the document than the item has, are one as well.
5. Slots. Along an occurrence, equal values of the item must have become equal values in the document and different ones
   different ones, as in a question with new numbers. Slots that break this are inconsistent.
6. A document holds an item if the terms of matched windows cover `COVER` of the item's terms, and the consistent slots
   are at least `CONSISTENT` of its slots. Where fewer terms than that are in windows with LEAST_WORDS plain words, which alone
   survive new values, all of these suffice, if they are `LEAST_REACH` or more.

Kinds: `verbatim` if all matched slot values are the item's own, else `reparameterised`.

Items of fewer than LEAST_TERMS terms, null or empty items and texts match nothing. Of an item without a template window (a row of
numbers, a few words) only literal copies are found. Repeated documents are found each (they are one row, for an equal id and
text, which are told apart by a 64-bit hash); repeated items likewise. Null ids are kept as null. Other columns are not
read by `contaminated`, and kept by `decontaminate`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import MOST_BITS, blocks, filter_bits, lower_ascii, mixed, passes, raw_text, span_hashes, stored, without_rows

WINDOW = 5
LEAST_WORDS = 3
SHIFT = 3
COVER = 0.6
CONSISTENT = 0.8
LEAST_TERMS = 3
LEAST_REACH = 8
#: Bytes of text that a task holds as arrays of terms at one time; a longer text is a block of its own.
TEXT_BYTES = 1 << 19
#: Bits of the filter for each window of the benchmark, up to MOST_BITS; one in KEY_BITS of the other windows passes it.
KEY_BITS = 512

# Words for units of measure and money.
UNITS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes oz
ounce ounces lb pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days
week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres percent degree degrees
dollar dollars cent cents euro euros usd eur gbp mph kph""".split()

_U = np.uint64
_I = np.int64
_WORD, _NUMBER, _UNIT, _NAME = 0, 1, 2, 3
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_TERM = _DIGIT.copy()
_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)  # a capital after these starts a sentence
_STOP[[ord(c) for c in ".!?:;\n\"'()[]#*-|"]] = True


def _unit_hashes() -> np.ndarray:
    words = sorted(set(UNITS))
    ends = np.cumsum([len(w) for w in words])
    return np.sort(span_hashes(np.frombuffer("".join(words).encode(), np.uint8), ends - [len(w) for w in words], ends))


_UNITS = _unit_hashes()
_SLOT = mixed(np.arange(4, dtype=_U) + _U(0xABCDEF))


class Template:
    """The terms of a block of texts: hash (slots by type), kind and value of each, its start and end in bytes, and the first of each text."""

    def __init__(self, column: pa.Array):
        data, offsets = raw_text(column)
        inside = _TERM[data]
        if len(data) > 2:  # the point or comma of a number
            inner = ((data[1:-1] == 46) | (data[1:-1] == 44)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
            inside[1:-1] |= inner
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        cut = offsets[:-1][offsets[:-1] < len(data)]
        opens[cut] = inside[cut]
        cut = offsets[1:][offsets[1:] > 0] - 1
        closes[cut] = inside[cut]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.value = span_hashes(lower_ascii(data), self.starts, self.ends)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        head = data[self.starts] if len(self.starts) else np.zeros(0, np.uint8)
        second = data[np.minimum(self.starts + 1, max(len(data) - 1, 0))] if len(self.starts) else head
        # A capital and then none: words in capitals throughout are words.
        capital = (head >= 65) & (head <= 90) & ~((second >= 65) & (second <= 90) & (self.ends - self.starts > 1))
        # A sentence begins at the start of a text, or if a stop lies between a term and the one before it.
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        begins = np.ones(len(self.starts), bool)
        begins[1:] = stops[self.starts[1:]] > stops[self.ends[:-1]]
        begins[self.first[:-1][self.first[:-1] < len(self.starts)]] = True
        self.kind = np.zeros(len(self.starts), np.int8)
        self.kind[capital & ~begins] = _NAME
        if len(self.value):
            self.kind[_UNITS[np.minimum(np.searchsorted(_UNITS, self.value), len(_UNITS) - 1)] == self.value] = _UNIT
        self.kind[digits[self.ends] > digits[self.starts]] = _NUMBER
        self.hash = np.where(self.kind == _WORD, self.value, _SLOT[self.kind])

    def _places(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First term and text of every window of so many terms."""
        counts = np.diff(self.first)
        n = np.maximum(counts - size + 1, 0)
        owner = np.repeat(np.arange(len(n)), n)
        return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[:-1], n), owner

    def windows(self, size: int = WINDOW, literal: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Hash, first term and text of every telling window, and how many these are. literal: then those with a slot by value."""
        at, owner = self._places(size)
        total, words = np.zeros(len(at), _U), np.zeros(len(at), int)
        for i in range(size):
            total += mixed(self.hash[at + i] + _U(i + 1)) * _U(2 * i + 3)
            words += self.kind[at + i] == _WORD
        telling = words >= min(LEAST_WORDS, size)
        found = [(mixed(total[telling]), at[telling], owner[telling])]
        if literal:
            slotted = words < size
            at, owner = at[slotted], owner[slotted]
            total = np.zeros(len(at), _U)
            for i in range(size):
                total += mixed(self.value[at + i] + _U(i + 1)) * _U(2 * i + 3)
            found.append((mixed(total), at, owner))
        return *(np.concatenate(x) for x in zip(*found)), int(telling.sum())

    def reach(self) -> np.ndarray:
        """How many terms of each text are in telling windows."""
        _, at, _, _ = self.windows()
        steps = np.bincount(at, minlength=len(self.kind) + 1) - np.bincount(at + WINDOW, minlength=len(self.kind) + 1)[: len(self.kind) + 1]
        sums = np.concatenate([[0], np.cumsum(np.cumsum(steps)[: len(self.kind)] > 0)])
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def slots(self, at: np.ndarray, size: int = WINDOW) -> np.ndarray:
        """The values of the slots of windows; 0 for words."""
        index = at[:, None] + np.arange(size)
        return np.where(self.kind[index] == _WORD, _U(0), self.value[index]).view(_I)

    def values(self, at: np.ndarray, size: int = WINDOW) -> np.ndarray:
        """The values of all terms of windows."""
        return self.value[at[:, None] + np.arange(size)].view(_I)


_WINDOWS = "window long, id {kind}, row long, place int, size int, terms int, reach int, slots array<long>"


def _windows(rows: DataFrame, bits=None, literal: bool = False, short: Sequence[int] = (), whole: bool = False) -> DataFrame:
    """window, id, row, place, size, terms of the text and how many of them telling windows reach, slots. rows: id, row, text.

    bits: a filter that windows must pass; then slots are the values of all terms. literal: windows by value as well. short: lengths of
    further windows. whole: these only of texts that have no more terms.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=TEXT_BYTES):
            template = Template(block.column("text"))
            terms, reach = np.diff(template.first), template.reach() if bits is None else None
            for size in (WINDOW, *short):
                hashes, at, owner, _ = template.windows(size, literal)
                held = passes(bits.value, hashes) if bits is not None else np.ones(len(hashes), bool)
                if whole and size < WINDOW:
                    held &= terms[owner] == size
                hashes, at, owner = hashes[held], at[held], owner[held]
                slots = template.slots(at, size) if bits is None else template.values(at, size)
                own = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(_I)),
                        block.column("id").take(own),
                        block.column("row").take(own),
                        pa.array((at - template.first[owner]).astype(np.int32)),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(terms[owner].astype(np.int32)),
                        pa.array((terms if reach is None else reach)[owner].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, slots.size + 1, size, dtype=np.int32)), pa.array(slots.ravel())),
                    ],
                    names=["window", "id", "row", "place", "size", "terms", "reach", "slots"],
                )

    return rows.mapInArrow(emit, _WINDOWS.format(kind=rows.schema["id"].dataType.simpleString()))


def needed(terms: int, reach: int, cover: float) -> float:
    """How many terms of an item of so many terms a document must hold. reach: those in telling windows."""
    return min(cover * terms, reach) if reach >= LEAST_REACH else cover * terms


def probe_windows(windows: list[tuple[int, int, int, int]], least: float) -> list[int]:
    """The windows of an item, one of which any of its windows that cover `least` terms must contain. windows: items that have it,
    window, place, size."""
    ordered = sorted(windows, reverse=True)
    covered: set[int] = set()
    for i, (_, _, place, size) in enumerate(ordered):
        covered.update(range(place, place + size))
        if len(covered) >= least:
            return sorted({w[1] for w in ordered[i:]})
    return []


def _probes(items: DataFrame, cover: float) -> DataFrame:
    """window, item_row: the probes of all items. items: window, item_row, item_place, size, terms, reach."""
    held = items.groupBy("window").agg(F.count_distinct("item_row").alias("held"))
    per_item = items.join(held, "window").groupBy("item_row", "terms", "reach").agg(F.collect_list(F.struct("held", "window", "item_place", "size")).alias("windows"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (row["item_row"], window)
                for row in batch.to_pylist()
                for window in probe_windows([tuple(w.values()) for w in row["windows"]], needed(row["terms"], row["reach"], cover))
            ]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (1, 0)], names=["window", "item_row"])

    return per_item.mapInArrow(emit, "window long, item_row long")


def _diagonals(matches: list[tuple]) -> list[list[tuple]]:
    """Matches on neighbouring diagonals, in groups."""
    groups: list[list] = []
    for m in sorted(matches, key=lambda m: (m[0] - m[1], m[0])):
        if groups and m[0] - m[1] - (groups[-1][-1][0] - groups[-1][-1][1]) <= SHIFT and m[0] - m[1] - (groups[-1][0][0] - groups[-1][0][1]) <= 2 * SHIFT:
            groups[-1].append(m)
        else:
            groups.append([m])
    return groups


def _joined(groups: list[list[tuple]], gap: int) -> list[list[tuple]]:
    """Groups put together that follow each other in the document, at most gap terms apart, and in the item."""
    chains: list[list] = []
    open_chains: list[list] = []
    for part in sorted(map(_part, groups), key=lambda p: p[:4]):
        open_chains = [c for c in open_chains if part[0] - c[-1][1] <= gap]
        before = [c for c in open_chains if c[-1][1] <= part[0] + SHIFT and c[-1][3] <= part[2] + SHIFT]
        if before:
            max(before, key=lambda c: (sum(p[3] - p[2] for p in c), -c[0][0])).append(part)
        else:
            chains.append([part])
            open_chains.append(chains[-1])
    return [[m for part in chain for m in part[4]] for chain in chains if len(chain) > 1]


def _part(group: list[tuple]) -> tuple[int, int, int, int, list]:
    """First and last place in the document, in the item, and the matches."""
    return min(m[0] for m in group), max(m[0] + len(m[2]) for m in group), min(m[1] for m in group), max(m[1] + len(m[2]) for m in group), group


def occurrences(matches: list[tuple[int, int, list[int], list[int]]], terms: int) -> list[dict]:
    """Occurrences of an item of so many terms. matches: place in the document, place in the item, values of the document's terms,
    slots of the item's."""
    out: list[dict] = []
    groups = _diagonals(matches)
    for group in groups + (_joined(groups, terms) if len(groups) > 1 else []):
        covered, seen = set(), {}
        for place, own, doc_values, item_slots in group:
            covered.update(range(own, own + len(item_slots)))
            for i, (d, b) in enumerate(zip(doc_values, item_slots)):
                if b:
                    seen[own + i] = (b, d)
        forward: dict[int, dict[int, int]] = {}
        for b, d in seen.values():
            forward.setdefault(b, {}).setdefault(d, 0)
            forward[b][d] += 1
        # Each value of the item keeps the value it became most often; a document value may stand for one item value only.
        taken: set[int] = set()
        consistent = 0
        for b, became in sorted(forward.items(), key=lambda x: (-max(x[1].values()), x[0])):
            for d, n in sorted(became.items(), key=lambda x: (-x[1], x[0])):
                if d not in taken:
                    taken.add(d)
                    consistent += n
                    break
        values = {"slots": len(seen), "consistent": consistent, "verbatim": all(b == d for b, d in seen.values())}
        start, end, _, _, _ = _part(group)
        out.append(values | {"windows": len({(m[1], len(m[2])) for m in group}), "covered": len(covered), "cover": len(covered) / max(terms, 1), "start": start, "end": end})
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, consistent: float = CONSISTENT, with_row: bool = False) -> DataFrame:
    """doc_id, item_id, kind, cover, windows, slots, consistent_slots, first_term, last_term of the items that documents hold.

    docs: doc_id, text; benchmark: item_id, text. The best occurrence of an item in a document is reported. with_row: also `_row`,
    which names a document by its id and text.
    """
    items = stored(
        _windows(benchmark.select(F.col("item_id").alias("id"), F.xxhash64("item_id", "text").alias("row"), "text"), literal=True, short=range(LEAST_TERMS, WINDOW), whole=True)
        .selectExpr("window", "id AS item_id", "row AS item_row", "place AS item_place", "size", "terms", "reach", "slots AS item_slots")
        .dropDuplicates(["window", "item_row", "item_place"]),
        "items",
    )
    # The benchmark's windows as a filter, and the lengths that they have: a few numbers.
    sizes = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bits = min(MOST_BITS, 1 << max(22, (KEY_BITS * sum(sizes.values()) - 1).bit_length()))
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(items, "window", n_bits))
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    ours = stored(
        _windows(rows, bits, literal=True, short=sorted(s for s in sizes if s < WINDOW))
        .selectExpr("window", "id AS doc_id", "row AS _row", "place", "slots AS values")
        .dropDuplicates(["window", "_row", "place"]),
        "document-windows",
    )
    candidates = ours.select("window", "_row").distinct().join(_probes(items, cover), "window").select("_row", "item_row").distinct()
    matched = candidates.join(items, "item_row").join(ours, ["_row", "window"])
    pairs = matched.groupBy("doc_id", "_row", "item_id", "item_row", "terms", "reach").agg(F.collect_list(F.struct("place", "item_place", "values", "item_slots")).alias("matches"))

    fields = ["kind", "cover", "windows", "slots", "consistent_slots", "first_term", "last_term"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = {f: [] for f in fields}, []
            for i in range(batch.num_rows):
                terms = batch.column("terms")[i].as_py()
                least = needed(terms, batch.column("reach")[i].as_py(), cover)
                best = None
                rows = [(m["place"], m["item_place"], m["values"], m["item_slots"]) for m in batch.column("matches")[i].as_py()]
                for x in occurrences(rows, terms):
                    if x["covered"] >= least and x["consistent"] >= consistent * x["slots"]:
                        if best is None or (x["cover"], -x["start"]) > (best["cover"], -best["start"]):
                            best = x
                if best:
                    held.append(i)
                    kind = "verbatim" if best["verbatim"] else "reparameterised"
                    for f, value in zip(fields, (kind, best["cover"], best["windows"], best["slots"], best["consistent"], best["start"], best["end"])):
                        found[f].append(value)
            kinds = [pa.string(), pa.float64(), *[pa.int64()] * 5]
            chosen = pa.array(held, pa.int64())
            ids = [batch.column(c).take(chosen) for c in ("doc_id", "_row", "item_id")]
            yield pa.RecordBatch.from_arrays(ids + [pa.array(found[f], k) for f, k in zip(fields, kinds)], names=["doc_id", "_row", "item_id", *fields])

    kinds = {c: pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")}
    schema = f"doc_id {kinds['doc_id']}, _row long, item_id {kinds['item_id']}, kind string, cover double, windows long, slots long, consistent_slots long, first_term long, last_term long"
    out = pairs.select("doc_id", "_row", "item_id", "terms", "reach", "matches").mapInArrow(judge, schema)
    return out if with_row else out.drop("_row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, consistent: float = CONSISTENT) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark item."""
    found = contaminated(docs, benchmark, cover, consistent, with_row=True)
    return without_rows(docs, stored(found.select("doc_id", F.col("_row").alias("row")).distinct(), "contaminated"))
