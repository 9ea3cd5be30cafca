"""PII (op 9): information-theoretic sanitisation over corpus co-occurrence.

1. Direct identifiers (email, ip, card, phone) are found by the base patterns. Each distinct value is a protected entity e.
   Entities that stand in the same documents are told apart by no word, so they are one class and counted once.
2. A word t co-occurs with e in a document that holds both, at any distance. The corpus gives how many documents hold t, n(t), hold e,
   n(e), and hold both, n(e,t), of N documents.
3. t reveals log2(N n(e,t) / (n(e) n(t))) bits of the log2(N / n(e)) bits that name e. Their ratio is the disclosure: 1 if every document
   with t holds e, 0 if t says nothing of e.
4. Only what chance does not explain is judged. Of the m different texts that hold e, k hold t, where m n(t) / N would by chance; the
   probability of k or more is bounded (the smaller of Markov's and Chernoff's bounds). Times 2^distance, the least distance of t
   from e in words, it must be at most `CHANCE`: words far from e need more evidence. The weights have a finite sum, and a word
   that stands beside e once is judged within a distance that grows with log N only. Copies are one text.
5. Words whose disclosure reaches `REMOVE` for some entity are removed, and those that reach `GENERALISE` are replaced by their
   kind, in every document that holds them, whether or not it holds the entity. Direct identifiers are always replaced.

Counts are over all documents. A word can reach `GENERALISE` only if n(t) <= N^(1-GENERALISE) n(e)^GENERALISE; filters of such words,
one for each power of 4 of n(e), keep others from being paired with entities. n(t) is counted for words of documents with
entities only. Filters are sized by the words that they hold, up to `MOST_BITS` each; exact joins follow. Pairs are aggregated
before they are shuffled, so an entity that many documents hold costs a row per word and task.

Null and empty texts have no spans. Repeated rows are searched each and counted each. Other columns are not read by
`personal_data`, and kept by `sanitise`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.llm.common import KEY_BITS, blocks, filter_bits, free_name, join_rows, lower_ascii, passes, raw_text, span_hashes, stored

CHANCE = 0.02
GENERALISE = 0.8
REMOVE = 0.95
#: The most bits of a filter of words (4 MB), and rows of pairs that a task sends on at one time.
MOST_BITS = 1 << 25
PAIR_ROWS = 1 << 16

KINDS = ["email", "ip", "card", "phone"]
#: Kinds of the spans that the method adds.
ADDED = ["generalised", "removed"]
_ORDER = {kind: i for i, kind in enumerate([*KINDS, *ADDED])}

# The base patterns as the contract of the query states them.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from their @ signs: each has one, so the work
    is in proportion to the text even where long runs have no @."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SET:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            free = match.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[Span]:
    """Direct identifiers by start, then kind."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], _ORDER[s[0]]))


def _entity(kind: str, value: str) -> int:
    """A 64-bit name of a protected value, however it is written."""
    value = value.lower() if kind == "email" else value if kind == "ip" else _digits(value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big", signed=True)


# Terms: runs of letters, digits and characters beyond ASCII, lower-cased.
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the terms of texts laid end to end, and the text of each."""
    inside = _TERM_BYTE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    opens[cut] = inside[cut]
    cut = offsets[1:][offsets[1:] > 0] - 1
    closes[cut] = inside[cut]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, span_hashes(lower_ascii(data), starts, ends), np.searchsorted(offsets, starts, "right") - 1


def _text_terms(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (in code points) and hashes of the terms of one text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, hashes, _ = term_spans(raw, np.array([0, len(raw)]))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return chars[starts], chars[ends], hashes.view(np.int64)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, _key (names the row's id and text), kinds, starts, ends, entities of each row, and the text where it has any."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text").to_pylist()
            every = [base_spans(text) for text in texts]
            names = [[_entity(kind, text[a:b]) for kind, a, b in spans] for text, spans in zip(texts, every)]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("_key"),
                    pa.array([[s[0] for s in spans] for spans in every], pa.list_(pa.string())),
                    pa.array([[s[1] for s in spans] for spans in every], pa.list_(pa.int64())),
                    pa.array([[s[2] for s in spans] for spans in every], pa.list_(pa.int64())),
                    pa.array(names, pa.list_(pa.int64())),
                    pa.array([text if spans else None for text, spans in zip(texts, every)], pa.string()),
                ],
                names=["doc_id", "_key", "kinds", "starts", "ends", "entities", "text"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), "text")
    return keyed.mapInArrow(find, f"doc_id {kind}, _key long, kinds array<string>, starts array<long>, ends array<long>, entities array<long>, text string")


def _spans_of(row: dict) -> list[Span]:
    return list(zip(row["kinds"], row["starts"], row["ends"]))


def _filter(df: DataFrame, column: str, keys: int) -> np.ndarray:
    """A filter of the hashes in a column, sized by how many they are."""
    return filter_bits(df, column, min(MOST_BITS, 1 << max(10, (KEY_BITS * keys - 1).bit_length())))


def _free_terms(text: str, spans: list[Span]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the terms of a text outside its direct identifiers."""
    starts, ends, hashes = _text_terms(text)
    # Identifiers of one kind don't overlap; those of all kinds are laid over each other.
    covered = np.zeros(len(text) + 1, np.int64)
    for _, a, b in spans:
        covered[a] += 1
        covered[b] -= 1
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    free = inside[ends] == inside[starts]
    return starts[free], ends[free], hashes[free]


def _texts_with_entities(found: DataFrame) -> DataFrame:
    """text_key, copies, text, kinds, starts, ends, entities of the different texts that hold direct identifiers."""
    own = ["text", "kinds", "starts", "ends", "entities"]
    held = found.filter("text IS NOT NULL").withColumn("text_key", F.xxhash64("text"))
    return held.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in own])


def entity_classes(texts: DataFrame) -> DataFrame:
    """entity, klass, n_entity, texts: entities that stand in the same texts have the same class, named by a hash of these."""
    single = texts.select("text_key", "copies", F.explode(F.array_distinct("entities")).alias("entity"))
    held = single.groupBy("entity").agg(
        F.sum("copies").alias("n_entity"), F.count(F.lit(1)).alias("texts"), F.sum(F.xxhash64("text_key").cast("decimal(38,0)")).alias("sum")
    )
    return held.select("entity", F.xxhash64("n_entity", "texts", "sum").alias("klass"), "n_entity", "texts")


def _documents_with(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_term: in how many documents each of the terms stands, over all documents."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(terms, "term", terms.count()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            _, _, hashes, owner = term_spans(*raw_text(block.column("text")))
            held = passes(bits.value, hashes)
            pairs = np.unique(np.stack([owner[held].astype(np.int64), hashes[held].view(np.int64)], 1), axis=0)
            found, n = np.unique(pairs[:, 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["term", "n"])

    counted = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    return counted.join(terms, "term", "left_semi")


def _terms_of(texts: DataFrame) -> DataFrame:
    """The different terms of texts, outside direct identifiers."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            parts = [_free_terms(row["text"], _spans_of(row))[2] for row in block.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(parts)), pa.int64())], names=["term"])

    return texts.select("text", "kinds", "starts", "ends").mapInArrow(emit, "term long").distinct()


def _nearest(hashes: np.ndarray, held: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different terms at the places `held`, and the least distance of each from the sorted places of an entity."""
    after = np.searchsorted(places, held, "left")
    left = np.abs(held - places[np.maximum(after - 1, 0)])
    right = np.abs(places[np.minimum(after, len(places) - 1)] - held)
    order = np.argsort(hashes[held], kind="stable")
    terms, first = np.unique(hashes[held][order], return_index=True)
    return terms, np.minimum.reduceat(np.minimum(left, right)[order], first) if len(terms) else np.zeros(0, np.int64)


def _pairs(texts: DataFrame, classes: DataFrame, filters: dict[int, np.ndarray]) -> DataFrame:
    """klass, term, together (documents), both (texts), distance of the classes and terms that stand in one document."""
    kept = texts.sparkSession.sparkContext.broadcast(filters)
    places = texts.select("text_key", F.posexplode("entities").alias("at", "entity")).join(classes, "entity")
    places = places.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("at", "klass", "tier"))).alias("classes"))
    rows = texts.select("text_key", "copies", "text", "kinds", "starts", "ends").join(places, "text_key")
    names = ["klass", "term", "copies", "distance"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = 0
        for block in blocks(batches):
            for row in block.to_pylist():
                starts, _, hashes = _free_terms(row["text"], _spans_of(row))
                before: dict[tuple[int, int], list[int]] = {}
                for c in row["classes"]:
                    before.setdefault((c["klass"], c["tier"]), []).append(row["starts"][c["at"]])
                held = {tier: np.flatnonzero(passes(kept.value[tier], hashes)) for tier in {tier for _, tier in before}}
                for (klass, tier), begins in before.items():
                    terms, distance = _nearest(hashes, held[tier], np.searchsorted(starts, np.sort(begins)))
                    if len(terms):
                        parts.append((np.full(len(terms), klass), terms, np.full(len(terms), row["copies"]), distance))
                        size += len(terms)
                    if size >= PAIR_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], names=names)
                        parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], names=names)

    near = rows.drop("text_key").mapInArrow(emit, "klass long, term long, copies long, distance long")
    return near.groupBy("klass", "term").agg(F.sum("copies").alias("together"), F.count(F.lit(1)).alias("both"), F.min("distance").alias("distance"))


def disclosures(docs: DataFrame, texts: DataFrame, classes: DataFrame, chance: float = CHANCE, generalise: float = GENERALISE) -> DataFrame:
    """klass, term, disclosure of the terms that disclose `generalise` or more of a class of entities, chance aside.

    texts: _texts_with_entities; classes: entity_classes, both stored.
    """
    total = float(docs.count())
    tier = F.ceil(F.log("n_entity") / math.log(4) - 1e-9).cast("int")
    classes = classes.withColumn("tier", tier)
    tiers = sorted(row[0] for row in classes.select("tier").distinct().collect())  # powers of 4 of a count: at most 32
    if not tiers:
        return docs.sparkSession.createDataFrame([], "klass long, term long, disclosure double")
    terms = stored(_documents_with(docs, stored(_terms_of(texts), "terms")), "counted")
    most = {t: total ** (1 - generalise) * 4.0 ** (t * generalise) * (1 + 1e-9) for t in tiers}
    sizes = terms.agg(*[F.sum((F.col("n_term") <= most[t]).cast("long")) for t in tiers]).first()
    filters = {t: _filter(terms.filter(F.col("n_term") <= most[t]), "term", n or 1) for t, n in zip(tiers, sizes)}
    near = _pairs(texts, classes, filters)
    groups = classes.groupBy("klass").agg(F.first("n_entity").alias("n_entity"), F.first("texts").alias("texts"))
    both = near.join(terms, "term").join(groups, "klass")
    bits = F.log2(F.lit(total) * F.col("together") / (F.col("n_entity") * F.col("n_term")))
    whole = F.log2(F.lit(total) / F.col("n_entity"))
    by_chance = F.col("texts") * F.col("n_term") / F.lit(total)
    chernoff = F.exp(F.col("both") - by_chance + F.col("both") * F.log(by_chance / F.col("both")))
    bound = F.least(by_chance / F.col("both"), F.when(F.col("both") > by_chance, chernoff).otherwise(F.lit(1.0)))
    both = both.filter(F.log2(F.greatest(bound, F.lit(1e-300))) + F.col("distance") <= math.log2(chance))
    both = both.select("klass", "term", F.when(whole > 0, bits / whole).otherwise(F.lit(0.0)).alias("disclosure"))
    return both.filter(F.col("disclosure") >= generalise)


def _added(docs: DataFrame, revealing: DataFrame, count: int) -> DataFrame:
    """_doc, _own, added: spans of revealing terms (term, removed) in every text that holds them, outside direct identifiers."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(revealing, "term", count))
    names = ["_doc", "_own", "term", "start", "end"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            column = block.column("text")
            _, _, hashes, owner = term_spans(*raw_text(column))
            rows, spans = [], []
            for i in np.unique(owner[passes(bits.value, hashes)]).tolist():
                text = column[i].as_py()
                starts, ends, own = _free_terms(text, base_spans(text))
                hit = passes(bits.value, own)
                rows.append(np.full(int(hit.sum()), i))
                spans.append((own[hit], starts[hit], ends[hit]))
            if rows:
                at = pa.array(np.concatenate(rows))
                every = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*spans)]
                yield pa.RecordBatch.from_arrays([block.column("doc_id").take(at), block.column("_key").take(at), *every], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), "text")
    found = keyed.mapInArrow(emit, f"_doc {kind}, _own long, term long, start long, end long").join(revealing, "term")
    span = F.struct(F.when(F.col("removed"), F.lit(ADDED[1])).otherwise(F.lit(ADDED[0])).alias("kind"), "start", "end")
    return found.groupBy("_doc", "_own").agg(F.collect_set(span).alias("added"))  # repeated rows have the same spans


def _all_spans(docs: DataFrame, chance: float, generalise: float, remove: float) -> DataFrame:
    """Each row's doc_id and _key with its base spans and the added ones."""
    found = stored(_found(docs), "personal")
    texts = stored(_texts_with_entities(found), "holders")
    classes = stored(entity_classes(texts), "entities")
    revealing = disclosures(docs, texts, classes, chance, generalise).groupBy("term").agg((F.max("disclosure") >= remove).alias("removed"))
    revealing = stored(revealing, "revealing")
    base = F.arrays_zip(F.col("kinds").alias("kind"), F.col("starts").alias("start"), F.col("ends").alias("end"))
    rows = found.select("doc_id", "_key", base.alias("base"))
    none = F.expr("CAST(array() AS array<struct<kind:string,start:bigint,end:bigint>>)")
    count = revealing.count()
    if not count:
        return rows.withColumn("added", none)
    on = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_own"))
    joined = rows.join(_added(docs, revealing, count), on, "left").drop("_doc", "_own")
    return joined.withColumn("added", F.coalesce("added", none))


def _texts(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _same(kind: str):
    return lambda x: x == kind


def _by_start(spans):
    """Spans by start, then kind in the listed order."""
    rank = F.create_map(*[F.lit(x) for kind, i in _ORDER.items() for x in (kind, i)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def personal_data(docs: DataFrame, chance: float = CHANCE, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256, spans of each row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    rows = _all_spans(docs, chance, generalise, remove)
    counts = [F.size(F.filter(F.transform("base", lambda s: s["kind"]), _same(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    every = F.when(F.size("added") > 0, _texts(_by_start(F.concat("base", "added")))).otherwise(_texts(F.col("base")))
    return rows.select("doc_id", *counts, F.sha2(_texts(F.col("base")), 256).alias("base_sha256"), every.alias("spans"))


def clean_text(text: str, spans: list[Span]) -> str:
    """The text with direct identifiers and generalised words replaced by their kind, and removed words gone."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            word = text[start:end]
            general = "<NUMBER>" if word.isdigit() else "<NAME>" if word[:1].isupper() else "<WORD>"
            out += [text[at:start], "" if kind == "removed" else general if kind == "generalised" else f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, chance: float = CHANCE, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """docs, all columns, with sanitised text."""
    names = docs.columns
    spans = _all_spans(docs.select("doc_id", "text"), chance, generalise, remove)
    every = F.when(F.size("added") > 0, F.concat("base", "added")).otherwise(F.col("base"))
    spans = spans.select("doc_id", F.col("_key").alias("row"), _by_start(every).alias("_spans"))
    spans = spans.filter(F.size("_spans") > 0).dropDuplicates(["doc_id", "row"])
    own = free_name(docs, "_spans")
    rows = join_rows(docs, spans, "left", "_spans")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text").to_pylist()
            every = block.column(own).to_pylist()
            new = [clean_text(t, [(s["kind"], s["start"], s["end"]) for s in found]) if found else t for t, found in zip(texts, every)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else block.column(n) for n in names], names=names)

    return rows.mapInArrow(replace, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
