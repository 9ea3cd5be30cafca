"""Secret scans (op 10): a trigram inverted index chooses the texts that each rule's regex has to read.

From each rule's regex a Boolean query over trigrams is derived (`trigram_query`): literals that every match must hold, any of
the branches of an alternative, nothing from classes and optional parts. Each block of documents is a shard of the index:
postings of the trigrams that any query names, as ascending document numbers over all bytes of the block, lower-cased. Postings are
intersected and merged by the query; the candidates are verified with the regex itself. A rule without mandatory trigrams
reads every text of the shard. Shards are independent, so nothing is shuffled and a lost task is done again on its own.

Null and empty texts have no secrets. Repeated rows are scanned each. Overlapping spans of different kinds are all reported; in
redacted text they are one gap, named after the first. Other columns are not read by `scan`, and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as C
import re._parser as parser
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from casemart.llm.common import blocks, lower_ascii, raw_text


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a regex, and what a match must fulfil besides."""

    kind: str
    pattern: str
    holds: Callable[[re.Match], bool] = field(default=lambda match: True)


# The base rules as the contract of the query states them.
BASE = [
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # the runs of [0-9a-f]+ that have 16 characters
]
# Published token formats of common services.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"\b(?:ghp|gho|ghu|ghs|ghr|glpat)[_-][A-Za-z0-9_-]{20,}"),
    Rule("chat_token", r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"\b(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"(?ai:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
    Rule("url_login", r"\b[a-z][a-z0-9+.]{1,20}://[^\s/:@]{1,80}:[^\s/:@]{1,80}@"),
]

#: A query: True (every text), a trigram, or ("and" | "or", parts).
Query = bool | str | tuple[str, tuple]


def _join(op: str, parts: list[Query]) -> Query:
    """Parts under one operator, simplified: True is neutral for "and" and wins in "or"."""
    if op == "or" and (not parts or any(p is True for p in parts)):
        return True
    kept = tuple(dict.fromkeys(p for p in parts if p is not True))
    return True if not kept else kept[0] if len(kept) == 1 else (op, kept)


def _of_text(text: str) -> Query:
    """All trigrams of a literal's bytes, lower-cased."""
    raw = text.lower().encode()
    return _join("and", [raw[i : i + 3].decode("latin-1") for i in range(len(raw) - 2)])


#: A class of more characters than this is not spelled out; neither are more than so many literals at one place.
_SPELL, _AT_ONCE = 4, 24


def _literals(node) -> list[str] | None:
    """The strings that a part of a regex matches, if they are few and known."""
    op, arg = node
    if op is C.LITERAL:
        return [chr(arg)]
    if op is C.IN:
        if all(o is C.LITERAL for o, _ in arg) and len(arg) <= _SPELL:
            return [chr(a) for _, a in arg]
        return None
    if op is C.SUBPATTERN:
        return _spelled(arg[-1])
    if op is C.BRANCH:
        every = [_spelled(branch) for branch in arg[1]]
        return None if any(x is None for x in every) else [s for x in every for s in x]
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 1:
        own = _spelled(arg[2])
        return None if own is None else own if arg[0] else ["", *own]
    return [""] if op is C.AT else None


def _spelled(sequence) -> list[str] | None:
    out = [""]
    for node in sequence:
        own = _literals(node)
        if own is None or len(out) * len(own) > _AT_ONCE:
            return None
        out = [a + b for a in out for b in own]
    return out


def _query(sequence) -> Query:
    """What every match of a sequence must hold."""
    needs: list[Query] = []
    run = [""]

    def close() -> None:
        nonlocal run
        needs.append(_join("or", [_of_text(x) for x in run]))
        run = [""]

    for node in sequence:
        own = _literals(node)
        if own is not None:
            if len(run) * len(own) > _AT_ONCE:
                close()
            run = [a + b for a in run for b in own]
            continue
        close()
        op, arg = node
        if op is C.SUBPATTERN:
            needs.append(_query(arg[-1]))
        elif op is C.BRANCH:
            needs.append(_join("or", [_query(branch) for branch in arg[1]]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] >= 1:
            needs.append(_query(arg[2]))
    close()
    return _join("and", needs)


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a regex: every text with a match fulfils it."""
    return _query(parser.parse(pattern))


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, tuple):
        return set().union(*(trigrams_of(part) for part in query[1]))
    return set() if query is True else {query}


def _code(trigram: str) -> int:
    return int.from_bytes(trigram.encode("latin-1"), "big")


class Shard:
    """The inverted index of a block of documents, for chosen trigrams."""

    def __init__(self, text: pa.Array, trigrams: set[str]):
        data, offsets = raw_text(text)
        self.size = len(text)
        self.postings: dict[str, np.ndarray] = {}
        chosen = np.zeros(1 << 24, bool)
        chosen[[_code(t) for t in trigrams]] = True
        low = lower_ascii(data).astype(np.uint32)
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        at = np.flatnonzero(chosen[codes])
        owner = np.searchsorted(offsets, at, "right") - 1
        inside = at + 2 < offsets[owner + 1]
        pairs = np.unique(codes[at[inside]].astype(np.int64) * self.size + owner[inside])
        keys = pairs // max(self.size, 1)
        for trigram in trigrams:
            a, b = np.searchsorted(keys, [_code(trigram), _code(trigram) + 1])
            self.postings[trigram] = pairs[a:b] % max(self.size, 1)

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the documents that fulfil a query."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings[query]
        op, parts = query
        lists = sorted((self.candidates(part) for part in parts), key=len)
        out = lists[0]
        for more in lists[1:]:
            out = np.intersect1d(out, more, assume_unique=True) if op == "and" else np.union1d(out, more)
        return out


Span = tuple[str, int, int]


class Scanner:
    """Rules with their queries, made once per task."""

    def __init__(self, base: list[Rule], more: list[Rule]):
        self.rules = [*base, *more]
        self.base = {rule.kind for rule in base}
        self.order = {rule.kind: i for i, rule in enumerate(self.rules)}
        self.regexes = [re.compile(rule.pattern) for rule in self.rules]
        self.queries = [trigram_query(rule.pattern) for rule in self.rules]
        self.trigrams = set().union(*map(trigrams_of, self.queries))

    def spans(self, column: pa.Array) -> list[list[Span]]:
        """Per text, kind, start and end of what is found, by start, then kind."""
        shard = Shard(column, self.trigrams)
        texts: dict[int, str] = {}
        out: list[list[Span]] = [[] for _ in range(len(column))]
        for rule, regex, query in zip(self.rules, self.regexes, self.queries):
            for i in shard.candidates(query).tolist():
                if i not in texts:
                    texts[i] = column[i].as_py() or ""
                out[i].extend((rule.kind, m.start(), m.end()) for m in regex.finditer(texts[i]) if rule.holds(m))
        return [sorted(found, key=lambda s: (s[1], self.order[s[0]])) for found in out]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, more: list[Rule] = MORE) -> DataFrame:
    """doc_id, n_<kind> for the base rules, base_sha256, spans of each row of docs (doc_id, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(BASE, more)
        for block in blocks(batches):
            every = scanner.spans(block.column("text"))
            base = [[s for s in spans if s[0] in scanner.base] for spans in every]
            counts = [pa.array([sum(s[0] == rule.kind for s in spans) for spans in base], pa.int64()) for rule in BASE]
            digests = pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base])
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *counts, digests, pa.array([joined(spans) for spans in every], pa.string())],
                names=["doc_id", *(f"n_{rule.kind}" for rule in BASE), "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{rule.kind} long" for rule in BASE)
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span], mark: str = "SECRET") -> str:
    """The text with each stretch of overlapping spans replaced by [mark:kind]."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{mark}:{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, more: list[Rule] = MORE) -> DataFrame:
    """docs with secrets in the text replaced, and n_chars, where there is such a column, brought up to date for those rows."""
    names = docs.columns

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(BASE, more)
        for block in blocks(batches):
            every = scanner.spans(block.column("text"))
            texts = block.column("text").to_pylist()
            new = [masked(text, spans) if spans else text for text, spans in zip(texts, every)]
            arrays = [pa.array(new, block.schema.field("text").type) if name == "text" else block.column(name) for name in names]
            if "n_chars" in names:
                old = block.column("n_chars").to_pylist()
                arrays[names.index("n_chars")] = pa.array([len(t) if s else n for t, s, n in zip(new, every, old)], block.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(replace, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
