"""Token ids of whole texts, as a public tokenizer file gives them, with each distinct piece encoded once.

Byte-pair encoders cut a text into pieces by a pattern and encode each piece on its own, so a text's ids are those of its
pieces, laid end to end. The pattern is evaluated here over arrays of code points for texts made of characters whose class
is beyond doubt (`_CLASS`); the library encodes the pieces not met before. A text with any other character, or with
`<|`, the start of a special token, goes to the library whole. Long texts are first cut before a space between two plain
letters: both patterns begin a piece there, whatever stands around it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import numpy as np

from casemart.llm.common import _powers, mixed

#: Distinct pieces that a worker remembers; beyond it, it starts anew.
MEMO_PIECES = 3_000_000
#: Longer texts are cut, in characters.
SEGMENT_CHARS = 1 << 18
#: Characters of short texts that are encoded together.
BATCH_CHARS = 1 << 19

_SAFE_CUT = re.compile("(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?= [A-Za-zÀ-ÖØ-öø-ÿ])")
_SPACE, _BLANK, _LETTER, _DIGIT, _OTHER = 1, 2, 3, 4, 5
_CLASS = np.zeros(1 << 16, np.uint8)
_CLASS[32] = _SPACE
_CLASS[[9, 10, 13]] = _BLANK
_CLASS[33:127] = _OTHER
_CLASS[48:58] = _DIGIT
for _first, _last in ((65, 90), (97, 122), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x131, 0x24F), (0x400, 0x45F)):
    _CLASS[_first : _last + 1] = _LETTER
_CLASS[[ord(c) for c in "¡§«°»¿–—‘’“”…€"]] = _OTHER
_VALUE = mixed(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def segments(text: str, size: int = SEGMENT_CHARS) -> list[str]:
    """The text in parts of about `size` characters that can be encoded apart; one part if there is no safe place to cut."""
    if len(text) <= size:
        return [text]
    out, start = [], 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def _contractions(codes: np.ndarray, kind: np.ndarray, begin: np.ndarray, last: np.ndarray, bare: np.ndarray) -> None:
    """Let 's 't 'm 'd 're 've 'll be pieces where `bare` says that an apostrophe stands at the start of a piece."""
    at = np.flatnonzero(bare & (codes == 39) & ~last)
    at = at[kind[at + 1] == _LETTER]
    one = np.isin(codes[at + 1], [115, 116, 109, 100])
    two = ~one & ~last[at + 1]
    second = codes[np.minimum(at + 2, len(codes) - 1)]
    first = codes[at + 1]
    two &= ((first == 114) | (first == 118)) & (second == 101) | (first == 108) & (second == 108)
    for chosen, n in ((one, 1), (two, 2)):
        begin[at[chosen] + 1] = False
        after = at[chosen] + 1 + n
        after = after[~last[after - 1]]
        begin[after[kind[after] == _LETTER]] = True


def cut_words(codes: np.ndarray, kind: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of `'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+`; what lies between is dropped."""
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    before[first] = 0
    solid = kind >= _LETTER
    begin = solid & ((before != kind) | (kind == _DIGIT))
    _contractions(codes, kind, begin, last, begin)
    starts = np.flatnonzero(begin)
    edge = np.flatnonzero(begin | ~solid | first)
    ends = np.append(edge, len(codes))[np.searchsorted(edge, starts, "right")]
    return starts, ends


def cut_bytes(codes: np.ndarray, kind: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`; every character is in one."""
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    before[first] = 0
    blank = (kind == _SPACE) | (kind == _BLANK)
    blank_before = (before == _SPACE) | (before == _BLANK)
    followed = np.zeros(len(codes), bool)
    followed[:-1] = ~blank[1:]
    followed[last] = False
    begin = blank & (~blank_before | followed)
    begin |= ~blank & (before != kind) & (before != _SPACE)
    _contractions(codes, kind, begin, last, begin & (kind == _OTHER))
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], len(codes)) if len(starts) else starts


class Encoder:
    """Ids or counts of texts for one tokenizer file.

    words=True: the file lower-cases and drops white space (word_bpe); False: byte-level pieces that keep it (byte_bpe).
    """

    def __init__(self, path: str, words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.words = words
        self.ends = np.array([token.endswith("</w>") for token, _ in sorted(self.library.get_vocab().items(), key=lambda x: x[1])])
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and counts of pieces, from the library."""
        if self.words:  # each piece ends with a token marked </w>
            ids = np.array(self.library.encode(" ".join(pieces), add_special_tokens=False).ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(pieces):
                return ids, np.diff(stops, prepend=0).astype(np.int32)
        each = [x.ids for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        counts = np.array([len(x) for x in each], np.int32)
        return np.fromiter((i for x in each for i in x), np.uint32, int(counts.sum())), counts

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        if len(self.keys) + len(keys) > MEMO_PIECES:
            self._forget()
        ids, counts = self._encode(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        begins = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.sizes = np.insert(self.keys, where, keys), np.insert(self.at, where, begins), np.insert(self.sizes, where, counts)

    def _plain(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts of plain characters: where the ids of each piece begin, how many they are, and the first piece of each text."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        full = bounds[1:] > bounds[:-1]
        first[bounds[:-1][full]] = True
        last[bounds[1:][full] - 1] = True
        starts, ends = (cut_words if self.words else cut_bytes)(codes, _CLASS[codes], first, last)
        power, inverse = _powers(len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_VALUE[codes] * power[: len(codes)], out=sums[1:])
        keys = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        distinct, example, each = np.unique(keys, return_index=True, return_inverse=True)
        for _ in range(2):
            where = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
            new = np.flatnonzero(self.keys[where] != distinct) if len(self.keys) else np.arange(len(distinct))
            if not len(new):
                break
            held = len(self.keys)
            if held + len(new) > MEMO_PIECES:
                new = np.arange(len(distinct))  # it starts anew
            self._learn(distinct[new], [codes[starts[i] : ends[i]].tobytes().decode("utf-32-le") for i in example[new].tolist()])
        return self.at[where][each], self.sizes[where][each], np.searchsorted(starts, bounds)

    def _plain_text(self, text: str) -> str | None:
        """The text as the pieces see it, or None if the library has to encode it whole."""
        if "<|" in text:
            return None
        try:
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        except UnicodeEncodeError:
            return None
        if len(codes) and (int(codes.max()) >= len(_CLASS) or not _CLASS[codes].all()):
            return None
        return text.lower() if self.words else text

    def _parts(self, texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str], bool]]:
        """Batches of balanced size: the texts that the parts belong to, the parts, and whether they are plain."""
        owners, parts, chars = [], [], 0
        for i, text in enumerate(texts):
            for part in segments(text or ""):
                if not part:
                    continue
                if (plain := self._plain_text(part)) is None:
                    yield [i], [part], False
                    continue
                owners.append(i)
                parts.append(plain)
                chars += len(plain)
                if chars >= BATCH_CHARS:
                    yield owners, parts, True
                    owners, parts, chars = [], [], 0
        if parts:
            yield owners, parts, True

    def counts(self, texts: Sequence[str | None]) -> np.ndarray:
        """Tokens of each text; null has none."""
        out = np.zeros(len(texts), np.int64)
        for owners, parts, plain in self._parts(texts):
            if plain:
                _, sizes, first = self._plain(parts)
                sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                np.add.at(out, owners, sums[first[1:]] - sums[first[:-1]])
            else:
                out[owners[0]] += len(self.library.encode_batch_fast(parts, add_special_tokens=False)[0])
        return out

    def ids(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Token ids of each text; null has none."""
        found: list[list[tuple[int, np.ndarray]]] = [[] for _ in texts]
        order = 0
        for owners, parts, plain in self._parts(texts):
            if plain:
                at, sizes, first = self._plain(parts)
                sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                flat = self.flat[np.repeat(at - sums[:-1], sizes) + np.arange(sums[-1])]
                each = [flat[sums[a] : sums[b]] for a, b in zip(first[:-1], first[1:])]
            else:
                each = [np.array(self.library.encode(parts[0], add_special_tokens=False).ids, np.uint32)]
            for owner, x in zip(owners, each):
                found[owner].append((order, x))
            order += 1
        # A text's plain parts may wait for their batch while a part that is not plain is encoded at once.
        return [self._in_order(i, texts[i], x) for i, x in enumerate(found)]

    def _in_order(self, i: int, text: str | None, parts: list[tuple[int, np.ndarray]]) -> np.ndarray:
        if not parts:
            return np.zeros(0, np.uint32)
        if len(parts) == 1:
            return parts[0][1]
        kinds = [self._plain_text(x) is not None for x in segments(text or "") if x]
        if all(kinds) or not any(kinds):
            return np.concatenate([x for _, x in parts])
        return np.concatenate([x for part in segments(text or "") if part for x in self.ids([part])])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, words: bool) -> Encoder:
    """This worker's encoder for a file."""
    if (path, words) not in _encoders:
        _encoders[path, words] = Encoder(path, words)
    return _encoders[path, words]
