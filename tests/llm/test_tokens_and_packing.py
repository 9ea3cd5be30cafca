import os
import zlib
from collections import defaultdict
from itertools import product
from random import Random

import numpy as np
import pytest
from corpus import EDGES, clashing, frame, prose
from tokenizers import Tokenizer

from casemart.llm import packing, token_counts
from casemart.llm.pieces import Encoder, segments
from casemart.llm.token_counts import tokenizer_path

PATHS = {True: tokenizer_path("word_bpe_49k.json"), False: tokenizer_path("byte_bpe_50k.json")}
ODD = [
    "", "  ", " a", "a  b\n\n c", "don't we'll I've 'street x's'", "'s 's\n't 'll'd '' 're", "12345 6a7 \t\n \n x",
    "<|endoftext|> a <|startoftext|>", "日本 語 abc", "á é", "Σας İ", "a\xa0b", "$$$ ... 'tis", "\n'm y", "x'’s", "a's", " '", "\ud800"[:0],
]


def odd_texts():
    pick = Random(1)
    letters = "abtsvemdlrZ'  \n\tÉß1 2.,!?é’<|"
    return ODD + ["".join(pick.choice(letters) for _ in range(pick.randint(1, 40))) for _ in range(3000)]


@pytest.mark.parametrize("words", [True, False])
def test_ids_equal_the_library(words):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(PATHS[words])
    texts = odd_texts()
    own = Encoder(PATHS[words], words)
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.ids(texts)] == expected
    assert own.counts([None, *texts]).tolist() == [0, *map(len, expected)]


@pytest.mark.parametrize("words", [True, False])
def test_long_texts_are_cut_where_pieces_begin(words):
    library = Tokenizer.from_file(PATHS[words])
    own = Encoder(PATHS[words], words)
    for text in ["hello world é 'tis 12 " * 30_000, "x" * 300_000, "日本 ab cd " * 40_000 + prose(1, 60_000)]:
        parts = segments(text, 50_000)
        assert "".join(parts) == text
        assert own.ids([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_memo_starts_anew(monkeypatch):
    from casemart.llm import pieces

    monkeypatch.setattr(pieces, "MEMO_PIECES", 40)
    own = Encoder(PATHS[True], True)
    texts = [prose(k, 30) for k in range(20)]
    expected = [x.ids for x in own.library.encode_batch(texts, add_special_tokens=False)]
    assert [own.ids([t])[0].tolist() for t in texts] == expected


def test_counts_query(spark):
    rows = EDGES + [(20, prose(1, 3000)), (21, "<|endoftext|>")]
    library = Tokenizer.from_file(PATHS[False])
    for docs in [frame(spark, rows), clashing(spark, rows)]:
        found = token_counts.token_counts(docs, PATHS[False], batch_bytes=1000).collect()
        expected = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
        assert sorted(map(str, found)) == sorted(f"Row(doc_id={d}, n_bytes={b}, n_tokens={n}, over_limit={n > 1024})" for d, b, n in expected)
    assert token_counts.token_counts(frame(spark, rows).limit(0), PATHS[False]).count() == 0


def best_bins(lengths, size):
    """The fewest bins, by trying all partitions of a few pieces."""
    best = len(lengths)
    for choice in product(range(len(lengths)), repeat=len(lengths)):
        if len(set(choice)) < best and max(np.bincount(choice, lengths)) <= size:
            best = len(set(choice))
    return best


def test_bounds_are_below_the_best_packing():
    pick = Random(3)
    for _ in range(60):
        size = pick.choice([7, 10, 24])
        lengths = np.array([pick.randint(1, size - 1) for _ in range(pick.randint(1, 5))])
        bound, best = packing.lower_bound(lengths, size), best_bins(lengths, size)
        assert bound <= best
        bins, offsets, used = packing.best_fit(np.sort(lengths)[::-1], size)
        assert len(used) >= best and used.max() <= size and used.sum() == lengths.sum()
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3 and packing.lower_bound(np.zeros(0, int), 10) == 0


def check_packing(rows, docs, size, group):
    library = Tokenizer.from_file(PATHS[True])
    expected = []
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected += [(d, k, s, len(ids[s : s + size]), zlib.crc32(ids[s : s + size].tobytes())) for k, s in enumerate(range(0, len(ids), size))]
    found = packing.pack_documents(docs, PATHS[True], size, group).collect()
    assert sorted(str(tuple(r)[:5]) for r in found) == sorted(map(str, expected))
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(e[3] for e in expected)


def test_packing_is_gapless_and_tight(spark):
    rows = EDGES + [(100 + k, prose(k, 3 + k * 7 % 90)) for k in range(300)]
    for docs, group in [(frame(spark, rows), 20_000), (clashing(spark, rows), 40)]:
        n, tokens = check_packing(rows, docs, 256, group)
        assert -(-tokens // 256) <= n <= 1.02 * tokens / 256 + 2
    assert packing.pack_documents(frame(spark, rows).limit(0), PATHS[True]).count() == 0


def test_token_ids_come_along(spark):
    rows = packing.cut_pieces(frame(spark, [(1, "a b c d e f")]), PATHS[True], 4, with_ids=True).collect()
    assert [zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows] == [r["ids_crc32"] for r in rows]


def test_rows_of_one_id_are_dealt_to_all_groups(spark):
    pieces = spark.range(2000).selectExpr("CAST(NULL AS long) AS doc_id", "0 AS piece", "0L AS start", "3L AS length", "0L AS ids_crc32")
    found = packing.pack_pieces(pieces, 10, 100, 0).groupBy("sequence_id").count().collect()
    assert sum(r["count"] for r in found) == 2000
    groups = {r["sequence_id"] >> 24 for r in found}
    assert len(groups) == 20
