"""Best-fit packing (op 3): bound-certified repacking of documents into sequences of at most `size` tokens.

1. Documents longer than a sequence are cut into full pieces, which fill a sequence each; the last piece may be shorter.
2. Pieces are dealt to groups of bounded size by a hash, and each group is packed by best-fit decreasing.
3. Dual feasible functions of the piece lengths bound the number of sequences of a group from below. A group that meets its
   bound is certified: no packing of its pieces is smaller, and it is left as it is.
4. Groups with a gap keep their full sequences and give up the others. Those pieces are exchanged: dealt anew, to
   fewer groups, and packed again; a group then sees pieces of many former groups.
5. After `rounds` exchanges the last packing stands.

A group has about `group_pieces` pieces at any size of the input, since whole numbers of groups are made for counted pieces and
the hash includes a number of each piece's own, written with the pieces: rows repeated under one id, or without an id, are spread
like others. Nothing but a count per round reaches the driver. Each round's packing is written to the
shared folder.

Null and empty texts are one piece of one token, the closing id. Repeated rows are packed each. A null doc_id is kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import blocks, stored
from casemart.llm.pieces import encoder

SIZE = 2048
GROUP_PIECES = 20_000
ROUNDS = 3
END_ID = 0

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECE}, _number long, sequence_id long, offset long, full boolean, certified boolean"


def cut_pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of each row of docs (doc_id, text): doc_id, piece, start, length, ids_crc32, and the ids if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, True)
        for block in blocks(batches):
            rows: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, ids in zip(block.column("doc_id").to_pylist(), own.ids(block.column("text").to_pylist())):
                ids = np.append(ids, end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), size)):
                    part = ids[start : start + size]
                    for name, value in zip(rows, (doc, piece, start, len(part), zlib.crc32(part.tobytes()), part if with_ids else None)):
                        rows[name].append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(rows[name], kind) for name, kind in zip(rows, kinds)]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in rows["ids"]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*rows][: len(arrays)])

    return docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text").mapInArrow(cut, PIECE + ", ids array<int>" * with_ids)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Sequences that any packing of the lengths needs, by three families of dual feasible functions."""
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // size)
    # Pieces over size - k count as full, those below k as nothing.
    below = np.concatenate([[0], np.cumsum(count * x)])
    above = np.concatenate([[0], np.cumsum(count)])
    k = np.arange(1, size // 2 + 1)
    weight = size * (above[size + 1] - above[size - k + 1]) + below[size - k + 1] - below[k]
    best = max(best, int((-(-weight // size)).max(initial=0)))
    # Lengths rounded to k-ths of a sequence, exact multiples of 1/(k+1) left as they are.
    for k in range(1, 41):
        scaled = (k + 1) * x
        value = np.where(scaled % size == 0, x * k, scaled // size * size)  # times k, in tokens
        best = max(best, -(-int((count * value).sum()) // (size * k)))
    # Large pieces counted by how many small ones of length >= k they leave room for.
    for k in range(2, size // 2 + 1, max(1, size // 256)):
        fit = size // k
        value = np.where(2 * x > size, 2 * (fit - (size - x) // k), np.where(2 * x == size, fit, 2 * (x // k)))
        best = max(best, -(-int((count * value).sum()) // (2 * fit)))
    return best


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: for ordered lengths, each one's bin and offset; and the tokens of each bin."""
    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    room: dict[int, list[int]] = {}
    there = 0  # bit r: a bin with r tokens of room
    for i, n in enumerate(lengths.tolist()):
        fits = there >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            own = room[left]
            b = own.pop()
            if not own:
                there &= ~(1 << left)
        else:
            left, b = size, len(used)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        if rest := left - n:
            room.setdefault(rest, []).append(b)
            there |= 1 << rest
    return bins, offsets, np.array(used, np.int64)


def _pack(pieces: DataFrame, size: int, group_pieces: int, turn: int) -> DataFrame:
    """One round: groups of pieces packed, certified or not."""
    groups = max(1, -(-pieces.count() // group_pieces))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["_group"].iloc[0])
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, offsets, used = best_fit(lengths, size)
        out = pdf.drop(columns="_group")
        out["sequence_id"] = ((group * (ROUNDS + 9) + turn) << 24) + bins
        out["offset"] = offsets
        out["full"] = used[bins] == size
        out["certified"] = len(used) == lower_bound(lengths, size)
        return out

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_number", F.lit(turn)), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(pack, PLACED)


def pack_pieces(pieces: DataFrame, size: int = SIZE, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Pieces with sequence_id and offset. Each of at most `size` tokens; see the module."""
    columns = [*pieces.columns, "sequence_id", "offset"]
    pieces = stored(pieces.withColumn("_number", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") >= size).withColumns(
        {"sequence_id": -F.monotonically_increasing_id() - 1, "offset": F.lit(0).cast("long")}
    )
    done, rest = [full], pieces.filter(F.col("length") < size)
    for turn in range(rounds + 1):
        placed = stored(_pack(rest, size, group_pieces, turn), "packed")
        if turn == rounds:
            done.append(placed)
            break
        done.append(placed.filter("full OR certified"))
        rest = placed.filter("NOT (full OR certified)").drop("sequence_id", "offset", "full", "certified")
        if rest.isEmpty():
            break
    out = done[0].select(columns)
    for part in done[1:]:
        out = out.union(part.select(columns))
    return out


def pack_documents(docs: DataFrame, path: str, size: int = SIZE, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of docs (doc_id, text)."""
    return pack_pieces(cut_pieces(docs, path, size), size, group_pieces, rounds)
