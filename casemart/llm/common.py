"""Words as arrays, batches of bounded size, tables, and components of a graph."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.session import CLEANUP, shuffles_released  # noqa: F401

#: Bytes of text that a task holds as arrays at one time; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Bytes hashed at one time, cut between words.
HASH_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the place that all executors share: spark.checkpoint.dir of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage is cut, and lost executors lose none of it."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batches of at most limit bytes in a column, or of one row."""
    for batch in batches:
        if batch.num_rows:
            sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_pandas(), float)).astype(np.int64)
            ends, start = np.cumsum(sizes), 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
                yield batch.slice(start, stop - start)
                start = stop


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is an empty text."""
    column = pa.concat_arrays([column.fill_null("").cast(pa.large_string())])
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


#: Numbers mixed at one time, so that they stay in the processor's cache.
MIXED = 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number spread over all 64 bits."""
    x = x.astype(_U, order="C", copy=True)
    parts = [x] if x.size <= MIXED else np.split(x.reshape(-1), range(MIXED, x.size, MIXED))
    for part in parts:
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            part ^= part >> _U(shift)
            part *= _U(factor)
        part ^= part >> _U(31)
    return parts[0] if x.size <= MIXED else x


_OF_BYTE = mixed(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE to the power 0..n and to the power 0..-n, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n, HASH_BYTES) + 2
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, b, _U), dtype=_U)]) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ordered spans of data. Long stretches are hashed part by part between spans."""
    out, first = np.empty(len(starts), _U), 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
        part = data[base : int(ends[last - 1])]
        power, inverse = _powers(len(part)) if len(part) <= HASH_BYTES else _long_powers(len(part))
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(_OF_BYTE[part] * power[: len(part)], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U)
        first = last
    return mixed(out)


def _long_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """For one span longer than HASH_BYTES: it starts at 0, so only its powers are wanted."""
    return np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, _BASE, _U)]), dtype=_U), np.ones(1, _U)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of texts laid end to end: starts, ends, and the first word of each text (with a last entry)."""
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    opens[cut] = inside[cut]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cut = offsets[1:][offsets[1:] > 0] - 1
    closes[cut] = inside[cut]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def windows(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within a text, and the first window of each text. A text of fewer than k words, but at least
    one, has its whole sequence as one window."""
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], n)
    # From every word on, whatever text the last words are of.
    sums = np.zeros(max(len(words) - k + 1, 0) + k, _U)
    last = len(sums) - k
    for i in range(k):
        sums[:last] += mixed(words[i : last + i] + _U(i + 1)) * _U(2 * i + 3)
    total = sums[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        total[begin[short]] = 0
        for i in range(k - 1):
            there = short[counts[short] > i]
            total[begin[there]] += mixed(words[first[there] + i] + _U(i + 1)) * _U(2 * i + 3)
    return mixed(total), begin


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("b"))


def _state(edges: DataFrame) -> tuple:
    """What tells two sets of edges apart: their number and a sum of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """node, component (its smallest node) for the nodes of undirected edges (a long, b long).

    Each round hangs every node's neighbours on its smallest neighbour, first those above it, then those below it
    (large star, small star). Rows per round don't exceed the edges; a node with many neighbours is reduced by a
    minimum before any join. Each round is written to the shared folder. It ends when nothing changes; a graph that
    needs more rounds raises an error.
    """
    edges = stored(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    state = _state(edges)
    for _ in range(rounds):
        both = edges.union(edges.selectExpr("b AS a", "a AS b"))
        least = _least(both).selectExpr("a AS n", "least(a, b) AS m")
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).selectExpr("b AS a", "m AS b")
        large = stored(large.distinct(), "large")
        least = _least(large).selectExpr("a AS n", "b AS m")
        small = large.join(least, F.col("a") == F.col("n")).select("b", "m", "n")
        small = small.filter("b <> m").selectExpr("b AS a", "m AS b").union(least.selectExpr("n AS a", "m AS b"))
        edges = stored(small.distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            return edges.selectExpr("a AS node", "b AS component").union(edges.selectExpr("b AS node", "b AS component").distinct())
    raise RuntimeError(f"components not settled after {rounds} rounds")


def free_name(df: DataFrame, name: str) -> str:
    """The name, or the name with underscores before it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def join_rows(docs: DataFrame, rows: DataFrame, how: str, value: str | None = None) -> DataFrame:
    """docs joined with rows (doc_id, row) that name documents by id and hash of id and text.

    Semi and anti joins return the columns of docs. A left join adds the column `value` of rows under free_name(docs, value).
    Documents may have columns of any names.
    """
    on = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64("d.doc_id", "d.text") == F.col("f.row"))
    joined = docs.alias("d").join(rows.alias("f"), on, how)
    if value is None:
        return joined
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    return joined.select(*own, F.col(f"f.{value}").alias(free_name(docs, value)))


def filter_bits(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A filter of fixed size for a column of 64-bit hashes: at most bits / 32 numbers reach the driver."""
    place = F.pmod(F.col(column), F.lit(bits))
    words = df.select(F.floor(place / 32).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int")).alias("b"))
    with shuffles_released(df.sparkSession):
        found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[found["w"].to_numpy()] = found["b"].to_numpy().astype(np.uint32)
    return out


def passes(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether hashes are in a filter of filter_bits; others may be as well."""
    place = hashes.view(np.int64) % (len(filter_words) * 32)
    return (filter_words[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1


#: Bits per key of a filter that is sized by its keys, and the most bits that it has (16 MB).
KEY_BITS, MOST_BITS = 16, 1 << 27


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that rows (doc_id, row: hash of id and text) does not name.

    Only documents that pass a filter of the named ones are joined, and so shuffled with their texts; the others, nearly all
    that stay, are passed on as they are read. The filter has KEY_BITS bits per named row, up to MOST_BITS; beyond, more documents
    pass it and are joined.
    """
    named = rows.select("doc_id", "row").distinct()
    count = named.count()
    if not count:
        return docs
    bits = min(MOST_BITS, 1 << max(10, (KEY_BITS * count - 1).bit_length()))
    words = docs.sparkSession.sparkContext.broadcast(filter_bits(named, "row", bits))

    @F.pandas_udf("boolean")
    def may_be_named(row: pd.Series) -> pd.Series:
        return pd.Series(passes(words.value, row.to_numpy()))

    passed = may_be_named(F.xxhash64("doc_id", "text"))
    return docs.filter(~passed).union(join_rows(docs.filter(passed), named, "left_anti"))


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema))
