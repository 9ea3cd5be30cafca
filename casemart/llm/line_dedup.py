"""Line dedup (op 13): lines that many documents share are removed from all of them. DataFrame expressions only.

1. count: each document's distinct line keys are exploded and hashed; a hash is counted once per document. Map tasks
   send one row per key and task, so a line that a third of all documents hold costs its reducer one row per task.
2. drop: keys found in `least` documents or more are written to the shared folder; lines are exploded again, as hashes
   with their position, and those with such a key keep their position. The list of keys is broadcast if its files are
   under Spark's threshold; if not, only hashes are shuffled, and adaptive execution splits a hot one.
3. reassemble: the dropped positions of a document are collected, and the stretches of lines between them are joined in
   order. Texts are shuffled once at most, and never as single lines.

A line's key is the line without the characters x20 and x09-x0D at both ends, with A-Z in lower case; keys are compared
by two 64-bit hashes (n distinct keys: n^2 / 2^129 false matches expected). Keys of fewer than `shortest` code points
are not counted and stay.

Null and empty texts have one empty line. Rows are documents: repeated rows and several texts under one doc_id, null
included, count each, and each gets its own result. Ties cannot arise: all lines with a key go or stay. An empty table gives
an empty result. Other columns may have any names; `without_common_lines` returns them unchanged. A document's positions
are held in one row, as its text is: a very long text needs some 30 bytes of memory per line besides it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import free_name, stored

#: Documents that must hold a key for its lines to go, and the code points that a key has at least.
LEAST_DOCUMENTS = 10
SHORTEST = 1

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "\x20\t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line stripped, with A-Z in lower case. Lines of ASCII alone take the faster function, with the same result."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(13), key).alias("h2")]


def common_keys(docs: DataFrame, least: int = LEAST_DOCUMENTS, shortest: int = SHORTEST) -> DataFrame:
    """h1, h2, n_docs of the line keys that at least `least` documents hold."""
    keys = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    exploded = docs.select(F.explode(keys).alias("key")).filter(F.char_length("key") >= shortest)
    counted = exploded.select(*_hashes(F.col("key"))).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))
    return counted.filter(F.col("n_docs") >= least)


def _row(text: Column) -> Column:
    """With doc_id, what names a document: rows equal in both have the same result."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def dropped_places(docs: DataFrame, keys: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, row, places: the sorted positions, from 0, of each document's lines that have one of the keys."""
    placed = docs.select("doc_id", _row(F.col("text")).alias("row"), F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    placed = placed.select("doc_id", "row", "place", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= shortest)
    hits = placed.select("doc_id", "row", "place", *_hashes(F.col("key"))).join(keys.select("h1", "h2"), ["h1", "h2"], "left_semi")
    return hits.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("place")).alias("places"))


def _between(lines: Column, places: Column) -> Column:
    """The lines that stand between the given places, in order."""

    def stretch(place: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1) + 1)
        return F.slice(lines, start + 1, place - start)

    return F.flatten(F.transform(F.concat(places, F.array(F.size(lines))), stretch))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without_common_lines(docs: DataFrame, least: int = LEAST_DOCUMENTS, shortest: int = SHORTEST) -> DataFrame:
    """The columns of docs, with text less its common lines, and n_lines (before) and n_dropped; the counts take other names
    if docs has columns of these (see free_name)."""
    keys = stored(common_keys(docs, least, shortest), "common_lines")
    places = stored(dropped_places(docs, keys, shortest), "dropped_lines")
    on = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (_row(F.col("d.text")) == F.col("p.row"))
    joined = docs.alias("d").join(places.alias("p"), on, "left")
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    gone = F.coalesce(F.size("p.places"), F.lit(0))
    text = F.coalesce(F.col("d.text"), F.lit(""))
    kept = F.when(F.col("p.places").isNull(), text).otherwise(_let(lines_of(text), lambda lines: F.array_join(_between(lines, F.col("p.places")), "\n")))
    own = [kept.alias(c) if c.lower() == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    return joined.select(*own, F.size(lines_of(text)).cast("long").alias(n_lines), gone.cast("long").alias(n_dropped))


def line_dedup(docs: DataFrame, least: int = LEAST_DOCUMENTS, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each document."""
    kept = without_common_lines(docs.select("doc_id", "text"), least, shortest)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
